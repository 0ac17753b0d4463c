"""Queries over the test tables, one per feature, with their SQL counterparts."""
