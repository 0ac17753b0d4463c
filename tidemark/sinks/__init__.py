"""Partitioned tables and rollup files."""
