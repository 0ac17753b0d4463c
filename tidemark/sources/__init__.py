"""Readers: archives, messages and item rows."""
