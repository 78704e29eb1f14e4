"""Exports and incremental appends."""
