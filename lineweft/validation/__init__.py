"""Queries over the driver's tables, each with the SQL that computes the same rows without documents."""
