"""Scans: documents in, one row per line or document out."""
