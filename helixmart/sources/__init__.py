"""Scans: file catalogue, TSV, annotated-matrix tables, Matrix Market, SDRF, JSON lines."""
