"""Writes: keep-first and last-wins merges, audits, exports."""
