"""Whole jobs: the load pipeline, the star schema and the analytics on it."""
