"""Omics data-warehouse pipeline expressed as Spark DataFrame jobs."""
