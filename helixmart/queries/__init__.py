"""Registered queries: each pairs a Spark job with the SQL that must give the same rows.

The test tables stand in for the domain: part = genes, supplier = stimuli, customer = studies,
orders = samples, lineitem = expression statistics, documents = free text, events = the
incremental feed. Ids are derived inside each query; a derivation shared by both sides is one
SQL text that either engine reads the same way.
"""

from helixmart.queries.base import ORACLES, QUERIES
from helixmart.queries import (  # noqa: F401  (importing registers the queries)
    analytics,
    enrichment,
    identifiers,
    loading,
    matrices,
    ruling,
    scanning,
    staging,
    texts,
)

__all__ = ["QUERIES", "ORACLES"]
