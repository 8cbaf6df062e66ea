"""Lists inside cells, JSON, dates, numbers and fall-backs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from helixmart.functions.text import WHITESPACE, blank_to_null, strip


def split_commas(c: Column) -> Column:
    """Trimmed, non-blank tokens; NULL gives an empty list."""
    tokens = F.filter(F.transform(F.split(c, ","), strip), lambda t: t != "")
    return F.coalesce(tokens, F.array().cast("array<string>"))


def split_semicolons(c: Column) -> Column:
    tokens = F.transform(F.split(c, ";"), strip)
    return F.filter(tokens, lambda t: t != "")


def split_go_terms(c: Column) -> Column:
    return F.split(c, r"\|")


def split_payload(c: Column) -> Column:
    """Drop a leading tag (through the first ``:`` or ``,``), then split on commas."""
    return F.split(F.regexp_replace(c, r"\A[^:,]*[:,]", ""), ",")


def json_list(c: Column) -> Column:
    return F.to_json(c)


def json_field(c: Column, path: str, default=None) -> Column:
    """Value at a JSON path as text; ``default`` when it is missing."""
    value = F.get_json_object(c, path)
    return value if default is None else F.coalesce(value, F.lit(default))


def first_filled(*cs: Column) -> Column:
    """First value that is neither NULL nor empty."""
    return F.coalesce(*[blank_to_null(c) for c in cs])


def date_prefix(c: Column) -> Column:
    return F.substring(c, 1, 10)


def gene_length(start: Column, end: Column) -> Column:
    """Inclusive length; NULL when there is no end position or the length is zero."""
    return F.nullif(F.when(end != 0, end - start + 1), F.lit(0))


def downgrade_significance(p: Column, label: Column, limit: float = 0.05, weak: str = "NS") -> Column:
    return F.when(p > limit, F.lit(weak)).otherwise(label)


__all__ = [
    "WHITESPACE",
    "split_commas",
    "split_semicolons",
    "split_go_terms",
    "split_payload",
    "json_list",
    "json_field",
    "first_filled",
    "date_prefix",
    "gene_length",
    "downgrade_significance",
]
