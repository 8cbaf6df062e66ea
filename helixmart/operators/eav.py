"""Attribute-value form: unpivot, column rules, staged value sets and their zip to rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixmart.functions.registry import LEGACY, Lookup, Registry
from helixmart.operators.enrich import ENRICHMENTS
from helixmart.operators.numbering import number_distinct
from helixmart.operators.rules import full_match


def mapped_columns(columns: list[str], group: str, mapping: dict, skip: set[str] = frozenset()) -> list[str]:
    """Columns ``c`` for which ``group.c`` is a mapping key, without those in ``skip``."""
    known = mapping["columns"]
    return [c for c in columns if c not in skip and f"{group}.{c}" in known]


def to_items(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One ``(column, value)`` row per cell, NULL cells included."""
    columns = df.columns if columns is None else columns
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, value string")
    text = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return text.unpivot([], [F.col(f"`{c}`") for c in columns], "column", "value")


def column_rules(mapping: dict) -> dict[str, tuple[str, dict]]:
    """Column name -> (key, spec) where exactly one mapping key ends with ``.name``."""
    owners: dict[str, list[str]] = {}
    for key in mapping["columns"]:
        parts = key.split(".")
        for i in range(1, len(parts)):
            owners.setdefault(".".join(parts[i:]), []).append(key)
    return {name: (keys[0], mapping["columns"][keys[0]]) for name, keys in owners.items() if len(keys) == 1}


def _cases(pairs: list[tuple[Column, Column]]) -> Column:
    (cond, value), *rest = pairs
    return reduce(lambda acc, p: acc.when(*p), rest, F.when(cond, value))


def harmonize_items(
    items: DataFrame,
    mapping: dict,
    registry: Registry = LEGACY,
    references: dict | None = None,
    apply_regex: bool = False,
    salts: int = 0,
) -> DataFrame:
    """``(column, value)`` items -> ``(target_table, target_column, value)`` rows.

    Items without a unique rule are dropped. Column-only chains run in one pass over the
    items; each chain with a lookup runs on its own column's items.
    """
    plain, joined = [], []
    for name, (_, spec) in column_rules(mapping).items():
        chain = registry.resolve(spec.get("transforms") or [])
        (joined if any(isinstance(s, Lookup) for s in chain) else plain).append((name, spec, chain))

    def wanted(name, spec):
        cond = F.col("column") == name
        if apply_regex and spec.get("regex"):
            cond = cond & full_match(F.col("value"), spec["regex"])
        return cond

    parts = []
    if plain:
        keep = reduce(lambda a, b: a | b, [wanted(n, s) for n, s, _ in plain])
        value = _cases(
            [
                (F.col("column") == n, reduce(lambda c, step: step.apply(c), chain, F.col("value")).cast("string"))
                for n, _, chain in plain
            ]
        )
        parts.append(
            items.filter(keep).select(
                _cases([(F.col("column") == n, F.lit(s["target_table"])) for n, s, _ in plain]).alias("target_table"),
                _cases([(F.col("column") == n, F.lit(s["target_column"])) for n, s, _ in plain]).alias("target_column"),
                value.alias("value"),
            )
        )
    for name, spec, chain in joined:
        df = items.filter(wanted(name, spec)).select("value")
        for step in chain:
            if isinstance(step, Lookup):
                df = df.withColumnRenamed("value", "_key")
                df = ENRICHMENTS[step.kind](df, "_key", "value", (references or {}).get(step.kind, {}), salts=salts).drop("_key")
            else:
                df = df.withColumn("value", step.apply(F.col("value")))
        parts.append(
            df.select(
                F.lit(spec["target_table"]).alias("target_table"),
                F.lit(spec["target_column"]).alias("target_column"),
                F.col("value").cast("string").alias("value"),
            )
        )
    if not parts:
        return items.sparkSession.createDataFrame([], "target_table string, target_column string, value string")
    return reduce(DataFrame.unionAll, parts)


def staged_values(*rows: DataFrame) -> DataFrame:
    """Distinct values per target column over all inputs, NULL kept as a member.

    Long form on purpose: one row per member instead of one growing array per column.
    """
    return reduce(DataFrame.unionAll, rows).select("target_table", "target_column", "value").distinct()


def staged_sizes(staged: DataFrame) -> DataFrame:
    """Members per target column, and whether NULL is one of them."""
    return staged.groupBy("target_table", "target_column").agg(
        F.count(F.lit(1)).alias("n_values"), F.max(F.col("value").isNull()).alias("has_null")
    )


def longest_column(staged: DataFrame) -> DataFrame:
    """Length of the longest column per table."""
    return staged_sizes(staged).groupBy("target_table").agg(F.max("n_values").alias("n_rows"))


def zip_columns(staged: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Rows of ``table``: i-th value of each column with the i-th of the others, NULL-padded.

    Sets have no order, so the pairing follows the digest order of
    :func:`helixmart.operators.numbering.number_distinct`.
    """
    mine = staged.filter((F.col("target_table") == table) & F.col("target_column").isin(columns))
    numbered = number_distinct(mine.select("target_column", "value"), "value", ["target_column"])
    return (
        numbered.groupBy("n")
        .agg(*[F.max(F.when(F.col("target_column") == c, F.col("value"))).alias(c) for c in columns])
    )
