"""The load pipeline: discover, route, scan, harmonise, align, insert."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from helixmart.functions.registry import CURRENT, Registry
from helixmart.operators.align import align
from helixmart.operators.rules import harmonize, load_rules, split_quarantine
from helixmart.plans.schemas import KEYS, TABLES
from helixmart.session import scratch_path
from helixmart.sinks.buckets import BATCH, insert_batch
from helixmart.sinks.export import append_audit, write_raw_counts
from helixmart.sinks.merge import insert_ignore
from helixmart.sources.catalog import RAW_COUNTS, discover_files, route_files
from helixmart.sources.envelope import quarantine_unrouted, read_envelopes, rows_of, split_by_table
from helixmart.sources.tsv import ORDER, read_raw_counts, read_tsv_files


def tables_to_load(files: DataFrame) -> list[str]:
    """Tables present among routed files, referenced ones first (a dozen names at most)."""
    rows = (
        files.filter(F.col("table").isNotNull()).select("priority", "table").distinct().orderBy("priority", "table")
    )
    return [r["table"] for r in rows.collect()]


def load_table(
    rows: DataFrame,
    table: str,
    rules: dict,
    root: str,
    keys: dict[str, list[str]] = KEYS,
    references: dict | None = None,
    on_error: str = "fail",
    audit: bool = False,
    batch: str = "",
    named: str | None = None,
) -> int:
    """Harmonise, align and insert the rows of one table; returns the rows inserted.

    ``named`` makes them a batch that changes nothing when it runs again (see ``insert_batch``).
    """
    started = time.time()
    shaped = harmonize(rows, table, rules, references, on_error)
    if on_error == "quarantine":
        shaped, rejected = split_quarantine(shaped)
        aside = f"{root}/_quarantine/{table}"
        if named:
            rejected.drop(ORDER).write.mode("overwrite").parquet(f"{aside}/{BATCH}={named}")
        else:
            rejected.drop(ORDER).write.mode("append").parquet(aside)
    order = [ORDER] if ORDER in shaped.columns else []
    target = StructType([*TABLES[table].fields, *[shaped.schema[c] for c in order]])
    aligned = align(shaped, target, lenient=on_error == "quarantine")
    if named:
        inserted = insert_batch(aligned, f"{root}/{table}", keys[table], named, order, transient=order)
    else:
        inserted = insert_ignore(aligned, f"{root}/{table}", keys[table], order, transient=order)
    if audit:
        append_audit(aligned.drop(*order), f"{root}/_audit", table, batch, time.time() - started)
    return inserted


def load_files(
    files: DataFrame,
    rules: dict,
    root: str,
    keys: dict[str, list[str]] = KEYS,
    references: dict | None = None,
    on_error: str = "fail",
    multi_line: bool | None = None,
    audit: bool = False,
    batch: str = "",
    named: str | None = None,
) -> dict[str, int]:
    """Load routed files, referenced tables first; ``{table: rows inserted}``. Raw counts are not counted."""
    spark = files.sparkSession
    stats: dict[str, int] = {}
    for table in tables_to_load(files):
        mine = files.filter(F.col("table") == table)
        if table == RAW_COUNTS:
            paths = [r["path"] for r in mine.select("path").collect()]
            write_raw_counts(read_raw_counts(spark, paths), f"{root}/counts")
            continue
        # The first row of a key is the one that stands first in the files, taken by path.
        rows = read_tsv_files(mine, multi_line, with_order=True)
        stats[table] = load_table(rows, table, rules, root, keys, references, on_error, audit, batch, named)
    return stats


def run(
    spark: SparkSession,
    data_dir: str,
    mapping: dict | str,
    root: str,
    mode: str = "all",
    registry: Registry = CURRENT,
    references: dict | None = None,
    keys: dict[str, list[str]] = KEYS,
    on_error: str = "fail",
    multi_line: bool | None = None,
    audit: bool = False,
) -> dict[str, int]:
    """Load a folder of TSV files below ``root``; ``{table: rows inserted}``.

    Tables follow one another so that references exist first; within a table all files are
    one distributed job. Raw counts go to ``root/counts`` and are not counted.
    """
    rules = load_rules(mapping, registry)
    files = route_files(discover_files(spark, data_dir, (".tsv",)), mode)
    return load_files(files, rules, root, keys, references, on_error, multi_line, audit, data_dir)


def load_envelopes(spark: SparkSession, path: str, root: str, keys: dict[str, list[str]] = KEYS) -> dict[str, int]:
    """Insert ``{"table", "row"}`` JSON lines, parsed once, into their tables.

    Known tables without a key (raw counts) are kept as they came below ``_quarantine``.
    """
    envelopes = split_by_table(read_envelopes(spark, path), scratch_path(spark, "envelopes"))
    present = {r["table"] for r in envelopes.select("table").distinct().collect()}
    unknown = present - set(TABLES)
    if unknown:
        raise ValueError(f"Unknown table(s): {sorted(unknown, key=str)}")
    if present - set(keys):
        quarantine_unrouted(envelopes, keys, root)
    return {
        t: insert_ignore(align(rows_of(envelopes, t, TABLES[t].names), TABLES[t]), f"{root}/{t}", keys[t])
        for t in TABLES
        if t in present and t in keys
    }
