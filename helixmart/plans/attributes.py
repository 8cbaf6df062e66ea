"""The attribute-value load: mapped columns -> items -> distinct sets -> zipped rows -> upsert."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from helixmart.functions.registry import LEGACY, Registry
from helixmart.operators.eav import harmonize_items, mapped_columns, staged_values, to_items, zip_columns
from helixmart.session import scratch_path
from helixmart.sinks.merge import read_target, upsert
from helixmart.sources.annotated import mapped_items, raw_count_uris
from helixmart.sources.catalog import check_mode, discover_any, is_raw_like
from helixmart.sources.tsv import header_schema, headers_of, read_attribute_tsv

MODES = ("metadata", "counts", "both")


def file_items(
    spark: SparkSession, folder: str, mapping: dict, mode: str = "metadata", skip: frozenset = frozenset()
) -> DataFrame:
    """Items of all ``.tsv``/``.txt`` files whose stem occurs in the mapping, raw counts aside.

    Spark plans one scan per (stem, header) pair, and stems are bounded by the mapping.
    """
    check_mode(mode, MODES)
    empty = spark.createDataFrame([], "column string, value string")
    if mode == "counts":
        return empty
    stems = sorted({key.split(".")[0] for key in mapping["columns"]})
    stem = F.regexp_replace("name", r"\.(tsv|txt)\z", "")
    files = (
        discover_any(spark, folder)
        .filter(F.col("name").rlike(r"\.(tsv|txt)\z") & ~is_raw_like(F.col("name")))
        .withColumn("stem", stem)
        .filter(F.col("stem").isin(stems))
    )
    groups: dict[tuple[str, str], list[str]] = {}
    for row in headers_of(files).collect():
        name = row["path"].rsplit("/", 1)[-1].rsplit(".", 1)[0]
        groups.setdefault((name, row["header"]), []).append(row["path"])
    parts = [empty]
    for (name, header), paths in sorted(groups.items()):
        columns = mapped_columns(header_schema(header)[1], name, mapping, skip)
        if columns:
            parts.append(to_items(read_attribute_tsv(spark, paths, header), columns))
    return reduce(DataFrame.unionAll, parts)


def store_items(spark: SparkSession, store: str, mapping: dict, mode: str = "metadata") -> DataFrame:
    """Items of an annotated store: mapped metadata, one URI per sample for ``counts``, or both."""
    check_mode(mode, MODES)
    parts = [spark.createDataFrame([], "column string, value string")]
    if mode != "counts":
        parts.append(mapped_items(spark, store, mapping))
    if mode != "metadata":
        parts.append(raw_count_uris(spark.read.parquet(f"{store}/obs"), store))
    return reduce(DataFrame.unionAll, parts)


def load_items(
    items: DataFrame,
    mapping: dict,
    root: str,
    keys: dict[str, list[str]],
    registry: Registry = LEGACY,
    references: dict | None = None,
) -> dict[str, int]:
    """Harmonise items and upsert the zipped rows; ``{table: rows afterwards}``."""
    spark = items.sparkSession
    path = scratch_path(spark, "staged")
    # Every target table reads the staged sets: write them once instead of recomputing them.
    staged_values(harmonize_items(items, mapping, registry, references)).write.parquet(path)
    staged = spark.read.schema("target_table string, target_column string, value string").parquet(path)
    targets: dict[str, list[str]] = {}
    for spec in mapping["columns"].values():
        columns = targets.setdefault(spec["target_table"], [])
        if spec["target_column"] not in columns:
            columns.append(spec["target_column"])
    found = {
        (r["target_table"], r["target_column"])
        for r in staged.select("target_table", "target_column").distinct().collect()
    }
    stats: dict[str, int] = {}
    for table, wanted in targets.items():
        columns = [c for c in wanted if (table, c) in found]
        if not columns:
            continue
        rows = zip_columns(staged, table, columns).drop("n")
        target = f"{root}/{table}"
        schema = StructType([StructField(c, StringType()) for c in wanted])
        stats[table] = upsert(rows, target, [k for k in keys[table] if k in columns] or columns, schema=schema)
    return stats


def stored(spark: SparkSession, root: str, table: str, columns: list[str]) -> DataFrame:
    return read_target(spark, f"{root}/{table}", StructType([StructField(c, StringType()) for c in columns]))
