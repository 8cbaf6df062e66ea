"""New files -> harmonised rows -> keep-first inserts, one micro-batch at a time."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from helixmart.functions.registry import CURRENT, Registry
from helixmart.operators.align import align
from helixmart.operators.rules import harmonize, load_rules
from helixmart.plans import pipeline
from helixmart.plans.schemas import KEYS, TABLES
from helixmart.session import scratch_path
from helixmart.sinks.buckets import insert_batch
from helixmart.sources.catalog import route_files
from helixmart.sources.envelope import SCHEMA as ENVELOPE
from helixmart.sources.envelope import quarantine_unrouted, rows_of, split_by_table
from helixmart.sources.tsv import header_schema


def stream_tsv(spark: SparkSession, folder: str, header: str, pattern: str = "*.tsv", files_per_batch: int = 1000) -> DataFrame:
    schema, keep = header_schema(header)
    stream = (
        spark.readStream.schema(schema)
        .option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"')
        .option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )
    return stream.select(*[f"`{c}`" for c in keep])


def stream_envelopes(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(ENVELOPE).option("maxFilesPerTrigger", files_per_batch).json(folder)


def stream_parquet(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def stream_files(spark: SparkSession, folder: str, extensions: tuple[str, ...] = (".tsv",), files_per_batch: int = 1000) -> DataFrame:
    """New files below ``folder``, by (path, name); their contents are not read."""
    listing = (
        spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*{" + ",".join(extensions) + "}")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(folder)
    )
    return listing.select("path", F.substring_index("path", "/", -1).alias("name"))


def for_each_batch(stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``load`` on everything that is new, then stop. The checkpoint remembers the files."""
    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest(
    stream: DataFrame,
    table: str,
    rules: dict,
    path: str,
    checkpoint: str,
    keys: list[str] | None = None,
    schema=None,
    references: dict | None = None,
    on_inserted: Callable[[int, int], None] | None = None,
) -> StreamingQuery:
    """Harmonise and insert each micro-batch. A replayed batch leaves every table as it was."""

    def load(batch: DataFrame, batch_id: int) -> None:
        rows = align(harmonize(batch, table, rules, references), schema or TABLES[table])
        inserted = insert_batch(rows, path, keys or KEYS[table], batch_name(checkpoint, batch_id))
        if on_inserted:
            on_inserted(batch_id, inserted)

    return for_each_batch(stream, load, checkpoint)


def ingest_routed(
    stream: DataFrame,
    mapping: dict | str,
    root: str,
    checkpoint: str,
    mode: str = "all",
    registry: Registry = CURRENT,
    references: dict | None = None,
    keys: dict[str, list[str]] = KEYS,
    on_error: str = "fail",
    on_loaded: Callable[[int, dict[str, int]], None] | None = None,
) -> StreamingQuery:
    """Load new TSV files of any table: each micro-batch of ``stream_files`` is routed, read by the files' own headers,
    harmonised and inserted as ``pipeline.run`` does, referenced tables first.

    A file is loaded once; a batch that runs again leaves every table, the raw counts and the quarantine as they were.
    """
    rules = load_rules(mapping, registry)

    def load(batch: DataFrame, batch_id: int) -> None:
        # A micro-batch of files is a short list: pin it, so that every table is routed from the same one.
        paths = [(r["path"], r["name"]) for r in batch.select("path", "name").collect()]
        files = route_files(batch.sparkSession.createDataFrame(paths, "path string, name string"), mode)
        stats = pipeline.load_files(files, rules, root, keys, references, on_error, named=batch_name(checkpoint, batch_id))
        if on_loaded:
            on_loaded(batch_id, stats)

    return for_each_batch(stream, load, checkpoint)


def batch_name(checkpoint: str, batch_id: int) -> str:
    """Name of a micro-batch that no other stream's batches have."""
    return f"{hashlib.md5(checkpoint.encode()).hexdigest()[:12]}-{batch_id}"


def load_envelopes_batch(batch: DataFrame, name: str, root: str, keys: dict[str, list[str]] = KEYS) -> dict[str, int]:
    """Insert one named batch of envelopes, parsed once, referenced tables first; {table: rows inserted}.

    Envelopes of other tables are kept below ``root/_quarantine``: a checkpoint will not offer them again. Running
    the same batch again changes nothing.
    """
    spark = batch.sparkSession
    envelopes = split_by_table(batch, scratch_path(spark, "envelopes"))
    present = {r["table"] for r in envelopes.select("table").distinct().collect()}
    if present - set(keys):
        quarantine_unrouted(envelopes, keys, root, name)
    out = {}
    for table, key in keys.items():
        if table in present:
            rows = align(rows_of(envelopes, table, TABLES[table].names), TABLES[table])
            out[table] = insert_batch(rows, f"{root}/{table}", key, name)
    return out


def ingest_envelopes(stream: DataFrame, root: str, checkpoint: str, keys: dict[str, list[str]] = KEYS) -> StreamingQuery:
    """Route each micro-batch of envelopes to its tables, as ``load_envelopes_batch`` does."""

    def load(batch: DataFrame, batch_id: int) -> None:
        load_envelopes_batch(batch, batch_name(checkpoint, batch_id), root, keys)

    return for_each_batch(stream, load, checkpoint)
