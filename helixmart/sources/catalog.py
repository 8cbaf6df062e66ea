"""File discovery and routing of files to logical tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------
# File-name pattern -> table; the first pattern contained in the name wins.
ROUTES = [
    ("gene_catalog.tsv", "Genes"),
    ("taxa_catalog.tsv", "Taxa"),
    ("microbe_catalog.tsv", "Microbes"),
    ("stimulus_catalog.tsv", "Stimuli"),
    ("ontology_terms.tsv", "OntologyTerms"),
    ("study_catalog.tsv", "Studies"),
    ("sample_microbe.tsv", "SampleMicrobe"),
    ("sample_stimulus.tsv", "SampleStimulus"),
    ("microbe_stimulus.tsv", "MicrobeStimulus"),
    ("experiment_", "Samples"),
    ("_raw_counts.tsv", "RawCounts"),
]

# Load order: referenced tables first.
LOAD_PRIORITY = {
    "Stimuli": 1,
    "Taxa": 2,
    "OntologyTerms": 3,
    "Studies": 4,
    "Microbes": 5,
    "Genes": 6,
    "Samples": 7,
    "ExpressionStats": 8,
    "SampleMicrobe": 9,
    "SampleStimulus": 9,
    "MicrobeStimulus": 9,
}
UNKNOWN_PRIORITY = 100
RAW_COUNTS = "RawCounts"
RAW_SUFFIX = "_raw_counts.tsv"
RAW_LIKE_NAMES = "raw|count|idf"
MODES = ("all", "metadata", "raw_counts")
# ----------------------------------------------------------------------------------------


def _listing(spark: SparkSession, folder: str, pattern: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    # The file content is never selected, so it is never read.
    return reader.load(folder).select(
        "path", F.substring_index("path", "/", -1).alias("name"), "length", "modificationTime"
    )


def discover_files(spark: SparkSession, folder: str, extensions: tuple[str, ...] = (".tsv", ".zarr")) -> DataFrame:
    """Files below ``folder`` with one of the extensions (names starting with . or _ are hidden)."""
    return _listing(spark, folder, "*{" + ",".join(extensions) + "}")


def discover_any(spark: SparkSession, folder: str) -> DataFrame:
    """Every visible file below ``folder``, each once."""
    return _listing(spark, folder, None).filter(~F.col("name").startswith("."))


def table_of(name: Column) -> Column:
    """Logical table of a file name; NULL when no pattern occurs in it."""
    (pattern, table), *rest = ROUTES
    return reduce(
        lambda acc, r: acc.when(name.contains(r[0]), F.lit(r[1])), rest, F.when(name.contains(pattern), F.lit(table))
    )


def priority_of(table: Column) -> Column:
    (name, rank), *rest = LOAD_PRIORITY.items()
    chain = reduce(lambda acc, r: acc.when(table == r[0], F.lit(r[1])), rest, F.when(table == name, F.lit(rank)))
    return chain.otherwise(F.lit(UNKNOWN_PRIORITY))


def check_mode(mode: str, modes: tuple[str, ...] = MODES) -> None:
    if mode not in modes:
        raise ValueError(f"mode is {mode!r}, and can only be one of: {', '.join(modes)}")


def in_mode(name: Column, mode: str) -> Column:
    check_mode(mode)
    raw = name.endswith(RAW_SUFFIX)
    return {"all": F.lit(True), "metadata": ~raw, "raw_counts": raw}[mode]


def is_raw_like(name: Column) -> Column:
    """Names the attribute reader skips: raw, count or idf anywhere, any case."""
    return F.lower(name).rlike(RAW_LIKE_NAMES)


def route_files(files: DataFrame, mode: str = "all", name: str = "name") -> DataFrame:
    """Add ``table`` and ``priority`` to the files of a mode."""
    routed = files.filter(in_mode(F.col(name), mode)).withColumn("table", table_of(F.col(name)))
    return routed.withColumn("priority", priority_of(F.col("table")))


def in_load_order(files: DataFrame, path: str = "path") -> DataFrame:
    return files.orderBy("priority", path)


def only_loadable(files: DataFrame) -> DataFrame:
    """Known tables that go to the database: no raw counts, no unrouted files."""
    return files.filter(F.col("table").isNotNull() & (F.col("table") != RAW_COUNTS))
