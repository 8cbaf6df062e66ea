"""Tab-separated text."""

from __future__ import annotations

import csv
import io
import re
import sys
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from helixmart.operators.align import union_by_name
from helixmart.sources import quoted

# The header reader travels to the executors by value: workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# --- fixed values -----------------------------------------------------------------------
# Texts the attribute reader takes for missing values.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
# ----------------------------------------------------------------------------------------

_CORRUPT = "_corrupt_line"
# Place of a row in the files: sorts as the rows stand there.
ORDER = "_row_order"


def _read_first_lines(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    from pyarrow import fs

    def first_line(path: str) -> str:
        if path.startswith("file:"):
            path = "/" + path[len("file:"):].lstrip("/")
        elif path.startswith(("s3a:", "s3n:")):  # other names of one store
            path = "s3:" + quote(path[4:], safe=":/@")
        else:
            path = quote(path, safe=":/@")
        filesystem, inner = fs.FileSystem.from_uri(path)
        with filesystem.open_input_stream(inner) as raw:
            return io.TextIOWrapper(raw, encoding="utf8", newline="").readline().rstrip("\r\n")

    for batch in batches:
        yield pd.DataFrame({"path": batch["path"], "header": [first_line(p) for p in batch["path"]]})


def headers_of(files: DataFrame) -> DataFrame:
    """``(path, header)`` of catalogued files; each task reads only the first line of its files."""
    return files.select("path").mapInPandas(_read_first_lines, "path string, header string")


def header_schema(header: str) -> tuple[StructType, list[str]]:
    """All-text schema of a header line and the columns to keep (the last of equal names)."""
    names = next(csv.reader([header], delimiter="\t"), [])
    last = {n: i for i, n in enumerate(names)}
    fields = [n if last[n] == i else f"_dup{i}_{n}" for i, n in enumerate(names)]
    return StructType([StructField(n, StringType()) for n in fields]), [n for i, n in enumerate(names) if last[n] == i]


def _options(reader, multi_line: bool):
    return (
        reader.option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"')
        .option("mode", "PERMISSIVE").option("multiLine", multi_line).option("encoding", "UTF-8")
    )


def read_tsv(
    spark: SparkSession, paths: list[str], header: str, multi_line: bool | None = None, with_file: bool = False,
    with_order: bool = False,
) -> DataFrame:
    """All-text rows of files that share one header line.

    Blank lines are skipped, short rows end in NULL, extra cells are ignored, an empty cell is NULL. Cells may hold
    doubled quotes and, inside quotes, line breaks: by default one scan finds the files with such breaks, and
    those are read as :mod:`helixmart.sources.quoted` does, all others by Spark's reader; both by splits. ``False``
    says that there are no such breaks and saves the scan, ``True`` reads a file in one task. ``with_order`` adds
    ``ORDER``.
    """
    schema, keep = header_schema(header)
    broken = quoted.files_with_breaks(spark, paths) if multi_line is None else set()
    frames = []
    if broken:
        known = [r["path"] for r in spark.read.format("binaryFile").load(paths).select("path").collect()]
        name = {_plain_path(p): p for p in known}
        apart = {_plain_path(p) for p in broken}
        frames.append(_quoted_rows(spark, [name[p] for p in sorted(apart)], schema, keep, with_file, with_order))
        paths = [p for k, p in sorted(name.items()) if k not in apart]
    if paths:
        df = _options(spark.read.schema(schema), bool(multi_line)).csv(paths)
        extra = [F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("_file")] if with_file else []
        if with_order:
            place = F.struct(
                F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            )
            extra.append(place.alias(ORDER))
        frames.append(df.select(*[F.col(f"`{c}`") for c in keep], *extra))
    return union_by_name(*frames)


def _plain_path(path: str) -> str:
    """One spelling of a file's name, however its URI is written."""
    return re.sub(r"^([a-z0-9]+):/+", r"\1:/", unquote(path))


def _quoted_rows(spark: SparkSession, paths: list[str], schema: StructType, keep: list[str], with_file: bool, with_order: bool) -> DataFrame:
    found = quoted.records(spark, paths)
    cells = F.from_csv(
        "value", ", ".join(f"c{i} string" for i in range(len(schema))),
        {"sep": "\t", "quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "lineSep": "\n"},
    )
    extra = [F.col("path").alias("_path"), F.col("file").alias("_file")] if with_file else []
    if with_order:
        extra.append(F.struct("path", "block", "row").alias(ORDER))
    place = {f.name: i for i, f in enumerate(schema)}
    return found.withColumn("cells", cells).select(*[F.col(f"cells.c{place[c]}").alias(c) for c in keep], *extra)


def read_tsv_files(
    files: DataFrame, multi_line: bool | None = None, with_file: bool = False, with_order: bool = False
) -> DataFrame:
    """Rows of all catalogued files, each read by its own header, under the union of columns.

    Spark reads one path list per *distinct* header, not per file.
    """
    spark = files.sparkSession
    groups: dict[str, list[str]] = {}
    for row in headers_of(files).collect():
        groups.setdefault(row["header"], []).append(row["path"])
    frames = [read_tsv(spark, sorted(p), h, multi_line, with_file, with_order) for h, p in sorted(groups.items()) if h]
    if not frames:
        raise ValueError("no file with a header line")
    return union_by_name(*frames)


def sample_of_file(name: Column) -> Column:
    """Sample id in a raw-count file's name."""
    return F.regexp_replace(F.regexp_replace(name, r"\.tsv\z", ""), "_raw_counts", "")


def read_raw_counts(spark: SparkSession, folder: str | list[str]) -> DataFrame:
    """``(sample_id, gene_iri, count)`` from all ``<sample>_raw_counts.tsv`` files below a folder, or of a list."""
    reader = (
        _options(spark.read.schema("gene_iri string, count string"), False)
        .option("enforceSchema", False)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*_raw_counts.tsv")
    )
    return reader.csv(folder).select(
        sample_of_file(F.col("_metadata.file_name")).alias("sample_id"),
        "gene_iri",
        F.col("count").cast("bigint").alias("count"),
    )


def read_attribute_tsv(spark: SparkSession, path: str | list[str], header: str) -> DataFrame:
    """First-generation reader: missing-value texts are NULL, lines with too many cells skipped,
    short lines padded."""
    schema, keep = header_schema(header)
    with_line = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    df = _options(spark.read.schema(with_line), False).option("columnNameOfCorruptRecord", _CORRUPT).csv(path)
    unquoted = F.regexp_replace(F.col(_CORRUPT), '"[^"]*"', "")
    cells = F.size(F.split(unquoted, "\t", -1))
    fits = F.col(_CORRUPT).isNull() | (cells <= len(schema))
    return df.filter(fits).select(
        *[F.when(~F.col(f"`{c}`").isin(MISSING_TOKENS), F.col(f"`{c}`")).alias(c) for c in keep]
    )


def read_headerless(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated rows without a header; missing trailing cells are NULL."""
    return spark.read.schema(schema).option("sep", "\t").option("quote", '"').option("escape", '"').csv(path)


def with_line_index(df: DataFrame, out: str = "index") -> DataFrame:
    """Add the 1-based position of each row in its file, computed by the scan's blocks.

    Rows of one block are read in order by one task. Block sizes give each block's offset, so
    no row passes through a single task. ``df`` must be a plain file scan.
    """
    from pyspark.sql import Window

    placed = df.select(
        "*", F.col("_metadata.file_path").alias("_of"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    blocks = placed.groupBy("_of", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("_of").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select("_of", "_block", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    joined = placed.join(offsets, ["_of", "_block"])
    return joined.select(*df.columns, (F.col("_off") + F.col("_at") - F.col("_first") + 1).alias(out))


def first_existing(columns: list[str], candidates: tuple[str, ...]) -> str:
    for c in candidates:
        if c in columns:
            return c
    raise ValueError(f"none of {candidates} among {columns}")


