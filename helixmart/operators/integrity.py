"""Referential checks, audits and row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixmart.operators.joins import skew_join


def orphans(child: DataFrame, parent: DataFrame, on: dict[str, str], salts: int = 0) -> DataFrame:
    """Child rows whose key has no parent (a NULL key has none)."""
    return skew_join(child, _keys(parent, on), list(on), "left_anti", salts)


def with_parent(child: DataFrame, parent: DataFrame, on: dict[str, str], salts: int = 0) -> DataFrame:
    """Child rows whose key has a parent."""
    return skew_join(child, _keys(parent, on), list(on), "left_semi", salts)


def _keys(parent: DataFrame, on: dict[str, str]) -> DataFrame:
    return parent.select(*[F.col(p).alias(c) for c, p in on.items()])


def split_valid(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """(rows that satisfy ``valid``, rows that do not or are NULL)."""
    ok = F.coalesce(valid, F.lit(False))
    return df.filter(ok), df.filter(~ok)


def require(df: DataFrame, valid: Column, message: str) -> DataFrame:
    """Fail the job at the first row that does not satisfy ``valid``."""
    ok = F.coalesce(valid, F.lit(False))
    return df.filter(F.when(ok, F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def rows_per_table(frames: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table"), "n_rows") for t, df in frames.items()]
    return reduce(DataFrame.unionAll, parts)


def content_audit(df: DataFrame, source: str | Column = "source") -> DataFrame:
    """Row count and order-free checksum per source.

    The checksum adds row hashes in wide decimals: unlike an exclusive-or, equal rows do not
    cancel out.
    """
    name = F.lit(source) if isinstance(source, str) else source
    hashed = df.select(name.alias("source"), F.xxhash64(*df.columns).cast("decimal(38,0)").alias("_h"))
    return hashed.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("_h").cast("string").alias("checksum")
    )


def digest_audit(df: DataFrame, source: str | Column = "source") -> DataFrame:
    """Row count and order-free digest per source that any engine with md5 can compute; audits of batches add up.

    A row is the text of its columns in order, each after a unit separator, NULL as a zero byte. Its
    md5 gives two pieces of 60 bits, which are added up apart. Floating-point columns have Spark's
    text: cast them to decimals first where another engine shall agree.
    """
    name = F.lit(source) if isinstance(source, str) else source
    text = F.concat(*[F.concat(F.lit("\x1f"), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\x00"))) for c in df.columns])
    # A column of its own, so that the digest is not computed once per piece.
    hashed = df.select(name.alias("source"), F.md5(text.cast("binary")).alias("_md5"))
    piece = lambda at: F.sum(F.conv(F.substring("_md5", at, 15), 16, 10).cast("decimal(20,0)").cast("decimal(28,0)"))
    return hashed.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), piece(1).cast("string").alias("digest_a"), piece(16).cast("string").alias("digest_b")
    )


def merge_audits(audits: DataFrame) -> DataFrame:
    """Audits of parts of a source, from ``digest_audit``, as one audit of the whole; no row is read again."""
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).cast("string").alias(c)
    return audits.groupBy("source").agg(F.sum("n_rows").alias("n_rows"), total("digest_a"), total("digest_b"))
