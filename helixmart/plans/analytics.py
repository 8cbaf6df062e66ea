"""Expression analytics on the warehouse tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixmart.operators.joins import skew_join

_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def group_means(df: DataFrame, by: list[str], value: str, out: str = "mean_value") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"), F.avg(value).alias(out))


def fold_change(
    df: DataFrame, by: list[str], condition: str, treated: str, control: str, value: str, pseudo: float = 1.0
) -> DataFrame:
    """log2 ratio of the mean values of two conditions, in one aggregation."""

    def mean_of(level: str) -> Column:
        return F.avg(F.when(F.col(condition) == level, F.col(value)))

    means = (
        df.filter(F.col(condition).isin(treated, control))
        .groupBy(*by)
        .agg(mean_of(treated).alias("mean_treated"), mean_of(control).alias("mean_control"))
    )
    ratio = (F.col("mean_treated") + pseudo) / (F.col("mean_control") + pseudo)
    return means.withColumn("log2_fc", F.log2(ratio))


def _bucket(p: Column, slices: int) -> Column:
    # Monotone in p: binary exponent first, then equal slices inside the power of two.
    exponent = F.floor(F.log2(p))
    inside = F.floor((p / F.pow(F.lit(2.0), exponent) - 1) * slices)
    return F.when(p <= 0, F.lit(-(1 << 30))).otherwise(exponent * slices + inside).cast("bigint")


def adjusted_p(df: DataFrame, p: str, groups: list[str] | None = None, slices: int = 1024) -> DataFrame:
    """Benjamini-Hochberg adjusted value of every distinct p: ``(groups, p, n_rows, fdr)``.

    Equal p values are counted together first. Ranks and running minima are then taken in two
    levels, over ordered buckets and inside each bucket, so no task holds all p values: the
    bucket table has at most ``slices`` rows per power of two, the rest is split by bucket.
    """
    groups = groups or []
    # Join keys that cannot be NULL: rows of a NULL group stay together, and the branches below
    # share one scan and one shuffle instead of differing by a pushed-down NULL filter.
    group = F.struct(*groups) if groups else F.lit(0)
    bucket = F.coalesce(_bucket(F.col(p), slices), F.lit(0).cast("bigint"))
    tally = df.filter(F.col(p).isNotNull()).groupBy(*groups, p).agg(F.count(F.lit(1)).alias("n_rows"))
    dealt = tally.select("*", group.alias("_g"), bucket.alias("_b"))
    key = ["_g", "_b"]
    inside = Window.partitionBy(*key)
    whole = Window.partitionBy("_g")

    sizes = dealt.groupBy(*key).agg(F.sum("n_rows").alias("_size"))
    before = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *key, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_off"), F.sum("_size").over(whole).alias("_m")
    )
    ranked = dealt.withColumn("_cum", F.sum("n_rows").over(inside.orderBy(p).rowsBetween(*_SO_FAR))).join(offsets, key)
    raw = ranked.withColumn("_q", F.col(p) * F.col("_m") / (F.col("_off") + F.col("_cum")))

    lows = raw.groupBy(*key).agg(F.min("_q").alias("_low"))
    after = whole.orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    later = lows.select(*key, F.min("_low").over(after).alias("_later"))
    return (
        raw.withColumn("_own", F.min("_q").over(inside.orderBy(F.desc(p)).rowsBetween(*_SO_FAR)))
        .join(later, key)
        .select(*groups, p, "n_rows", F.least("_own", "_later", F.lit(1.0)).alias("fdr"))
    )


def volcano(
    df: DataFrame,
    effect: str,
    p: str,
    min_effect: float,
    max_fdr: float,
    groups: list[str] | None = None,
    slices: int = 1024,
    salts: int = 0,
) -> DataFrame:
    """Rows with a large effect and a small adjusted p, plus their ``fdr``."""
    groups = groups or []
    group = F.struct(*groups) if groups else F.lit(0)
    passing = adjusted_p(df, p, groups, slices).filter(F.col("fdr") <= max_fdr)
    keyed = passing.select(group.alias("_g"), p, "fdr")
    strong = df.filter(F.abs(effect) >= min_effect).withColumn("_g", group)
    return skew_join(strong, keyed, ["_g", p], "inner", salts).select(*df.columns, "fdr")


def top_hits(df: DataFrame, where: Column, effect: str, tie: list[str], k: int) -> DataFrame:
    """The ``k`` rows with the largest effect among those that satisfy ``where``."""
    return df.filter(where).orderBy(F.desc(effect), *tie).limit(k)


def hits_per_day(df: DataFrame, pathways: Column, day: Column) -> DataFrame:
    """``(pathway, day, n_hits)``: one hit counts for each of its pathways."""
    return (
        df.select(F.explode(pathways).alias("pathway"), day.alias("day"))
        .groupBy("pathway", "day")
        .agg(F.count(F.lit(1)).alias("n_hits"))
    )


def rolling_hits(daily: DataFrame, rows_back: int) -> DataFrame:
    """Rolling mean of daily hits; works on the daily counts, not on the hits."""
    frame = Window.partitionBy("pathway").orderBy("day").rowsBetween(-rows_back, 0)
    return daily.withColumn("rolling_mean", F.avg("n_hits").over(frame))


def profile_similarity(
    df: DataFrame, feature: str, group: str, value: str, left: list[str], right: list[str]
) -> DataFrame:
    """Correlation of mean profiles for each (left, right) pair of named groups.

    One pivoted aggregation gives a row per feature, a second one all correlations; groups are
    never paired row by row.
    """
    names = list(dict.fromkeys([*left, *right]))
    column = {n: f"_g{i}" for i, n in enumerate(names)}
    wide = (
        df.filter(F.col(group).isin(names))
        .groupBy(feature)
        .agg(*[F.avg(F.when(F.col(group) == n, F.col(value))).alias(c) for n, c in column.items()])
    )
    pairs = [(a, b) for a in left for b in right]
    cells = wide.agg(*[F.corr(column[a], column[b]).alias(f"_c{i}") for i, (a, b) in enumerate(pairs)])
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("left_group"), F.lit(b).alias("right_group"), F.col(f"_c{i}").alias("similarity"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return cells.select(F.inline(rows))


def flows(links: DataFrame, steps: list[tuple[DataFrame, list[str]]], path: list[str], salts: int = 0) -> DataFrame:
    """Counts per distinct path through link tables (microbe -> metabolite -> cell type).

    Each step joins ``(table, keys)``. The one shuffle of the count carries partial counts, so
    its size follows the number of distinct paths, not of links.
    """
    out = links
    for table, keys in steps:
        out = skew_join(out, table, keys, "inner", salts)
    return out.groupBy(*path).agg(F.count(F.lit(1)).alias("n_links"))


def edges(paths: DataFrame, source: str, target: str) -> DataFrame:
    """Weights of one Sankey layer."""
    return paths.groupBy(F.col(source).alias("source"), F.col(target).alias("target")).agg(
        F.sum("n_links").alias("n_links")
    )
