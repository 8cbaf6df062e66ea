"""Expression analytics and the two ML recipes."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixmart.ml import recipes
from helixmart.plans import analytics
from helixmart.queries.base import query, table


@query("""
SELECT l_returnflag, l_linestatus, count(*) AS n_rows, round(avg(l_quantity), 6) AS mean_value
FROM lineitem GROUP BY 1, 2
""")
def group_means(spark, sf_dir):
    means = analytics.group_means(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_quantity")
    return means.withColumn("mean_value", F.round("mean_value", 6))


@query("""
SELECT l_partkey, round(avg(l_quantity) FILTER (l_returnflag = 'A'), 6) AS mean_treated,
       round(avg(l_quantity) FILTER (l_returnflag = 'R'), 6) AS mean_control,
       round(log2((avg(l_quantity) FILTER (l_returnflag = 'A') + 1) / (avg(l_quantity) FILTER (l_returnflag = 'R') + 1)), 6) AS log2_fc
FROM lineitem WHERE l_returnflag IN ('A', 'R') GROUP BY 1
""")
def fold_change(spark, sf_dir):
    out = analytics.fold_change(
        table(spark, sf_dir, "lineitem"), ["l_partkey"], "l_returnflag", "A", "R", "l_quantity"
    )
    return out.select("l_partkey", *[F.round(c, 6).alias(c) for c in ("mean_treated", "mean_control", "log2_fc")])


@query("""
WITH w AS (SELECT l_partkey, avg(l_quantity) FILTER (l_returnflag = 'A') AS a, avg(l_quantity) FILTER (l_returnflag = 'N') AS n,
                  avg(l_quantity) FILTER (l_returnflag = 'R') AS r FROM lineitem GROUP BY 1)
SELECT 'A' AS left_group, 'N' AS right_group, round(corr(a, n), 6) AS similarity FROM w
UNION ALL SELECT 'A', 'R', round(corr(a, r), 6) FROM w
UNION ALL SELECT 'N', 'R', round(corr(n, r), 6) FROM w
UNION ALL SELECT 'N', 'N', round(corr(n, n), 6) FROM w
""")
def similarity(spark, sf_dir):
    out = analytics.profile_similarity(
        table(spark, sf_dir, "lineitem"), "l_partkey", "l_returnflag", "l_quantity", ["A", "N"], ["N", "R"]
    )
    return out.withColumn("similarity", F.round("similarity", 6))


_P = "l_extendedprice * (l_discount + 0.01) / 20000"
_STATS = f"SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, (l_quantity - 25.0) / 10.0 AS log2_fc, least(1.0, {_P}) AS p_value FROM lineitem"


def _stats(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_returnflag",
        ((F.col("l_quantity") - 25.0) / 10.0).alias("log2_fc"),
        F.least(
            F.lit(1.0), F.col("l_extendedprice") * (F.col("l_discount") + F.lit(0.01)) / F.lit(20000.0)
        ).alias("p_value"),
    )


def _bh(partition: str) -> str:
    return f"""
WITH s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag, (l_quantity - 25.0::DOUBLE) / 10.0::DOUBLE AS log2_fc,
                  least(1.0::DOUBLE, l_extendedprice * (l_discount + 0.01::DOUBLE) / 20000.0::DOUBLE) AS p_value FROM lineitem),
r AS (SELECT *, p_value * count(*) OVER ({partition}) / count(*) OVER ({partition} ORDER BY p_value RANGE UNBOUNDED PRECEDING) AS q FROM s),
f AS (SELECT *, least(1.0::DOUBLE, min(q) OVER ({partition} ORDER BY p_value DESC RANGE UNBOUNDED PRECEDING)) AS fdr FROM r)
"""


@query(_bh("") + """
SELECT l_orderkey, l_linenumber, round(log2_fc, 6) AS log2_fc, round(p_value, 9) AS p_value, round(fdr, 9) AS fdr
FROM f WHERE abs(log2_fc) >= 1 AND fdr <= 0.3
""")
def volcano_bh(spark, sf_dir):
    hits = analytics.volcano(_stats(spark, sf_dir), "log2_fc", "p_value", 1.0, 0.3)
    return hits.select(
        "l_orderkey", "l_linenumber", F.round("log2_fc", 6).alias("log2_fc"),
        F.round("p_value", 9).alias("p_value"), F.round("fdr", 9).alias("fdr"),
    )


@query(_bh("PARTITION BY l_returnflag") + """
SELECT l_returnflag, round(p_value, 9) AS p_value, count(*) AS n_rows, round(fdr, 9) AS fdr
FROM f GROUP BY l_returnflag, f.p_value, f.fdr
""")
def adjusted_p_by_contrast(spark, sf_dir):
    out = analytics.adjusted_p(_stats(spark, sf_dir), "p_value", ["l_returnflag"])
    return out.select("l_returnflag", F.round("p_value", 9).alias("p_value"), "n_rows", F.round("fdr", 9).alias("fdr"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_returnflag = 'R'
ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey LIMIT 10
""")
def top_hits(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return analytics.top_hits(
        rows, F.col("l_returnflag") == "R", "l_quantity", ["l_orderkey", "l_linenumber", "l_partkey"], 10
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


_DAILY = """
SELECT unnest(string_split(p_name, ' ')) AS pathway, strftime(l_shipdate, '%Y-%m') AS day
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag = 'R'
"""


def _hits(spark, sf_dir):
    hits = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select("l_partkey", "l_shipdate")
    genes = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    # Hits per gene and month first: the join then carries counts, not hits.
    return hits.groupBy("l_partkey", F.date_format("l_shipdate", "yyyy-MM").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    ).join(genes, "l_partkey")


@query(f"SELECT pathway, day, count(*) AS n_hits FROM ({_DAILY}) GROUP BY 1, 2")
def pathway_hits(spark, sf_dir):
    hits = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'")
    genes = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    joined = hits.join(genes, "l_partkey")
    return analytics.hits_per_day(joined, F.split("p_name", " "), F.date_format("l_shipdate", "yyyy-MM"))


@query(f"""
WITH d AS (SELECT pathway, day, count(*) AS n_hits FROM ({_DAILY}) GROUP BY 1, 2)
SELECT pathway, day, n_hits,
       round(avg(n_hits) OVER (PARTITION BY pathway ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS rolling_mean
FROM d
""")
def rolling_hits(spark, sf_dir):
    daily = (
        _hits(spark, sf_dir)
        .select(F.explode(F.split("p_name", " ")).alias("pathway"), "day", "n")
        .groupBy("pathway", "day")
        .agg(F.sum("n").alias("n_hits"))
    )
    return analytics.rolling_hits(daily, 2).withColumn("rolling_mean", F.round("rolling_mean", 6))


_PATHS = """
SELECT p_brand AS microbe, n_name AS metabolite, o_orderpriority AS cell_type, count(*) AS n_links
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
     JOIN nation ON s_nationkey = n_nationkey JOIN orders ON l_orderkey = o_orderkey
GROUP BY 1, 2, 3
"""


def _paths(spark, sf_dir):
    links = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey")
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("microbe"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    supplier = (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("metabolite"))
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("cell_type")
    )
    return analytics.flows(
        links, [(orders, ["l_orderkey"]), (part, ["l_partkey"]), (supplier, ["l_suppkey"])],
        ["microbe", "metabolite", "cell_type"],
    )


@query(_PATHS)
def flow_sankey(spark, sf_dir):
    return _paths(spark, sf_dir)


@query(f"""
SELECT microbe AS source, metabolite AS target, cast(sum(n_links) AS BIGINT) AS n_links FROM ({_PATHS}) GROUP BY 1, 2
""")
def flow_edges(spark, sf_dir):
    return analytics.edges(_paths(spark, sf_dir), "microbe", "metabolite")


@query()
def classifier(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.concat(F.lit("NCBITaxon_"), F.col("l_suppkey").cast("string")).alias("microbe"),
        F.concat(F.lit("CHEBI_"), (F.col("l_partkey") % 50).cast("string")).alias("stimulus"),
        F.col("l_quantity").alias("score"),
        F.when(F.col("l_extendedprice") > 50000, "High").otherwise("Low").alias("significance"),
    )
    model = recipes.significance_model(rows, ["microbe", "stimulus"], ["score"], "significance")
    return recipes.predict(model, rows, ["l_orderkey", "microbe", "stimulus"])


@query()
def response_components(spark, sf_dir):
    profiles = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey")
        .agg(F.avg("l_quantity").alias("q"), F.avg("l_discount").alias("d"), F.avg("l_tax").alias("t"))
    )
    return recipes.principal_components(profiles, ["l_partkey"], ["q", "d", "t"], 2)
