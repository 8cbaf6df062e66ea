"""Balanced label propagation: documents of equal text move to one shard, under capacity quotas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixmart.llm.common import number_rows, settle

# Acceptance draws are compared with this many steps.
DRAWS = 1 << 20


def shard(docs: DataFrame, shards: int = 40, rounds: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Put every row into one of ``shards`` shards; row counts differ by one at most (law ``rows``).

    Rows of equal text are linked through their text's digest, so a link costs one row and never a pair.
    A row starts with a label drawn from its id. In each round the group of a text counts its members'
    labels and wants the one most of them have among labels with room; labels wanted by more rows than
    they have room for admit a drawn share of the groups. A group larger than a shard is dealt by hash
    into parts that fit, so no task or label sees more than a shard. At the end rows beyond a shard's
    exact size and rows without a link fill the gaps.

    Edge cases: NULL text counts as empty (crc32 0, size 16); NULL and repeated ids are rows of their own;
    an empty table gives no rows; other columns are not looked at. Returns doc_id, size, text_crc32, law,
    shard, slot, grown_shard (NULL for this law), linked and cut (the row left its group's label).
    """
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    nodes = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("g"),
        F.monotonically_increasing_id().alias("n"),
    )
    nodes = settle(nodes, "shard-nodes")
    total = nodes.count()
    room = max(1, total // shards)
    groups = nodes.groupBy("g").count().where("count > 1")
    parts = F.ceil(F.col("count") / F.lit(room))
    # A random start is balanced; a part of a group is named by the group's digest and the part's number.
    linked = nodes.select("g", "n").join(groups, "g").select(
        F.xxhash64("g", F.pmod(F.xxhash64("n"), parts)).alias("k"), "n", F.pmod(F.xxhash64("n", F.lit(1)), F.lit(shards)).cast("int").alias("label")
    )
    linked = settle(linked, "shard-linked").withColumn("home", F.lit(False))
    for turn in range(rounds):
        linked = settle(_round(linked, shards, room, turn), "shard-round")
    return _fill(nodes, linked, total, shards)


def _round(linked: DataFrame, shards: int, room: int, turn: int) -> DataFrame:
    """One round of votes, quotas and moves. ``home``: the row's group has settled on the label."""
    free = linked.where("home").groupBy("label").count().withColumnRenamed("count", "used")
    labels = linked.sparkSession.range(shards).select(F.col("id").cast("int").alias("label"))
    free = labels.join(free, "label", "left").select("label", (F.lit(room) - F.coalesce("used", F.lit(0))).alias("free"))
    votes = linked.where("not home").groupBy("k", "label").count()
    # Ties go by a draw of the group, so that they spread over the labels.
    best = votes.join(free.where("free > 0"), "label").groupBy("k").agg(
        F.max(F.struct("count", F.xxhash64("k", "label").alias("draw"), "label", "free")).alias("best"), F.sum("count").alias("seen")
    )
    sizes = votes.groupBy("k").agg(F.sum("count").alias("size"))
    wish = sizes.join(best, "k").select("k", "size", F.col("best.label").alias("want"), F.col("best.free").alias("free"))
    asked = wish.groupBy("want").agg(F.sum("size").alias("asked"))
    draw = F.pmod(F.xxhash64("k", F.lit(turn)), F.lit(DRAWS))
    moves = wish.join(asked, "want").where(draw * F.col("asked") < F.col("free") * DRAWS).select("k", "want")
    return linked.join(moves, "k", "left").select("k", "n", F.coalesce("want", "label").alias("label"), (F.col("home") | F.col("want").isNotNull()).alias("home"))


def _fill(nodes: DataFrame, linked: DataFrame, total: int, shards: int) -> DataFrame:
    """Exact sizes: rows beyond a shard's size and rows without a group's label fill what is left."""
    exact = [total // shards + (1 if s < total % shards else 0) for s in range(shards)]
    limits = F.array(*[F.lit(x).cast("long") for x in exact])
    ranked = number_rows(linked.where("home"), "label", ["n"])
    stays = settle(ranked.where(F.col("_rank") < limits[F.col("label")]).select("n", "label", "_rank"), "shard-stays")
    used = {r["label"]: r["count"] for r in stays.groupBy("label").count().collect()}  # a row per shard
    ends, filled = [], 0
    for s in range(shards):
        filled += exact[s] - used.get(s, 0)
        ends.append(filled)
    ends_col = F.array(*[F.lit(x).cast("long") for x in ends])
    starts_col = F.array(*[F.lit(x).cast("long") for x in [0, *ends[:-1]]])
    used_col = F.array(*[F.lit(used.get(s, 0)).cast("long") for s in range(shards)])
    pool = nodes.join(stays.select("n"), "n", "left_anti").select("n").withColumn("one", F.lit(0))
    pool = number_rows(pool, "one", ["n"]).withColumn("shard", F.size(F.filter(ends_col, lambda end: end <= F.col("_rank"))))
    pool = pool.select("n", "shard", (used_col[F.col("shard")] + F.col("_rank") - starts_col[F.col("shard")]).alias("slot"), F.lit(False).alias("kept"))
    placed = stays.select("n", F.col("label").alias("shard"), F.col("_rank").alias("slot"), F.lit(True).alias("kept")).unionByName(pool)
    marks = linked.select("n", F.lit(True).alias("linked"))
    out = nodes.join(placed, "n").join(marks, "n", "left")
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), F.coalesce("linked", F.lit(False)).alias("linked"), (F.coalesce("linked", F.lit(False)) & ~F.col("kept")).alias("cut"),
    )
