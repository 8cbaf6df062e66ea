"""Join helpers that hold up when one key owns a large share of the rows.

No join in this package carries an unconditional broadcast hint on data. Catalyst broadcasts
a side only when its size statistics (at plan time, or at run time under adaptive execution)
stay below ``spark.sql.autoBroadcastJoinThreshold``; otherwise it shuffles both sides and
adaptive execution splits oversized partitions. ``salts`` adds a spread of hot keys for
sessions where that is not enough: lookups find the heavy keys first and salt these alone.
Lookups deal NULL keys, which match nothing, over all partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

_SALT = "_salt"
_OWN = "_own_group"
# Sub-keys of a NULL key; a lookup's heavy keys are those with more than this share of a sub-key's part of the rows.
NULL_SALTS = 4096
HEAVY_SHARE = 0.25
# Keys the sketch of a key column follows; it misses none that has over 1 / 500 of the rows.
TRACKED = 4096
# Joins in which every left row stands under one salt only and right rows are never kept by themselves.
_SALTABLE = {"inner", "left", "leftouter", "left_outer", "semi", "leftsemi", "left_semi", "anti", "leftanti", "left_anti"}


def keep_one(
    df: DataFrame,
    keys: list[str],
    order_by: list[str] | None = None,
    last: bool = False,
    null_keys: bool = True,
) -> DataFrame:
    """One row per key: the first (or last) by ``order_by``, ties broken by all other columns.

    ``min``/``max`` over a struct pre-aggregates in every map task, so a key that owns a third
    of the rows sends one row per task through the shuffle; a ``row_number`` window would sort
    all its copies in a single task. Rows with a NULL in the key never equal each other, as in
    a unique index: each is a group of its own and all stay (or none, with ``null_keys=False``).
    """
    rest = [c for c in df.columns if c not in keys]
    fields = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order_by or [])]
    fields += [F.col(c) for c in rest] or [F.lit(1).alias("_one")]
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    groups = list(keys)
    if not null_keys:
        df = df.filter(~has_null)
    elif any(df.schema[k].nullable for k in keys):
        # One pass over the input: a number of its own keeps a row with a NULL key apart.
        df = df.withColumn(_OWN, F.when(has_null, F.monotonically_increasing_id()))
        groups.append(_OWN)
    return (
        df.groupBy(*groups)
        .agg((F.max if last else F.min)(F.struct(*fields)).alias("_row"))
        .select(*[F.col(c) if c in keys else F.col("_row").getField(c).alias(c) for c in df.columns if c != _OWN])
    )


def heavy_keys(df: DataFrame, key: str, salts: int) -> list:
    """Values of ``key`` with more than ``HEAVY_SHARE / salts`` of the rows, found by one pass over that column.

    Each task fills a frequent-items sketch of fixed size; sketches are merged, so no row is shuffled and the
    driver receives ``4 * salts`` values at most. NULL is never among them.
    """
    most = min(1000, int(salts / HEAVY_SHARE))
    top = F.expr(f"approx_top_k(`{key}`, {most}, {TRACKED})").alias("top")
    found = df.agg(F.count(F.lit(1)).alias("n"), top).first()
    least = max(2, found["n"] * HEAVY_SHARE / salts)
    return [t["item"] for t in found["top"] or [] if t["item"] is not None and t["count"] >= least]


def _spread(df: DataFrame, salts: int) -> Column:
    """A salt that mixes the task's partition id with the row's hash."""
    plain = [F.col(f.name) for f in df.schema if not isinstance(f.dataType, MapType)]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *plain), F.lit(salts)).cast("int")


def skew_join(
    left: DataFrame, right: DataFrame, on: list[str], how: str = "left", salts: int = 0, heavy: list | None = None
) -> DataFrame:
    """Equi join; with ``salts`` > 1 left keys are spread over that many sub-keys.

    The salt mixes the task's partition id with the row's hash, so copies of one row in
    different tasks land on different sub-keys, and a re-run task deals the same salts again.
    Every key is salted, or with ``heavy`` only those values of the first join column: right
    rows of other keys are not repeated. With ``heavy`` NULL keys are spread as well, whatever
    ``salts`` is.
    """
    if heavy is None and salts < 2:
        return left.join(right, on, how)
    if how.lower() not in _SALTABLE:
        raise ValueError(f"a {how!r} join would repeat right rows once per salt")
    copies = F.sequence(F.lit(0), F.lit(max(salts, 1) - 1))
    if heavy is None:
        salt = _spread(left, salts)
    else:
        key = F.col(on[0])
        salt = F.when(key.isNull(), _spread(left, NULL_SALTS))
        once = F.array(F.lit(0))
        if heavy and salts > 1:
            salt = salt.when(key.isin(*heavy), _spread(left, salts))
            copies = F.when(key.isin(*heavy), copies).otherwise(once)
        else:
            copies = once
        salt = salt.otherwise(F.lit(0))
    salted_left = left.withColumn(_SALT, salt)
    salted_right = right.withColumn(_SALT, F.explode(copies))
    return salted_left.join(salted_right, [*on, _SALT], how).drop(_SALT)


def _packed(reference: DataFrame, fields: StructType, out: str) -> DataFrame:
    """``reference`` reduced to one row per key: ``_k`` and the fields as one struct; fields it lacks are NULL."""
    have = set(reference.columns)
    taken = reference.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields]
    )
    head = fields[0].name
    return keep_one(taken, [head], null_keys=False).select(F.col(head).alias("_k"), F.struct(*taken.columns).alias(out))


def attach(
    df: DataFrame,
    key: Column,
    references: list[tuple[DataFrame | None, str, str]],
    salts: int = 0,
) -> DataFrame:
    """Left join reference tables, each as one struct column that is NULL without a match.

    ``references`` lists ``(table, schema, column)``. A schema names the fields to take, the
    first of which is compared with ``key``; fields a table lacks are NULL, and no table at all
    means no match. Tables are reduced to one row per key, as a lookup gives one answer. They
    share the key column, so several large tables cost one shuffle of ``df``. Rows without a
    key are dealt over all partitions; with ``salts`` heavy keys are found first and dealt
    over so many sub-keys.
    """
    present = [(t, StructType.fromDDL(schema), out) for t, schema, out in references if t is not None]
    if present:
        kind = present[0][1][0].dataType
        df = df.withColumn("_k", key.cast(kind))
        heavy = heavy_keys(df, "_k", salts) if salts > 1 else []
    for reference, fields, out in present:
        df = skew_join(df, _packed(reference, fields, out), ["_k"], "left", salts, heavy)
    df = df.drop("_k")
    return _without_match(df, references)


def attach_guarded(
    df: DataFrame,
    references: list[tuple[Column, DataFrame | None, str, str]],
    salts: int = 0,
) -> DataFrame:
    """As ``attach`` for lookups that exclude each other: ``(key, table, schema, column)``, a key NULL outside its guard.

    A row takes part in the first lookup whose key it has. The tables become one, tagged with
    their number, so ``df`` is joined and shuffled once whatever their number; keys are
    compared as text.
    """
    named = [(key, t, StructType.fromDDL(schema), out) for key, t, schema, out in references]
    if any(t is not None for _, t, _, _ in named):
        # Number and key in one text: heavy keys and NULL are then those of one column.
        numbered = lambda i, key: F.concat(F.lit(f"{i}:"), key.cast("string"))
        df = df.withColumn("_k", F.coalesce(*[numbered(i, key) for i, (key, *_) in enumerate(named)]))
        tagged = []
        for i, (_, t, fields, _) in enumerate(named):
            if t is not None:
                others = [(F.col("_row") if j == i else F.lit(None).cast(f)).alias(o) for j, (_, u, f, o) in enumerate(named) if u is not None]
                tagged.append(_packed(t, fields, "_row").select(numbered(i, F.col("_k")).alias("_k"), *others))
        heavy = heavy_keys(df, "_k", salts) if salts > 1 else []
        df = skew_join(df, reduce(DataFrame.unionByName, tagged), ["_k"], "left", salts, heavy).drop("_k")
    return _without_match(df, [r[1:] for r in references])


def _without_match(df: DataFrame, references: list[tuple[DataFrame | None, str, str]]) -> DataFrame:
    """Add the columns of absent tables: all NULL."""
    missing = {out: F.lit(None).cast(StructType.fromDDL(schema)) for t, schema, out in references if t is None}
    return df.withColumns(missing) if missing else df
