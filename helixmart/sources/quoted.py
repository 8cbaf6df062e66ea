"""Tab-separated records whose quoted cells hold line breaks, read by splits.

Whether a line starts inside a quoted cell depends on all lines before it. A line is therefore seen as a function
from the state before it to the state after it; functions of consecutive lines compose, so every split of a file
is reduced to one function in its own task, a prefix pass over the splits gives each its first state, and a
second scan cuts the records. Only records that cross a border of splits are shuffled.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The Arrow functions travel to the executors by value: workers need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A quoted cell is open to the end of the line: all cells before it are closed.
_OPEN_CELL = r'(?:(?:"(?:[^"]++|"")*+"[^\t]*+|(?!")[^\t]*+)\t)*+"(?:[^"]++|"")*+\z'
_FROM_OUTSIDE = rf"\A{_OPEN_CELL}"
_FROM_INSIDE = rf'\A(?:[^"]++|"")*+(?:\z|"[^\t]*+\t{_OPEN_CELL})'

# What a line does to the state: end outside, turn it round, leave it, end inside.
CLOSE, TURN, LEAVE, OPEN = range(4)
WHOLE, HEAD, REST = range(3)


def line_kind(line: Column) -> Column:
    """CLOSE, TURN, LEAVE or OPEN; a line without quotes leaves the state."""
    after_outside, after_inside = line.rlike(_FROM_OUTSIDE).cast("tinyint"), line.rlike(_FROM_INSIDE).cast("tinyint")
    return F.when(F.contains(line, F.lit('"')), after_outside + 2 * after_inside).otherwise(F.lit(LEAVE)).cast("tinyint")


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block")
    )


def files_with_breaks(spark: SparkSession, paths: list[str]) -> set[str]:
    """Those of the files that hold a quoted cell which a line does not close; one scan, no Python.

    Before the first such line of a file every line starts outside, so a file without one has no such cell.
    """
    opened = _lines(spark, paths).where(F.contains("value", F.lit('"')) & F.col("value").rlike(_FROM_OUTSIDE))
    return {r["path"] for r in opened.select("path").distinct().collect()}  # paths of the caller's own list


def _runs(*keys: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the runs of equal keys."""
    n = len(keys[0])
    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    starts = np.flatnonzero(new)
    return list(zip(starts.tolist(), [*starts[1:].tolist(), n], strict=True))


def _states(kinds: np.ndarray, inside: bool) -> np.ndarray:
    """The state after each line."""
    turns = np.cumsum(kinds == TURN) % 2
    fixed = (kinds == CLOSE) | (kinds == OPEN)
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(kinds)), -1))
    base = np.where(last >= 0, (kinds[last] == OPEN) ^ (turns[last] == 1), inside)
    return base ^ (turns == 1)


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, block, kind) of lines in their order -> (file, block, from outside, from inside) of each split."""
    current, ends = None, (False, True)

    def row():
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip((*current, *ends), (pa.int64(), pa.int64(), pa.bool_(), pa.bool_()), strict=True)], names=["id", "block", "out_to", "in_to"])

    for batch in batches:
        ids, blocks, kinds = (batch.column(i).to_numpy() for i in range(3))
        for a, b in _runs(ids, blocks) if len(ids) else []:
            run = kinds[a:b]
            if current != (ids[a], blocks[a]):
                if current is not None:
                    yield row()
                current, ends = (ids[a], blocks[a]), (False, True)
                if blocks[a] == 0:  # the header line
                    run = np.concatenate([[CLOSE], run[1:]])
            ends = tuple(bool(_states(run, e)[-1]) for e in ends)
    if current is not None:
        yield row()


def _first_states(splits: DataFrame, names: dict[int, str]) -> dict[tuple[int, int], bool]:
    """State before each split; one entry per split, as in the list of files that the driver holds anyway."""
    out, state, file = {}, False, None
    for r in sorted(splits.collect(), key=lambda r: (r["id"], r["block"])):
        if r["id"] != file:
            if state:
                raise ValueError(f"a quoted cell is never closed in {names[file]}")
            file, state = r["id"], False
        out[r["id"], r["block"]] = state
        state = r["in_to"] if state else r["out_to"]
    if state:
        raise ValueError(f"a quoted cell is never closed in {names[file]}")
    return out


def _cutter(starts):
    """Lines in their order -> records: (value, path, file, block, row, part); part HEAD and REST lack lines of other splits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, inside, at, held = None, False, 0, []  # held: lines of the open record, after its (row, part)

        def emit(rows, path, file, block):
            kinds = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int32())
            columns = list(zip(*[(text, path, file, block, row, part) for row, part, text in rows], strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["value", "path", "file", "block", "row", "part"])

        place = ("", "", 0)

        def flush():
            # The split ends in a record that the next one goes on with, or was no more than a piece itself.
            return [emit([(held[0][0], held[0][1] if held[0][1] == REST else HEAD, "\n".join(held[1:]))], *place)] if held else []

        for batch in batches:
            ids, blocks, kinds = (batch.column(i).to_numpy() for i in (0, 1, 2))
            for a, b in _runs(ids, blocks) if len(ids) else []:
                skip = 0
                if current != (ids[a], blocks[a]):
                    yield from flush()
                    current, at, held = (int(ids[a]), int(blocks[a])), 0, []
                    if current not in starts.value:
                        raise RuntimeError("the files were split anew between two scans: keep the session's cores and split sizes as they are")
                    inside = starts.value[current]
                    place = (batch.column(4)[a].as_py(), batch.column(5)[a].as_py(), current[1])
                    if current[1] == 0:
                        skip, inside = 1, False
                    elif inside:
                        held = [(0, REST)]
                lines, kind = batch.slice(a + skip, b - a - skip), kinds[a + skip : b]
                n = len(kind)
                if not n:
                    at += skip
                    continue
                after = _states(kind, inside)
                before = np.concatenate([[inside], after[:-1]])
                whole = ~before & ~after
                rows = np.arange(at + skip, at + skip + n)
                kept = np.flatnonzero(whole)
                text = lines.column(3)
                if len(kept):
                    yield pa.RecordBatch.from_arrays(
                        [text.take(pa.array(kept)), lines.column(4).take(pa.array(kept)), lines.column(5).take(pa.array(kept)), pa.array(blocks[a + skip : b][kept]), pa.array(rows[kept]), pa.array(np.full(len(kept), WHOLE, dtype=np.int32))],
                        names=["value", "path", "file", "block", "row", "part"],
                    )
                done = []
                for i in np.flatnonzero(~whole).tolist():  # lines of records with breaks
                    if not before[i]:
                        held = [(int(rows[i]), WHOLE)]
                    held.append(text[i].as_py())
                    if not after[i]:
                        done.append((*held[0], "\n".join(held[1:])))
                        held = []
                if done:
                    yield emit(done, *place)
                at, inside = at + skip + n, bool(after[-1])
        yield from flush()

    return run


def records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(value, path, file, block, row) of all records below the header lines; block and row say where a record begins.

    Line breaks inside quotes stay in ``value``; blank lines between records are left out. Raises ValueError with
    the file's name if quotes are not balanced. Files are read by splits, twice.
    """
    lines = _lines(spark, paths).withColumn("id", F.xxhash64("path")).withColumn("kind", line_kind(F.col("value")))
    names = {r["id"]: r["path"] for r in lines.select("id", "path").distinct().collect()}
    splits = lines.select("id", "block", "kind").mapInArrow(_compose, "id long, block long, out_to boolean, in_to boolean")
    starts = spark.sparkContext.broadcast(_first_states(splits, names))
    cut = lines.select("id", "block", "kind", "value", "path", "file").mapInArrow(
        _cutter(starts), "value string, path string, file string, block long, row long, part int"
    )
    # Two pieces a split at most: the end of a record that began before it, and the beginning of one that goes on.
    pieces = cut.where(F.col("part") != WHOLE)
    order = Window.partitionBy("path").orderBy("block", F.desc("part")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begun = F.last(F.when(F.col("part") == HEAD, F.struct("block", "row")), ignorenulls=True).over(order)
    joined = (
        pieces.withColumn("begun", begun)
        .groupBy("path", "file", "begun")
        .agg(F.array_sort(F.collect_list(F.struct("block", "value"))).alias("pieces"))
        .select(F.array_join("pieces.value", "\n").alias("value"), "path", "file", "begun.block", "begun.row")
    )
    both = cut.where(F.col("part") == WHOLE).drop("part").unionByName(joined)
    return both.withColumn("value", F.regexp_replace("value", r"\r\z", "")).where(F.trim("value") != "")
