"""Substring dedup by a sparse suffix array, sorted by a distributed, common-prefix-aware merge sort.

Which suffixes are sorted: every window of 100 bytes has an anchor, its 32-byte stretch of smallest hash, so
equal windows have equal anchors at equal places. Windows of one anchor follow each other; together they are
the anchor's context. A context that also stands earlier as a whole takes all its windows with it. The windows of the
first of each context fall into four regions by the anchor's place in them, and those of a region all hold the same
83 bytes around the anchor (51 + 0, 34 + 17, 17 + 34 or 0 + 51 beside it): a region whose 83 bytes stand in no other
context has no equal windows. Only the windows of other regions are left, and
these are sorted: each task sorts its suffixes into front-coded runs, runs
are exchanged by ranges of the suffix order, and every range is merged by a loser tree that compares two
suffixes from their known common prefix on.
"""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixmart.llm.common import arrow_batches, lean, partitions, settle, ship

WIDTH = 100
ANCHOR = 32
SPAN = WIDTH - ANCHOR + 1
SIDE = (WIDTH - ANCHOR) // 4
# Regions of windows: the least and most bytes that they have before their anchor, and where the 32-byte stretches
# start, counted from it, that cover what the windows of the region share.
REGIONS = [
    (3 * SIDE, 4 * SIDE, (-3 * SIDE, -ANCHOR)),
    (2 * SIDE, 3 * SIDE - 1, (-2 * SIDE, -SIDE, SIDE)),
    (SIDE, 2 * SIDE - 1, (-SIDE, SIDE, 2 * SIDE)),
    (0, SIDE - 1, (ANCHOR, 3 * SIDE)),
]
# A text is named by its id and so many bits of its hash, which tell texts of one id apart.
TAG_BITS = 24
# Bits in the maps of texts that have something to sort or to cut: their bound whatever the input's size.
MAP_BITS = 1 << 22
# Bytes that are hashed at a time; longer texts are taken in overlapping pieces.
PIECE = 2 << 20
# Rows of text whose contexts, or whose suffixes as a run, a task holds at a time, at most.
BATCH = 2000
# Suffixes aimed at in a range of the merge, suffixes a run holds in memory, suffixes drawn for the range borders, and entries in a block.
RANGE = 400_000
RUN = 250_000
DRAWN = 20_000
ENTRIES = 4096
# Bytes that say where a suffix is from: id, start and tag.
ORIGIN = 16
LAST_ID = (1 << 63) - 1

_RANDOM = np.random.default_rng(77)
_BYTES = _RANDOM.integers(0, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _RANDOM.integers(0, 2**63, size=6, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, outer, inner, first window, last window) of each anchor of a text of at most PIECE + WIDTH bytes.

    ``outer``: 32 bits each of hashes of what the windows of the first and the last region share; ``inner``: 28 bits each
    for the two regions between, and in the last 8 how far the anchor stands behind the first window's start. The hash
    of a region that has no window here means nothing.
    """
    n = len(data) - WIDTH + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return *[none.astype(np.uint64)] * 3, none, none
    h, step = _BYTES[data], 1
    for factor in _FACTORS[:5]:  # 1, 2, 4, 8, 16, 32 bytes
        h = h[:-step] * factor + h[step:]
        step *= 2
    plain = h
    h = h.copy()
    h ^= h >> np.uint64(29)
    h *= _FACTORS[5]
    # Hash above, place below: the least value names the leftmost stretch of least hash.
    value = (h & ~np.uint64(0xFFFFFF)) | np.arange(len(h), dtype=np.uint64)
    padded = np.full(-(-len(value) // SPAN) * SPAN, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(value)] = value
    blocks = padded.reshape(-1, SPAN)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n], ahead[SPAN - 1 : SPAN - 1 + n])
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    last = np.concatenate([first[1:] - 1, [n - 1]])
    at = (least[first] & np.uint64(0xFFFFFF)).astype(np.int64)

    def region(starts: tuple[int, ...]) -> np.ndarray:
        x = np.zeros(len(at), dtype=np.uint64)
        for start in starts:
            x = (x + plain[np.clip(at + start, 0, len(plain) - 1)]) * _FACTORS[5]
            x ^= x >> np.uint64(29)
        return x * _FACTORS[0] >> np.uint64(32)

    far_left, left, right, far_right = (region(starts) for _, _, starts in REGIONS)
    inner = (left >> np.uint64(4)) << np.uint64(36) | (right >> np.uint64(4)) << np.uint64(8) | (at - first).astype(np.uint64)
    return h[at], far_left << np.uint64(32) | far_right, inner, first, last


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _pack(first, length, tag):
    """Place, number of windows beyond the first (under 128) and tag in one number; of numbers or columns."""
    return first * (128 << TAG_BITS) + length * (1 << TAG_BITS) + tag


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tag, id, text) -> contexts (id, place, hash, context, outer, inner), each context once in BATCH texts; of later ones
    among these only what they remove (context NULL, hash its end, place its start)."""
    names = ["id", "place", "hash", "context", "outer", "inner"]
    for batch in (b.slice(at, BATCH) for b in batches for at in range(0, b.num_rows, BATCH)):
        texts, parts = batch.column(2), []
        for i in range(batch.num_rows):
            raw = texts[i].as_buffer()
            if raw is None or raw.size < WIDTH:
                continue
            data, view = np.frombuffer(raw, dtype=np.uint8), memoryview(raw)
            for base in range(0, len(data) - WIDTH + 1, PIECE):
                h, outer, inner, first, last = anchors(data[base : base + PIECE + WIDTH - 1])
                first, last = first + base, last + base
                digest = xxhash.xxh3_64_intdigest
                context = np.array([digest(view[a : b + WIDTH]) for a, b in zip(first.tolist(), last.tolist(), strict=True)], dtype=np.uint64)
                parts.append((h, context, outer, inner, np.full(len(h), i), first, last))
        if not parts:
            continue
        h, context, outer, inner, at, first, last = (np.concatenate(x) for x in zip(*parts, strict=True))
        ids, tags = batch.column(1).to_numpy()[at], batch.column(0).to_numpy()[at]
        order = np.lexsort((first, ids, context, h))
        same = np.zeros(len(order), dtype=bool)
        a, b = order[1:], order[:-1]
        same[1:] = (h[a] == h[b]) & (context[a] == context[b])
        # The group's first stands for all others, but for rows of the same id and place, which are not later.
        lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
        leader = order[lead]
        later = same & ((ids[order] != ids[leader]) | (first[order] != first[leader]))
        keep, gone = np.sort(order[~later]), order[later]
        places = _pack(first[keep], last[keep] - first[keep], tags[keep])
        columns = [ids[keep], places, *(x[keep].view(np.int64) for x in (h, context, outer, inner))]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)
        spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for i, t, x, y in zip(ids[gone].tolist(), tags[gone].tolist(), first[gone].tolist(), last[gone].tolist(), strict=True):
            spans.setdefault((i, t), []).append((x, y + WIDTH))
        merged = [(i, _pack(x, 0, t), y) for (i, t), s in spans.items() for x, y in _merge(s)]
        if merged:
            i, x, y = (pa.array(c, pa.int64()) for c in zip(*merged, strict=True))
            yield pa.RecordBatch.from_arrays([i, x, y, *[pa.nulls(len(i), pa.int64())] * 3], names=names)


def front_code(keys: list[bytes]) -> list[int]:
    """Length of the prefix that each sorted key shares with the one before."""
    if not keys:
        return []
    m = np.frombuffer(b"".join(keys), dtype=np.uint8).reshape(len(keys), -1)
    differs = m[1:] != m[:-1]
    return [0, *np.where(differs.any(axis=1), differs.argmax(axis=1), m.shape[1]).tolist()]


def write_block(entries: list[bytes]) -> bytes:
    """Sorted entries (suffix and origin): shared lengths, rests of the suffixes, origins byte by byte; packed by a codec."""
    shared = front_code([e[:WIDTH] for e in entries])
    origins = np.frombuffer(b"".join([e[WIDTH:] for e in entries]), dtype=np.uint8).reshape(-1, ORIGIN)
    plain = b"".join([bytes(shared), *[e[n:WIDTH] for n, e in zip(shared, entries, strict=True)], origins.T.tobytes()])
    return len(entries).to_bytes(4) + len(plain).to_bytes(4) + pa.compress(plain, codec="zstd", asbytes=True)


def read_blocks(blocks: list[bytes]) -> Iterator[tuple[int, bytes]]:
    """(shared length, entry) of a run; a block starts anew."""
    for packed in blocks:
        n = int.from_bytes(packed[:4])
        block = pa.decompress(packed[8:], decompressed_size=int.from_bytes(packed[4:8]), codec="zstd", asbytes=True)
        origins = np.frombuffer(block[len(block) - n * ORIGIN :], dtype=np.uint8).reshape(ORIGIN, n).T.tobytes()
        at, before = n, b""
        for i, shared in enumerate(block[:n]):
            end = at + WIDTH - shared
            before = before[:shared] + block[at:end]
            at = end
            yield shared, before + origins[i * ORIGIN : (i + 1) * ORIGIN]


class LoserTree:
    """Merges sorted front-coded runs. Every loser remembers the prefix it shares with the one that beat it, so two
    heads are compared only where both share the last winner's prefix equally far, and only from there on."""

    def __init__(self, runs: list[Iterator[tuple[int, bytes]]]):
        self.runs = runs
        self.size = 1
        while self.size < max(1, len(runs)):
            self.size *= 2
        self.heads: list[bytes | None] = [None] * self.size
        for i, run in enumerate(runs):
            first = next(run, None)
            self.heads[i] = first[1] if first else None
        # Of a head with the entry that last won where it stands; a run that has ended shares less than any.
        self.shared = [-1 if head is None else 0 for head in self.heads]
        self.losers = [-1] * self.size
        self.winner = self._play(1)

    def _play(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._play(2 * node), self._play(2 * node + 1)
        win, self.losers[node] = self._match(a, b)
        return win

    def _match(self, a: int, b: int) -> tuple[int, int]:
        """(winner, loser); sets what the loser shares with the winner."""
        x, y = self.heads[a], self.heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        m, n = self.shared[a], self.shared[b]
        if m > n:  # shares more with the last winner, which is no larger than either
            return a, b
        if n > m:
            return b, a
        if m < WIDTH:
            differ = int.from_bytes(x[m:WIDTH]) ^ int.from_bytes(y[m:WIDTH])
            if differ:
                common = WIDTH - (differ.bit_length() + 7) // 8
                if x[common] < y[common]:
                    self.shared[b] = common
                    return a, b
                self.shared[a] = common
                return b, a
        if x[WIDTH:] <= y[WIDTH:]:
            self.shared[b] = WIDTH
            return a, b
        self.shared[a] = WIDTH
        return b, a

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        """(shared length with the entry before, entry) in order."""
        heads, shared, losers, runs, size = self.heads, self.shared, self.losers, self.runs, self.size
        w = self.winner
        while (entry := heads[w]) is not None:
            yield shared[w], entry
            following = next(runs[w], None)
            if following is None:
                heads[w], shared[w] = None, -1
            else:
                n, heads[w] = following
                # A block's first entry is not coded against the one before.
                shared[w] = n if n else self._common(entry, heads[w])
            node = (w + size) // 2
            while node:
                loser = losers[node]
                if shared[w] < shared[loser]:
                    losers[node], w = w, loser
                elif shared[w] == shared[loser]:
                    w, losers[node] = self._match(w, loser)
                node //= 2
            self.winner = w

    @staticmethod
    def _common(x: bytes, y: bytes) -> int:
        differ = int.from_bytes(x[:WIDTH]) ^ int.from_bytes(y[:WIDTH])
        return WIDTH - (differ.bit_length() + 7) // 8


def _origin(entry: bytes) -> tuple[int, int, int]:
    """(id, start, tag) of a suffix."""
    return int.from_bytes(entry[WIDTH : WIDTH + 8]) - (1 << 63), int.from_bytes(entry[WIDTH + 8 : WIDTH + 13]), int.from_bytes(entry[WIDTH + 13 :])


def _runs(batches: Iterator[pa.RecordBatch], borders: list[bytes]) -> Iterator[pa.RecordBatch]:
    """(tag, id, text, spots) -> sorted, front-coded runs of RUN suffixes or little more, cut at the range borders."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            entries, pieces = [], 0
            name = f"{part.column(1)[0].as_py()} {part.column(0)[0].as_py()}"  # no other slice begins with this text
            for tag, i, text, spots in zip(*(part.column(c).to_pylist() for c in range(4)), strict=True):
                # The bytes of an origin are ordered as its id and start.
                head, tail = (i + (1 << 63)).to_bytes(8), tag.to_bytes(3)
                for spot in spots:
                    first, more = spot >> (TAG_BITS + 7), (spot >> TAG_BITS) & 127
                    entries += [text[p : p + WIDTH] + head + p.to_bytes(5) + tail for p in range(first, first + more + 1)]
                    if len(entries) >= RUN:
                        yield from _run(entries, f"{name} {pieces}", borders)
                        entries, pieces = [], pieces + 1
            yield from _run(entries, f"{name} {pieces}", borders)


def _run(entries: list[bytes], name: str, borders: list[bytes]) -> Iterator[pa.RecordBatch]:
    """The blocks of one run, and the spans of suffixes that the run itself has from an earlier place."""
    entries.sort()
    kept: list[bytes] = []
    gone = []
    lead = b""
    for e in entries:  # a suffix that the run has from an earlier place need not travel
        if e[:WIDTH] != lead[:WIDTH]:
            lead = e
            kept.append(e)
        elif e[WIDTH : WIDTH + 13] == lead[WIDTH : WIDTH + 13]:
            kept.append(e)
        else:
            gone.append(_origin(e))
    run = xxhash.xxh3_64_intdigest(name) & LAST_ID
    cuts = [0, *(bisect.bisect_left(kept, border) for border in borders), len(kept)]
    rows = [(k, run, j, write_block(kept[j : min(b, j + ENTRIES)]), 0, 0, 0, 0) for k, (a, b) in enumerate(itertools.pairwise(cuts)) for j in range(a, b, ENTRIES)]
    rows += [(i % (len(borders) + 1), run, 0, None, i, t, x, y) for (i, t), s in _grouped(gone).items() for x, y in _merge(s)]
    if rows:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["range", "run", "seq", "block", "id", "tag", "first", "end"])


def _grouped(gone: list[tuple[int, int, int]]) -> dict[tuple[int, int], list[tuple[int, int]]]:
    spans: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for i, start, tag in gone:
        spans.setdefault((i, tag), []).append((start, start + WIDTH))
    return spans


def _merged(group: pd.DataFrame) -> pd.DataFrame:
    """One range: all runs' blocks through the loser tree; what later suffixes of equal windows remove."""
    passed = group[group["block"].isna()]
    blocks = group[group["block"].notna()].sort_values(["run", "seq"])
    runs = [read_blocks(list(g)) for _, g in blocks.groupby("run")["block"]]
    lead = b""
    gone = []
    for shared, entry in LoserTree(runs):
        if shared < WIDTH or not lead:
            lead = entry[WIDTH : WIDTH + 13]  # equal windows come in order of id and start
        elif entry[WIDTH : WIDTH + 13] != lead:
            gone.append(_origin(entry))
    columns = ["id", "tag", "first", "end"]
    out = pd.DataFrame([(i, t, a, b) for (i, t), s in _grouped(gone).items() for a, b in _merge(s)], columns=columns)
    return pd.concat([out.astype("int64"), passed[columns]], ignore_index=True).astype("int64")


def _map_of(keys: DataFrame) -> DataFrame:
    """A map of MAP_BITS bits, one for each id and tag: (word, bits), bounded whatever the number of keys."""
    bit = F.pmod(F.xxhash64("id", "tag"), F.lit(MAP_BITS))
    words = keys.withColumn("_b", bit).select(F.shiftright("_b", 5).alias("word"), F.expr("shiftleft(1L, cast(_b % 32 as int))").alias("bit"))
    return words.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def _split(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """``texts`` with ``maybe``: false only for texts that are not among ``keys``, so that they need not be shuffled."""
    marked = texts.withColumn("_b", F.pmod(F.xxhash64("id", "tag"), F.lit(MAP_BITS)))
    joined = marked.join(F.broadcast(settle(_map_of(keys), "suffix-map")), F.shiftright("_b", 5) == F.col("word"), "left")
    return joined.withColumn("maybe", F.coalesce(F.expr("(bits & shiftleft(1L, cast(_b % 32 as int))) <> 0"), F.lit(False))).drop("word", "bits", "_b")


def _placed(texts: DataFrame) -> DataFrame:
    """texts(tag, id, text binary) -> (id, tag, first, more, place, hash, given, later, open): the contexts that remove
    bytes as a whole (later, or given with their end as ``hash``), and the windows of open regions, which are to be sorted."""
    found = texts.select("tag", "id", "text").mapInArrow(lean(_contexts), "id long, place long, hash long, context long, outer long, inner long")
    # Narrow rows: a hash with very many contexts spills, it is never gathered.
    size = 1 << TAG_BITS
    first, more, tag = F.shiftright("place", TAG_BITS + 7), F.shiftright("place", TAG_BITS).bitwiseAND(F.lit(127)), F.pmod("place", F.lit(size))
    whole = Window.partitionBy("hash", "context").orderBy("id", "first").rowsBetween(Window.unboundedPreceding, 0)
    # All windows run on partitions by hash: one exchange.
    placed = found.repartition(partitions(texts.sparkSession), "hash").withColumns({"first": first, "more": more, "tag": tag})
    placed = placed.withColumn("lead", F.first(F.struct("id", "first")).over(whole))
    given = F.col("context").isNull()
    later = ~given & (F.struct("id", "first") != F.col("lead"))
    placed = placed.withColumns({"given": given, "later": later}).withColumn("own", F.when(~(F.col("given") | F.col("later")), F.col("context")))
    # The sort by hash and context serves this window, too; few hashes have several contexts.
    placed = placed.withColumns({"low": F.min("own").over(Window.partitionBy("hash")), "high": F.max("own").over(Window.partitionBy("hash"))})
    placed = placed.where("given or later or low <> high")
    # A row for each region of the first of a context; all copies of a context share the bytes of the regions it has windows in.
    outer, inner, anchor = F.col("outer"), F.col("inner"), F.col("first") + F.col("inner").bitwiseAND(F.lit(255))
    hashes = [F.shiftrightunsigned(outer, 32), F.shiftrightunsigned(inner, 36), F.shiftrightunsigned(inner, 8).bitwiseAND(F.lit((1 << 28) - 1)), outer.bitwiseAND(F.lit((1 << 32) - 1))]
    regions = [
        F.struct(F.lit(k).alias("region"), h.alias("around"), F.greatest(F.col("first"), anchor - most).alias("start"), F.least(F.col("first") + F.col("more"), anchor - least).alias("stop"))
        for k, (h, (least, most, _)) in enumerate(zip(hashes, REGIONS, strict=True))
    ]
    none = F.struct(F.lit(-1).alias("region"), F.lit(0).cast("long").alias("around"), F.col("first").alias("start"), (F.col("first") + F.col("more")).alias("stop"))
    rows = placed.withColumn("r", F.explode(F.when(F.col("own").isNull(), F.array(none)).otherwise(F.array(*regions)))).where("r.start <= r.stop")
    rows = rows.select("id", "tag", "hash", "own", "given", "later", "r.region", "r.around", F.col("r.start").alias("first"), (F.col("r.stop") - F.col("r.start")).alias("more"))
    same = Window.partitionBy("hash", "region", "around")
    rows = rows.withColumn("open", F.coalesce(F.min("own").over(same) != F.max("own").over(same), F.lit(False))).where("given or later or open")
    return rows.select("id", "tag", "first", "more", _pack(F.col("first"), F.col("more"), F.col("tag")).alias("place"), "hash", "given", "later", "open")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """texts(tag, id, text binary) -> (id, tag, first, end): bytes of windows that also start earlier."""
    ship(texts.sparkSession)
    placed = settle(_placed(texts), "suffix-contexts")
    spans = placed.where("given or later").select(
        "id", "tag", "first", F.when(F.col("given"), F.col("hash")).otherwise(F.col("first") + F.col("more") + WIDTH).alias("end")
    )
    spots = placed.where("open")
    windows = spots.agg(F.sum(F.col("more") + 1)).first()[0] or 0
    if not windows:
        return spans
    work = _split(texts, spots.select("id", "tag")).where("maybe").join(spots.groupBy("id", "tag").agg(F.collect_list("place").alias("spots")), ["id", "tag"])
    borders = _borders(texts, spots, windows)
    blocks = work.select("tag", "id", "text", "spots").mapInArrow(lean(lambda it: _runs(it, borders)), "range long, run long, seq long, block binary, id long, tag long, first long, end long")
    return spans.union(blocks.groupBy("range").applyInPandas(_merged, "id long, tag long, first long, end long"))


def _borders(texts: DataFrame, spots: DataFrame, windows: int) -> list[bytes]:
    """Range borders from a drawn sample of the open suffixes: DRAWN of them in expectation."""
    ranges = max(partitions(texts.sparkSession), -(-windows // RANGE))
    steps = 1 << 40
    share = int(min(1.0, DRAWN / windows) * steps)
    # A spot stands for more + 1 suffixes, and is drawn as often.
    size = F.col("more") + 1
    draw = lambda seed: F.pmod(F.xxhash64("id", "place", F.lit(seed)), F.lit(steps))
    chosen = spots.where(draw(1) < size * share).select("id", "tag", (F.col("first") + F.pmod(draw(2), size)).alias("at"))
    # DRAWN rows of three numbers: bounded, so they may be broadcast.
    found = texts.join(F.broadcast(settle(chosen, "suffix-drawn")), ["id", "tag"]).select(F.substring("text", (F.col("at") + 1).cast("int"), WIDTH).alias("s"))
    keys = sorted(bytes(r["s"]) for r in found.collect())
    return sorted({keys[len(keys) * k // ranges] for k in range(1, ranges)}) if keys else []


def trim(piece: bytes, left: bool, right: bool) -> bytes:
    """``piece`` without the bytes of characters cut in half at its left and right edge."""
    a, e = 0, len(piece)
    while left and a < min(3, e) and piece[a] & 0xC0 == 0x80:
        a += 1
    for back in range(1, min(3, e - a) + 1) if right else ():
        byte = piece[e - back]
        if byte & 0xC0 != 0x80:
            if (byte >= 0xC0) + (byte >= 0xE0) + (byte >= 0xF0) >= back:
                e -= back
            break
    return piece[a:e]


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, characters: bool = False) -> DataFrame:
    """Remove every byte that a 100-byte string covers which also starts earlier (smaller id, or same id, earlier start).

    A row per input row: id, the columns in ``keep``, n_bytes, n_removed, n_spans, spans (array of first and end),
    kept (the remaining bytes; with ``characters``, without those of characters that a cut halves).

    Edge cases: a NULL text is empty; texts under 100 bytes stay; strings never cross documents; rows of one id
    are not earlier than each other at one place, so repeated rows share their fate and NULL ids, which count as
    the largest, too; an empty table gives no rows. Overlapping repeats count. Other columns are not looked at.
    """
    kept = [c for c in (keep or []) if c not in (id_col, text_col)]
    keyed = docs.select(
        F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << TAG_BITS)).alias("tag"), F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("id"), F.col(id_col).alias("_id"),
        *[F.col(c).alias(f"_keep_{c}") for c in kept], F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    removed = repeated_spans(keyed.select("tag", "id", "text"))
    with arrow_batches(docs.sparkSession, BATCH):  # the runs are cut that small anyway
        spans = settle(removed, "suffix-spans")
    parted = _split(keyed, spans.select("id", "tag"))
    found = spans.groupBy("id", "tag").agg(F.collect_list(F.struct("first", "end")).alias("spans"))
    # Texts that nothing is cut from stay where they are read.
    whole = parted.where("not maybe").drop("id", "tag", "maybe").withColumn("spans", F.array().cast("array<struct<first: bigint, end: bigint>>"))
    joined = parted.where("maybe").drop("maybe").join(found, ["id", "tag"], "left").drop("id", "tag").unionByName(whole)
    kept_fields = [f"`_keep_{c}` {joined.schema[f'_keep_{c}'].dataType.simpleString()}" for c in kept]
    schema = ", ".join([f"_id {joined.schema['_id'].dataType.simpleString()}", *kept_fields, "n_bytes long, n_removed long, n_spans long, spans array<struct<first: long, end: long>>, kept binary"])
    place = joined.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out: list[tuple] = []
                for text, found in zip(part.column(place).to_pylist(), part.column(part.num_columns - 1).to_pylist(), strict=True):
                    gaps = _merge([(s["first"], s["end"]) for s in found or []])
                    pieces, done = [], 0
                    for a, b in gaps:
                        pieces.append(text[done:a])
                        done = b
                    pieces.append(text[done:])
                    if characters:
                        pieces = [trim(p, i > 0, i < len(gaps)) for i, p in enumerate(pieces)]
                    out.append((len(text), sum(b - a for a, b in gaps), len(gaps), [{"first": a, "end": b} for a, b in gaps], b"".join(pieces)))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])), pa.binary()]
                arrays = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                same = [part.column(i) for i in range(part.num_columns - 1) if i != place]
                yield pa.RecordBatch.from_arrays([*same, *arrays], names=["_id", *[f"_keep_{c}" for c in kept], "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    done = joined.mapInArrow(lean(cut), schema)
    return done.select(F.col("_id").alias(id_col), *[F.col(f"_keep_{c}").alias(c) for c in kept], "n_bytes", "n_removed", "n_spans", "spans", "kept")
