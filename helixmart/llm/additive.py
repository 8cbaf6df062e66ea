"""Text quality by a generalised additive model with pairwise interactions, learned as lookup tables over binned features."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixmart.llm.common import bucket, settle, ship

# The bounded sample of labelled rows, half of it for each label if there are so many.
EXAMPLES = 20_000
# Bytes of text that a task looks at together; longer texts are taken in pieces and their counts added up.
PIECE = 1 << 20

MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
LETTER, UPPER, DIGIT, BLANK, LINE, STOP, MARK, SYMBOL, FOREIGN = range(9)
FEATURES = [
    "size", "letters", "upper", "digits", "blanks", "lines", "stops", "marks", "symbols", "foreign", "word_length", "longest_word", "short_words",
    "bare_words", "symbol_ends", "capital_words", "distinct_words", "top_word", "twins", "distinct_pairs", "distinct_eights", "distinct_lines",
]


def _classes() -> np.ndarray:
    of = np.full(256, SYMBOL, dtype=np.uint8)
    of[128:] = FOREIGN
    for kind, chars in ((LETTER, range(97, 123)), (UPPER, range(65, 91)), (DIGIT, range(48, 58)), (BLANK, b" \t\x0b\x0c"), (LINE, b"\n\r"), (STOP, b".?!"), (MARK, b",;:'\"()-")):
        of[list(chars)] = kind
    return of


CLASS = _classes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * MULTIPLIERS[1]
    return x ^ (x >> np.uint64(32))


def _cut(raw: bytes, piece: int) -> list[bytes]:
    """The text in pieces of at most ``piece`` bytes, cut after white space where there is some."""
    out, at = [], 0
    while len(raw) - at > piece:
        end = max(raw.rfind(b" ", at, at + piece), raw.rfind(b"\n", at, at + piece)) + 1
        end = end if end > at else at + piece
        out.append(raw[at:end])
        at = end
    return [*out, raw[at:]]


def _spans(flags: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of true flags; a run ends where a text ends."""
    padded = np.concatenate([[False], flags, [False]])
    new = flags & (~padded[:-2] | first)
    starts = np.flatnonzero(new)
    ends = np.flatnonzero(flags & (~padded[2:] | np.concatenate([first[1:], [True]]))) + 1
    return starts, ends


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of spans of bytes, each byte weighted by its place in the span."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sizes = ends - starts
    place = np.arange(sizes.sum(), dtype=np.int64) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    letters = data[place + np.repeat(starts, sizes)].astype(np.uint64) + np.uint64(1)
    weights = _mix((place.astype(np.uint64) + np.uint64(1)) * MULTIPLIERS[0])
    return _mix(np.add.reduceat(letters * weights, np.cumsum(sizes) - sizes))


def _distinct(owners: np.ndarray, keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(number of distinct keys, count of the most frequent key) of each owner."""
    order = np.lexsort((keys, owners))
    o, k = owners[order], keys[order]
    new = np.concatenate([[True], (o[1:] != o[:-1]) | (k[1:] != k[:-1])]) if len(o) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(new)
    top = np.zeros(n)
    np.maximum.at(top, o[at], np.diff(np.concatenate([at, [len(o)]])))
    return np.bincount(o[at], minlength=n).astype(float), top


def _windows(owners: np.ndarray, words: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, hash) of all runs of ``size`` words of one text."""
    if len(words) < size:
        return owners[:0], words[:0]
    n = len(words) - size + 1
    keys = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        keys = _mix(keys * MULTIPLIERS[2] + words[i : i + n])
    whole = owners[:n] == owners[size - 1 :]
    return owners[:n][whole], keys[whole]


def features(texts: list[bytes], piece: int = PIECE) -> np.ndarray:
    """A row of FEATURES for each UTF-8 text. Ratios of nothing are 0; how long texts are cut changes no count but at a cut word."""
    n = len(texts)
    counts, words_of = np.zeros((n, 9)), []
    totals = {k: np.zeros(n) for k in ("words", "letters", "longest", "short", "bare", "ends", "capital")}
    lines_of: list[tuple[np.ndarray, np.ndarray]] = []
    group: list[tuple[int, bytes]] = []
    parts = [(i, p) for i, t in enumerate(texts) for p in (_cut(t, piece) if len(t) > piece else [t]) if p]
    held = 0
    for j, (i, part) in enumerate(parts):
        group.append((i, part))
        held += len(part)
        if held >= piece or j == len(parts) - 1:
            _count(group, n, counts, totals, words_of, lines_of)
            group, held = [], 0
    owners = np.concatenate([w[0] for w in words_of]) if words_of else np.zeros(0, dtype=np.int64)
    words = np.concatenate([w[1] for w in words_of]) if words_of else np.zeros(0, dtype=np.uint64)
    line_owners = np.concatenate([x[0] for x in lines_of]) if lines_of else np.zeros(0, dtype=np.int64)
    lines = np.concatenate([x[1] for x in lines_of]) if lines_of else np.zeros(0, dtype=np.uint64)
    share = lambda a, b: np.divide(a, b, out=np.zeros(n), where=b > 0)
    size, n_words = counts.sum(axis=1), totals["words"]
    letters = counts[:, LETTER] + counts[:, UPPER]
    distinct, top = _distinct(owners, words, n)
    twins = np.bincount(owners[1:][(owners[1:] == owners[:-1]) & (words[1:] == words[:-1])], minlength=n).astype(float)
    distinct_of = {}
    for k in (2, 8):
        o, keys = _windows(owners, words, k)
        distinct_of[k] = share(_distinct(o, keys, n)[0], np.bincount(o, minlength=n).astype(float))
    n_lines = np.bincount(line_owners, minlength=n).astype(float)
    return np.stack(
        [
            np.log1p(size), share(letters + counts[:, FOREIGN], size), share(counts[:, UPPER], letters), share(counts[:, DIGIT], size),
            share(counts[:, BLANK], size), share(counts[:, LINE], n_words), share(counts[:, STOP], n_words), share(counts[:, MARK], n_words),
            share(counts[:, SYMBOL], n_words), share(counts[:, FOREIGN], size), share(totals["letters"], n_words), np.log1p(totals["longest"]),
            share(totals["short"], n_words), share(totals["bare"], n_words), share(totals["ends"], n_words), share(totals["capital"], n_words),
            share(distinct, n_words), share(top, n_words), share(twins, n_words), distinct_of[2], distinct_of[8], share(_distinct(line_owners, lines, n)[0], n_lines),
        ],
        axis=1,
    )


def _count(group: list[tuple[int, bytes]], n: int, counts: np.ndarray, totals: dict, words_of: list, lines_of: list) -> None:
    """Add what a group of pieces (owner, bytes) holds."""
    data = np.frombuffer(b"".join(p for _, p in group), dtype=np.uint8)
    sizes = np.array([len(p) for _, p in group])
    owner = np.array([i for i, _ in group])
    starts = np.cumsum(sizes) - sizes
    kind = CLASS[data]
    first = np.zeros(len(data), dtype=bool)
    first[starts] = True
    for c in range(9):
        np.add.at(counts[:, c], owner, np.add.reduceat((kind == c).astype(np.int64), starts))
    # Words: runs of anything but white space.
    a, b = _spans((kind != BLANK) & (kind != LINE), first)
    of = owner[np.searchsorted(starts, a, side="right") - 1]
    words_of.append((of, _hashes(data, a, b)))
    length = b - a
    if len(a):
        wordy = np.concatenate([[0], np.cumsum((kind == LETTER) | (kind == UPPER) | (kind == FOREIGN))])
        inside = wordy[b] - wordy[a]
        tail = kind[b - 1]
        add = lambda name, values: np.add.at(totals[name], of, values)
        add("words", 1)
        add("letters", length)
        add("short", length <= 3)
        add("bare", inside == 0)
        add("ends", tail == SYMBOL)
        add("capital", kind[a] == UPPER)
        np.maximum.at(totals["longest"], of, length)
    a, b = _spans(kind != LINE, first)
    lines_of.append((owner[np.searchsorted(starts, a, side="right") - 1], _hashes(data, a, b)))


class AdditiveModel:
    """Log odds as a sum of one table per feature and one per chosen pair of features, over bins.

    Cycles go round the features; in each turn a tree of ``leaves`` leaves over one feature's bins is fitted to the
    residuals and added, shrunk, to the feature's table. Then pairs are ranked by what a tree of two splits on
    each gains, and the best get tables by cycles of such trees.
    """

    def __init__(self, bins: int = 64, pair_bins: int = 16, cycles: int = 60, pairs: int = 8, pair_cycles: int = 30, rate: float = 0.2, leaves: int = 3, least: float = 8.0, pull: float = 2.0):
        self.bins, self.pair_bins, self.cycles, self.n_pairs, self.pair_cycles = bins, pair_bins, cycles, pairs, pair_cycles
        self.rate, self.leaves, self.least, self.pull = rate, leaves, least, pull
        self.start, self.cuts, self.coarse = 0.0, [], []
        self.tables: list[np.ndarray] = []
        self.pairs: list[tuple[int, int]] = []
        self.pair_tables: list[np.ndarray] = []

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> AdditiveModel:
        edges = lambda c, k: np.unique(np.quantile(c, np.linspace(0, 1, k + 1)[1:-1]))
        self.cuts, self.coarse = [edges(c, self.bins) for c in x.T], [edges(c, self.pair_bins) for c in x.T]
        fine = [np.searchsorted(c, v, side="left") for c, v in zip(self.cuts, x.T, strict=True)]
        coarse = [np.searchsorted(c, v, side="left") for c, v in zip(self.coarse, x.T, strict=True)]
        rate = float((weight * y).sum() / weight.sum())
        self.start = float(np.log(min(max(rate, 1e-3), 1 - 1e-3) / (1 - min(max(rate, 1e-3), 1 - 1e-3))))
        self.tables = [np.zeros(len(c) + 1) for c in self.cuts]
        margin = np.full(len(y), self.start)
        for _ in range(self.cycles):
            for f, b in enumerate(fine):
                g, h, w = self._sums(b, len(self.tables[f]), margin, y, weight)
                step = self.rate * self._tree(g, h, w)
                self.tables[f] += step
                margin += step[b]
        self._fit_pairs(coarse, margin, y, weight)
        return self

    def _sums(self, b: np.ndarray, n: int, margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
        p = 1 / (1 + np.exp(-margin))
        return np.bincount(b, weight * (y - p), n), np.bincount(b, weight * p * (1 - p), n), np.bincount(b, weight, n)

    def _gain(self, g: np.ndarray, h: np.ndarray, w: np.ndarray) -> tuple[float, int]:
        """Best cut of a run of bins: (gain, number of bins to its left), gain 0 if there is none."""
        if len(g) < 2:
            return 0.0, 0
        gs, hs, ws = np.cumsum(g), np.cumsum(h), np.cumsum(w)
        left, total = gs[:-1] ** 2 / (hs[:-1] + self.pull), gs[-1] ** 2 / (hs[-1] + self.pull)
        gain = left + (gs[-1] - gs[:-1]) ** 2 / (hs[-1] - hs[:-1] + self.pull) - total
        gain = np.where((ws[:-1] < self.least) | (ws[-1] - ws[:-1] < self.least), 0.0, gain)
        k = int(gain.argmax())
        return float(gain[k]), k + 1

    def _tree(self, g: np.ndarray, h: np.ndarray, w: np.ndarray) -> np.ndarray:
        """A tree over one feature's bins, grown leaf by leaf; its values by bin."""
        leaves = [(0, len(g))]
        while len(leaves) < self.leaves:
            found = [(*self._gain(g[a:b], h[a:b], w[a:b]), i) for i, (a, b) in enumerate(leaves)]
            gain, cut, i = max(found, key=lambda t: (t[0], -t[2]))
            if gain <= 1e-9:
                break
            a, b = leaves[i]
            leaves[i : i + 1] = [(a, a + cut), (a + cut, b)]
        out = np.zeros(len(g))
        for a, b in leaves:
            out[a:b] = g[a:b].sum() / (h[a:b].sum() + self.pull)
        return out

    def _pair_tree(self, g: np.ndarray, h: np.ndarray, w: np.ndarray) -> tuple[float, np.ndarray]:
        """(gain, values): the better feature is cut once, and each side by the other feature."""
        best = (0.0, np.zeros_like(g))
        for turn in (False, True):
            a, b, c = (m.T if turn else m for m in (g, h, w))
            _, cut = self._gain(a.sum(axis=1), b.sum(axis=1), c.sum(axis=1))
            gain, out = -a.sum() ** 2 / (b.sum() + self.pull), np.zeros_like(a)
            for rows in ((slice(0, cut), slice(cut, None)) if cut else (slice(0, None),)):
                left, right, both = a[rows].sum(axis=0), b[rows].sum(axis=0), c[rows].sum(axis=0)
                _, other = self._gain(left, right, both)
                for cols in ((slice(0, other), slice(other, None)) if other else (slice(0, None),)):
                    s, t = left[cols].sum(), right[cols].sum() + self.pull
                    gain += s * s / t
                    out[rows, cols] = s / t
            if gain > best[0]:
                best = (float(gain), out.T if turn else out)
        return best

    def _fit_pairs(self, coarse: list[np.ndarray], margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        shape = [len(c) + 1 for c in self.coarse]
        grid = lambda i, j: [m.reshape(shape[i], shape[j]) for m in self._sums(coarse[i] * shape[j] + coarse[j], shape[i] * shape[j], margin, y, weight)]
        ranked = sorted(((-self._pair_tree(*grid(i, j))[0], i, j) for i in range(len(shape)) for j in range(i)), key=lambda t: t)
        self.pairs = [(i, j) for gain, i, j in ranked[: self.n_pairs] if gain < -1e-9]
        self.pair_tables = [np.zeros((shape[i], shape[j])) for i, j in self.pairs]
        for _ in range(self.pair_cycles):
            for t, (i, j) in enumerate(self.pairs):
                step = self.rate * self._pair_tree(*grid(i, j))[1]
                self.pair_tables[t] += step
                margin += step[coarse[i], coarse[j]]

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of label 1: the tables' entries at the bins, added up."""
        out = np.full(len(x), self.start)
        for table, cuts, v in zip(self.tables, self.cuts, x.T, strict=True):
            out += table[np.searchsorted(cuts, v, side="left")]
        for table, (i, j) in zip(self.pair_tables, self.pairs, strict=True):
            out += table[np.searchsorted(self.coarse[i], x[:, i], side="left"), np.searchsorted(self.coarse[j], x[:, j], side="left")]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def featurize(docs: DataFrame) -> DataFrame:
    """docs(id, text) -> (id, x array<double>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                x = features([(t or "").encode() for t in part.column(1).to_pylist()])
                flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES))
                yield pa.RecordBatch.from_arrays([part.column(0), flat.cast(pa.list_(pa.float64()))], names=["id", "x"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, x array<double>")


def learn(counted: DataFrame, labels: DataFrame) -> AdditiveModel | float:
    """A model of counted(id, x) and labels(id, label); without labels of both kinds the rate of label 1, 0 if there are none.

    Of each label at most EXAMPLES / 2 ids that have features are drawn by hash; weights restore the true rate.
    """
    known = counted.where(F.col("id").isNotNull()).join(labels, "id").groupBy("id").agg(F.min("x").alias("x"), F.max("label").alias("label"))
    known = settle(known, "additive-examples")
    totals = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    if len(totals) < 2:
        return float(next(iter(totals), 0))
    drawn = [known.where(F.col("label") == v).orderBy(F.xxhash64("id"), "id").limit(EXAMPLES // 2).select("x", "label").toArrow() for v in (0, 1)]
    x = np.concatenate([d["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(FEATURES)) for d in drawn])
    y = np.concatenate([np.full(d.num_rows, float(v)) for v, d in enumerate(drawn)])
    weight = np.concatenate([np.full(d.num_rows, totals[v] / d.num_rows) for v, d in enumerate(drawn)])
    return AdditiveModel().fit(x, y, weight * len(weight) / weight.sum())


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(id, score) of every row of ``docs``: the probability of label 1, learned from ``labels``.

    Features are counts over the bytes, words, word runs and lines of the whole text. The model is fitted to a
    bounded sample (``EXAMPLES``); all rows are scored by adding table entries.

    Edge cases: NULL texts count as empty, and empty texts are scored by their features, all 0. Labels that are
    NULL, and labels of ids that ``docs`` lacks, teach nothing; an id labelled twice has its larger label. Without
    labels of both kinds every score is the rate of label 1, 0 without labels. Repeated rows are scored each and are
    one example; of an id with several texts the one with the least features. Other columns are not looked at.
    """
    ship(docs.sparkSession)
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max((F.col(label_col) > 0).cast("int")).alias("label"))
    counted = settle(featurize(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))), "additive-features")
    model = learn(counted, known)
    if isinstance(model, float):
        return counted.select(F.col("id").alias(id_col), F.lit(model).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sent.value.score(x))], names=["id", "score"])

    kind = counted.schema["id"].dataType.simpleString()
    return counted.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def score_held_out(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0, threshold: float = 0.3) -> DataFrame:
    """Learn from labels outside a fold of doc_id, score all: doc_id, held_out, score, predicted."""
    scored = score(docs, labels.where(bucket("doc_id", folds) != fold))
    return scored.select("doc_id", (bucket("doc_id", folds) == fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
