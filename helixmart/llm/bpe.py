"""BPE with word ends: a backtracking encoder over Aho-Corasick matches, and a decoder over an offset table."""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helixmart.llm.common import lean, ship, table_of_worker

# White space as the tokenizer's patterns know it.
SPACE = "\t\n\x0b\x0c\r \x85\xa0                　"
# Control characters that str.split takes for white space and the tokenizer does not.
NOT_SPACE = "\x1c\x1d\x1e\x1f"
# Remembered pieces and chunks per worker; beyond it the memory starts anew. Only time depends on it: a forgotten piece
# is merged again, a forgotten chunk is only cut again.
MOST_PIECES = 300_000
MOST_CHUNKS = 50_000
# Pairs of tokens remembered as fitting or not, in the same way.
MOST_PAIRS = 200_000


def _byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return [chr(b) if b in set(shown) else chr(256 + hidden.index(b)) for b in range(256)]


class Vocabulary:
    """One tokenizer file for encoding: normaliser, pieces, matches and pair compatibility."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(pattern.replace(r"\s", SPACE))
        self.splitter = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.spaces = re.compile(f"[{SPACE}]+")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.made = {(self.ids[a], self.ids[b]): (rank, self.ids[a + b]) for rank, (a, b) in enumerate(merges)}
        self.halves = {t: (a, b, rank) for (a, b), (rank, t) in self.made.items()}
        # A word's symbols: the byte's stand-in, or for the last byte its form with the word end, as one character.
        self.symbols = _byte_symbols()
        self.inner = {s: chr(0xE000 + b) for b, s in enumerate(self.symbols)}
        self.last = {s: chr(0xE100 + b) for b, s in enumerate(self.symbols)}
        self.inner_of = {b: 0xE000 + b for b in range(256)}
        # The pattern's own form for pieces of ASCII characters.
        self.ascii_pieces = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+", re.ASCII).findall
        self.machine = ahocorasick.Automaton()
        self.longest_prefix: dict[int, int] = {}
        spelled = {self._spell(token): i for token, i in self.ids.items()}
        self.width = {i: len(s) for s, i in spelled.items()}
        for s, i in spelled.items():
            self.machine.add_word(s, i)
            for n in range(len(s) - 1, 0, -1):
                if (shorter := spelled.get(s[:n])) is not None:
                    self.longest_prefix[i] = shorter
                    break
        self.machine.make_automaton()
        self.most = max(self.ids.values()) + 1
        self.fits: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.known_pieces: dict[str, bytes] = {}

    def _spell(self, token: str) -> str:
        if token.endswith(self.end) and token != self.end:
            body = token[: -len(self.end)]
            return "".join(self.inner[c] for c in body[:-1]) + self.last[body[-1]]
        return "".join(self.inner[c] for c in token)

    def _edge(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """(part, rank that makes it, rank that hides it) from the token down to a symbol."""
        out, hidden = [], 1 << 60
        while token in self.halves:
            left, right, rank = self.halves[token]
            out.append((token, rank, hidden))
            token, hidden = (right if side else left), rank
        out.append((token, -1, hidden))
        return out

    def _check(self, a: int, b: int) -> bool:
        """Whether ``a`` and ``b`` may stand side by side: no merge across their border comes before one that hides it.

        The parts that touch the border are a's right edge and b's left edge, each for as long as it has
        not been merged into the next larger part. A merge across wins if both parts exist when its turn
        comes; at equal rank the left one of two merges goes first.
        """
        left = self._edge(b, 0)
        for x, x_made, x_hidden in self._edge(a, 1):
            for y, y_made, y_hidden in left:
                across = self.made.get((x, y))
                if across is not None and max(x_made, y_made) < across[0] < x_hidden and across[0] <= y_hidden:
                    return False
        return True

    def word(self, symbols: str) -> list[int]:
        """The merges' result for one word. Takes the longest token, steps back where neighbours do not fit."""
        width, fits, shorter, most = self.width, self.fits, self.longest_prefix, self.most
        if len(fits) > MOST_PAIRS:
            fits.clear()
        longest = [-1] * (len(symbols) + 1)
        for end, token in self.machine.iter(symbols):  # of the matches from one start, the longest ends last
            longest[end + 1 - width[token]] = token
        token = longest[0]
        if width.get(token) == len(symbols):
            return [token]
        out: list[int] = []
        dead: set[int] = set()  # positions from which no way leads on
        at, size, before = 0, len(symbols), -1
        while at < size:
            while token >= 0:
                end = at + width[token]
                if end not in dead:
                    fit = before < 0 or fits.get(before * most + token)
                    if fit is None:
                        fit = fits[before * most + token] = self._check(before, token)
                    if fit:
                        break
                token = shorter.get(token, -1)
            if token >= 0:
                out.append(token)
                before, at = token, end
                token = longest[end]
            elif out:
                dead.add(at)
                last = out.pop()
                before = out[-1] if out else -1
                at -= width[last]
                token = shorter.get(last, -1)
            else:
                raise ValueError("the vocabulary cannot spell this word")
        return out

    def piece(self, piece: str) -> bytes:
        """Ids of one piece, packed as int32."""
        packed = self.known_pieces.get(piece)
        if packed is None:
            raw = piece.encode()
            ids = self.word(raw[:-1].decode("latin-1").translate(self.inner_of) + chr(0xE100 + raw[-1]))
            packed = struct.pack(f"{len(ids)}i", *ids)
            if len(self.known_pieces) > MOST_PIECES:
                self.known_pieces.clear()
            self.known_pieces[piece] = packed
        return packed

    def chunk(self, text: str) -> bytes:
        """Ids of a stretch without white space, packed as int32."""
        if text.isascii() and "<|" not in text:
            return b"".join(map(self.piece, self.ascii_pieces(text.lower())))
        out: list[bytes] = []
        for part in self.splitter.split(text):
            if part in self.special:
                out.append(struct.pack("i", self.special[part]))
                continue
            # Lower case goes character by character, so a final sigma has no form of its own.
            plain = unicodedata.normalize("NFC", part).replace("\u03a3", "\u03c3").lower()
            out += map(self.piece, self.pieces.findall(plain))
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        if len(self.known) > MOST_CHUNKS:
            self.known.clear()
        known = self.known
        chunks = self.spaces.split(text) if any(c in text for c in NOT_SPACE) else text.split()
        try:
            return b"".join([known[c] for c in chunks])
        except KeyError:
            for c in set(chunks):
                if c not in known:
                    known[c] = self.chunk(c)
            return b"".join([known[c] for c in chunks])


class OffsetTable:
    """All token strings, each with a blank, in one byte table, and where each starts."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        names = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        shown = [(names.get(i, "") + " ").encode() for i in range(max(names) + 1)]
        self.blob = np.frombuffer(b"".join(shown), dtype=np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(b) for b in shown])]).astype(np.int64)

    def decode(self, ids: np.ndarray) -> bytes:
        """Token strings joined by single blanks, cut out of one byte table by offsets."""
        if not len(ids):
            return b""
        starts, sizes = self.offsets[ids], self.offsets[ids + 1] - self.offsets[ids]
        ends = np.cumsum(sizes)
        places = np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])
        return self.blob[places].tobytes()[:-1]


@table_of_worker
def offset_table(path: str) -> OffsetTable:
    """One per worker process."""
    return OffsetTable(path)


@table_of_worker
def vocabulary(path: str) -> Vocabulary:
    """One per worker process."""
    return Vocabulary(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Token ids of every text: (id, ids array<int>), and the columns in ``keep`` as they are.

    ``path`` names the tokenizer's file on every worker; it must be a BPE model with a word-end suffix.
    NULL and empty texts, and texts of white space only, have no ids; repeated rows and ids stay rows;
    an empty table gives none. Memory follows the longest text of a batch.
    """
    source, schema = _coded(docs, id_col, text_col, keep)
    return source.mapInArrow(lean(lambda batches: _encoded(batches, path), __name__), schema)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the decoded text of ``ids``: with no decoder in the file, token strings joined by single blanks.

    NULL ids decode to the empty text. Special tokens are kept.
    """
    ship(encoded.sparkSession)
    schema = T.StructType([*encoded.schema.fields, T.StructField(out, T.StringType())])
    place = encoded.columns.index(ids_col)
    return encoded.mapInArrow(lean(lambda batches: _decoded(batches, path, place, out), __name__), schema)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, out: str = "decoded") -> DataFrame:
    """``decode`` of ``encode``, row for row, in one pass: a task needs one worker, and ids cross to it and back once."""
    source, schema = _coded(docs, id_col, text_col, keep)
    place = len(schema) - 1
    return source.mapInArrow(lean(lambda batches: _decoded(_encoded(batches, path), path, place, out), __name__), schema.add(out, T.StringType()))


def _coded(docs: DataFrame, id_col: str, text_col: str, keep: list[str] | None) -> tuple[DataFrame, T.StructType]:
    """The columns that go to the workers, the text last, and what comes back with ids in its place."""
    ship(docs.sparkSession)
    kept = [c for c in (keep or []) if c != id_col]
    source = docs.select(F.col(id_col).alias(id_col), *kept, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return source, T.StructType([*source.drop("_text").schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))])


def _encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    vocab = vocabulary(path)
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            packed = [vocab.encode(t) for t in part.column(part.num_columns - 1).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(b) // 4 for b in packed])]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(packed), dtype=np.int32))
            ids = pa.ListArray.from_arrays(pa.array(offsets), values)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], ids], names=[*part.schema.names[:-1], "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], path: str, place: int, out: str) -> Iterator[pa.RecordBatch]:
    table = offset_table(path)
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            lists = part.column(place)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(np.asarray([n or 0 for n in pc.list_value_length(lists).to_pylist()], dtype=np.int64))
            texts = [table.decode(flat[a:b]).decode() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, out])
