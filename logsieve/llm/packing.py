"""Packing token ids into sequences by the sum-of-squares rule.

A document is its ids and one end id. What fills whole sequences is cut off as such; the rest is placed whole, as
it comes: into the fill level that leaves the smallest sum of squared counts of partially filled windows. The
counts by level are an array, and only levels that hold a window can be chosen, or level 0, a new window. Of
equally good levels the fullest is taken.

Some sizes never fill a window together (copies of one document of over half a window), and some windows are open
when a task ends. Then, and whenever ``OPEN`` windows are open, the emptiest are poured into the fullest, where
cutting is free, until one is left. The last one of a task is dealt to sequences whose lengths are its powers of
two, so that nothing is padded at all. A task holds no more than its open windows beside a batch; nothing is
shuffled, and a task that is lost is packed again by itself.

Texts are tokenized word by word (no token of this kind of vocabulary crosses white space), each word once per
worker while it stays in a bounded table. A new word of Latin letters, and perhaps punctuation behind them, is cut and
lower-cased here and goes straight to the tokenizer's model; all others go through the whole tokenizer.

Defined results: a null or empty text is its end id alone; repeated rows and ties are packed each by itself; an
empty table gives no rows; ids of documents may be null and of any type; other columns are not read; a text of any
length is packed whole, and words of any length are, just not kept in the table. Strings of special tokens are
ordinary text."""

from __future__ import annotations

import os
import re
import struct
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsieve.llm.base import quoted, released, slices, text_sizes
from logsieve.llm.bpe import byte_characters

LENGTH = 2048
# Windows that a task holds open at once.
OPEN = 256
# Words kept per worker (twice, with the older half), and the longest that is kept.
KEPT_WORDS = 400_000
KEPT_CHARS = 64
SLICE = 2 << 20
# Letters that are composed already and whose lower case does not depend on others, and punctuation that makes
# one token of its own run (not the apostrophe).
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-įĲ-ɏ]+)([!-&(-/:-@\[-`{-~]*)")
# What Python takes for white space and the tokenizer does not.
_NO_SPACE = re.compile("[\x1c-\x1f]")


class Words(dict):
    """The ids (uint32, little-endian) of words, worked out when a word is met first."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task per core already
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True
        self.tokenize = self.tokenizer.model.tokenize
        self.letters = dict(enumerate(byte_characters()))
        self.older: dict[str, bytes] = {}
        self.bases: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self._ids(word)
        if len(word) <= KEPT_CHARS:
            self[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        if word.isascii() and word.isalpha():
            return self._base(word.lower())
        plain = _PLAIN.fullmatch(word)
        if plain:
            return self._base(plain[1].lower()) + (self._base(plain[2]) if plain[2] else b"")
        return _packed(self.tokenizer.encode(word, add_special_tokens=False).ids)

    def _base(self, word: str) -> bytes:
        """The ids of what the tokenizer does not cut any further."""
        ids = self.bases.get(word)
        if ids is None:
            letters = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
            ids = _packed([t.id for t in self.tokenize(letters)])
            if len(self.bases) >= KEPT_WORDS:
                self.bases.clear()
            if len(word) <= KEPT_CHARS:
                self.bases[word] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self) > KEPT_WORDS:  # words that are met again come back from the older half
            self.older = dict(self)
            self.clear()
        get = self.__getitem__
        return [b"".join(map(get, [t] if _NO_SPACE.search(t) else t.split())) for t in texts]


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


@lru_cache(maxsize=1)
def _words(spec: str) -> Words:
    return Words(spec)


@dataclass
class Piece:
    """Some ids of a document, from ``start`` on."""

    doc_id: object
    doc_tokens: int
    start: int
    ids: np.ndarray

    def cut(self, n: int) -> tuple[Piece, Piece]:
        rest = Piece(self.doc_id, self.doc_tokens, self.start + n, self.ids[n:])
        return Piece(self.doc_id, self.doc_tokens, self.start, self.ids[:n]), rest


@dataclass
class Window:
    """A partially filled sequence."""

    pieces: list[Piece] = field(default_factory=list)
    fill: int = 0

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.fill += len(piece.ids)


class Packer:
    """Places documents as they come; ``done`` collects the sequences that are finished."""

    def __init__(self, length: int = LENGTH, most: int = OPEN):
        self.length, self.most = length, most
        self.counts = np.zeros(length + 1, dtype=np.int64)  # windows at each level
        self.windows: list[list[Window]] = [[] for _ in range(length + 1)]
        self.n_open = 0
        self.done: list[list[Piece]] = []

    def level(self, size: int) -> int:
        """The level into which ``size`` ids go: 0 for a new window."""
        room = self.length - size
        at = np.flatnonzero(self.counts[1 : room + 1]) + 1
        after = 2 * self.counts[at + size] + 1
        after[at + size == self.length] = 0
        change = after + 1 - 2 * self.counts[at]
        fresh = 2 * self.counts[size] + 1
        if not len(at) or change.min() > fresh:
            return 0
        return int(at[len(at) - 1 - np.argmin(change[::-1])])

    def place(self, piece: Piece) -> None:
        while len(piece.ids) >= self.length:
            whole, piece = piece.cut(self.length)
            self.done.append([whole])
        size = len(piece.ids)
        if not size:
            return
        if piece.start:  # an open window must not keep all of a long document
            piece.ids = piece.ids.copy()
        at = self.level(size)
        window = self._take(at) if at else Window()
        window.add(piece)
        if window.fill == self.length:
            self.done.append(window.pieces)
        else:
            self._put(window)
        if self.n_open > self.most:
            self.pour()

    def _take(self, level: int) -> Window:
        self.counts[level] -= 1
        self.n_open -= 1
        return self.windows[level].pop()

    def _put(self, window: Window) -> None:
        self.counts[window.fill] += 1
        self.n_open += 1
        self.windows[window.fill].append(window)

    def pour(self) -> None:
        """Fill the fullest windows from the emptiest until one is left open."""
        left = deque(w for level in self.windows for w in level)
        self.windows = [[] for _ in self.windows]
        self.counts[:] = 0
        self.n_open = 0
        while left:
            window = left.pop()
            while window.fill < self.length and left:
                source = left[0]
                piece = source.pieces.pop()
                source.fill -= len(piece.ids)
                room = self.length - window.fill
                if len(piece.ids) > room:
                    piece, rest = piece.cut(room)
                    source.add(rest)
                window.add(piece)
                if not source.pieces:
                    left.popleft()
            if window.fill == self.length:
                self.done.append(window.pieces)
            else:
                self._put(window)

    def close(self) -> None:
        """Finish what is open: the last window as sequences of its powers of two."""
        self.pour()
        for window in chain.from_iterable(self.windows):
            pieces = window.pieces[::-1]
            for bit in reversed(range(window.fill.bit_length())):
                room, sequence = window.fill & (1 << bit), []
                while room:
                    piece = pieces.pop()
                    if len(piece.ids) > room:
                        piece, rest = piece.cut(room)
                        pieces.append(rest)
                    sequence.append(piece)
                    room -= len(piece.ids)
                if sequence:
                    self.done.append(sequence)
        self.windows = [[] for _ in self.windows]
        self.counts[:] = 0
        self.n_open = 0


def read_spec(path: str) -> str:
    """The JSON of a tokenizer."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def pack(
    docs: DataFrame, spec: str, doc_id: str = "doc_id", text: str = "text", end: int = 1, length: int = LENGTH, most: int = OPEN
) -> DataFrame:
    """doc_id, start, length, ids (binary, little-endian uint32), doc_tokens, sequence_id, offset of every
    piece. ``spec`` is the tokenizer's JSON; it has a fixed size and is broadcast."""
    held = docs.sparkSession.sparkContext.broadcast(spec)
    kind = docs.schema[doc_id].dataType
    schema = T.StructType(
        [
            T.StructField("doc_id", kind),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    # The number of the partition makes sequence ids unique without a shuffle.
    source = docs.select(
        F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).alias("text"), F.spark_partition_id().cast("long").alias("part")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, packer, tail = _words(held.value), Packer(length, most), np.array([end], dtype="<u4").tobytes()
        emit = _emitter(packer)
        for batch in batches:
            for rows in slices(batch, text_sizes(batch.column(1)), SLICE):
                emit.part, emit.kind = rows.column(2)[0].as_py(), rows.column(0).type
                ids = words.encode([t or "" for t in rows.column(1).to_pylist()])
                for key, own in zip(rows.column(0).to_pylist(), ids):
                    own = np.frombuffer(own + tail, dtype="<u4")
                    packer.place(Piece(key, len(own), 0, own))
                yield from emit()
        packer.close()
        yield from emit()

    return source.mapInArrow(released(run), schema)


class _emitter:
    """Turns the finished sequences of a packer into batches of pieces."""

    def __init__(self, packer: Packer):
        self.packer, self.n, self.part, self.kind = packer, 0, 0, pa.null()

    def __call__(self) -> Iterator[pa.RecordBatch]:
        done, self.packer.done = self.packer.done, []
        for at in range(0, len(done), 500):
            part = done[at : at + 500]
            rows = []
            for sequence in part:
                number, offset = (self.part << 33) + self.n, 0
                self.n += 1
                for p in sequence:
                    rows.append((p.doc_id, p.start, len(p.ids), p.ids.tobytes(), p.doc_tokens, number, offset))
                    offset += len(p.ids)
            kinds = (self.kind, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            names = ("doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
