"""Benchmark decontamination by an FM-index per shard of training documents.

Test phrases are the windows of a test item's words. A shard is an Arrow batch of documents: its words
become symbols of the test vocabulary, words that no test item has become breaks, and stretches too short
for any window are left out, so the index holds just what could match. All windows are searched
backward at once through the wavelet ranks, occurrences are located by sampled suffix positions, and
the spans they cover are merged. Documents are not shuffled.

Test items reach the tasks in blocks of bounded size; every block is searched in every shard, and the
hits of all blocks are merged.

Defined results: a null or empty text has no words and no hits; items of null text have no windows, an
item of null id takes part but is not listed; repeated items are listed once; columns named like an
added one are replaced."""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsieve.llm.base import binary, columns, lists, quoted, released, slices, text_sizes, without
from logsieve.llm.fmindex import FMIndex

WINDOW = 10
# Words of test items that one block holds, about.
BLOCK_WORDS = 1_000_000
# Bytes of text in a shard, about: a batch is cut where it holds more.
SHARD_BYTES = 4 << 20
# Occurrences that are located at once.
LOCATED = 1 << 20

# ASCII letters and digits and everything beyond ASCII make words; A-Z are lower-cased.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_LOWER = {b: b + 32 for b in range(65, 91)}


def words(data: bytes) -> list[bytes]:
    return data.translate(_FOLD).split()


def word_spans(text: str) -> list[tuple[int, int]]:
    """Where the words stand, in code points."""
    return [m.span() for m in _WORD.finditer(text.translate(_LOWER))]


class Block:
    """Windows of some test items as rows of symbols, and the items of each window."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], window: int):
        self.symbol: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set] = {}
        for item, own in items:
            symbols = [self.symbol.setdefault(w, len(self.symbol) + 2) for w in own]
            for at in range(max(1, len(symbols) - window + 1) if symbols else 0):
                found.setdefault(tuple(symbols[at : at + window]), set()).add(item)
        self.lengths = np.array([len(w) for w in found], dtype=np.int64)
        self.shortest = int(self.lengths.min()) if found else 0
        self.patterns = np.zeros((len(found), window), dtype=np.int64)
        for row, w in enumerate(found):
            self.patterns[row, : len(w)] = w
        listed = [[i for i in items if i is not None] for items in found.values()]
        self.item_ends = np.cumsum([0, *map(len, listed)])
        self.items = np.array([i for x in listed for i in x], dtype=np.int64)

    def search(self, tokens: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hit words (document, word) and items met (document, item), each pair once."""
        none = np.zeros(0, dtype=np.int64)
        counts = np.array([len(t) for t in tokens], dtype=np.int64)
        total = int(counts.sum())
        if not total or not len(self.patterns):
            return none, none, none, none
        get = self.symbol.get
        symbols = np.fromiter(map(get, chain.from_iterable(tokens), repeat(1)), dtype=np.int64, count=total)
        document = np.repeat(np.arange(len(tokens)), counts)
        known = symbols > 1
        edge = np.r_[True, (document[1:] != document[:-1]) | (known[1:] != known[:-1])]
        begin = np.flatnonzero(edge)
        length = np.diff(np.r_[begin, total])
        use = known[begin] & (length >= self.shortest)
        if not use.any():
            return none, none, none, none
        begin, length = begin[use], length[use]
        # The kept stretches, with a break after each.
        out_begin = np.cumsum(np.r_[0, length[:-1] + 1])
        place = np.arange(int((length + 1).sum())) - np.repeat(out_begin, length + 1) + np.repeat(begin, length + 1)
        ends = out_begin + length
        text = symbols[np.minimum(place, total - 1)]
        text[ends] = 1
        index = FMIndex(text, len(self.symbol) + 2)
        low, high = index.search(self.patterns, self.lengths)
        met = np.flatnonzero(high > low)
        cover = np.zeros(len(text) + 1, dtype=np.int64)
        pairs = [np.zeros((0, 2), dtype=np.int64)]
        bounds = np.cumsum(np.r_[0, (high - low)[met]])
        for start in range(0, int(bounds[-1]), LOCATED):
            nth = np.arange(start, min(start + LOCATED, int(bounds[-1])))
            which = np.searchsorted(bounds, nth, side="right") - 1
            window = met[which]
            at = index.locate(low[window] + nth - bounds[which])
            np.add.at(cover, at, 1)
            np.add.at(cover, at + self.lengths[window], -1)
            owner = document[place[at]]
            pair = np.unique(np.stack([owner, window], axis=1), axis=0)
            n_items = np.diff(self.item_ends)[pair[:, 1]]
            inner = np.arange(int(n_items.sum())) - np.repeat(np.cumsum(np.r_[0, n_items[:-1]]), n_items)
            ids = self.items[np.repeat(self.item_ends[pair[:, 1]], n_items) + inner] if len(self.items) else none
            pairs.append(np.unique(np.stack([np.repeat(pair[:, 0], n_items), ids], axis=1), axis=0))
        hit = place[np.flatnonzero(np.cumsum(cover[:-1]) > 0)]
        items = np.unique(np.concatenate(pairs), axis=0)
        return document[hit], hit - (np.cumsum(counts) - counts)[document[hit]], items[:, 0], items[:, 1]


def blocks(bench: DataFrame, item_id: str, text: str, window: int) -> list[Broadcast]:
    """The test items, streamed through the driver a partition at a time, as broadcast blocks."""
    context = bench.sparkSession.sparkContext
    rows = bench.select(
        F.col(quoted(item_id)).cast("long").alias("item"), F.encode(F.col(quoted(text)), "UTF-8").alias("text")
    ).where("text IS NOT NULL")
    out, held, n = [], [], 0
    for row in rows.toLocalIterator():
        own = words(bytes(row["text"]))
        held.append((row["item"], own))
        n += len(own)
        if n >= BLOCK_WORDS:
            out.append(context.broadcast(Block(held, window)))
            held, n = [], 0
    if held:
        out.append(context.broadcast(Block(held, window)))
    return out


def find_contamination(
    docs: DataFrame,
    bench: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items`` (sorted ids met) and ``spans`` (merged spans of
    hit words, code points, end exclusive)."""
    held = blocks(bench, item_id, item_text, window)
    added = T.StructType.fromDDL("n_words long, n_hit long, items array<long>, spans array<struct<start:int,end:int>>")
    kept = without(docs, added.fieldNames())
    schema = T.StructType([*(docs.schema[c] for c in kept), *added.fields])
    span_type = pa.struct([("start", pa.int32()), ("end", pa.int32())])

    def shard(array: pa.Array) -> list[pa.Array]:
        tokens = [words(d) for d in binary(array)]
        n = len(tokens)
        hits, met = [np.zeros((0, 2), np.int64)], [np.zeros((0, 2), np.int64)]
        for block in held:
            doc, word, item_doc, item = block.value.search(tokens)
            hits.append(np.stack([doc, word], axis=1))
            met.append(np.stack([item_doc, item], axis=1))
        hits, met = hits[-1] if len(held) == 1 else np.unique(np.concatenate(hits), axis=0), np.unique(np.concatenate(met), axis=0)
        n_hit = np.bincount(hits[:, 0], minlength=n)
        spans: list[list[dict]] = [[] for _ in range(n)]
        for doc in np.flatnonzero(n_hit):
            own = hits[hits[:, 0].searchsorted(doc) : hits[:, 0].searchsorted(doc, side="right"), 1]
            at = word_spans(array[int(doc)].as_py())
            cuts = np.flatnonzero(np.r_[True, np.diff(own) > 1])
            lasts = np.r_[cuts[1:], len(own)] - 1
            spans[doc] = [{"start": at[own[a]][0], "end": at[own[b]][1]} for a, b in zip(cuts, lasts)]
        return [
            pa.array([len(t) for t in tokens], pa.int64()),
            pa.array(n_hit, pa.int64()),
            lists(met[:, 1], np.bincount(met[:, 0], minlength=n), pa.int64()),
            pa.array(spans, pa.list_(span_type)),
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_sizes(batch.column(len(kept))), SHARD_BYTES):
                arrays = [*part.columns[: len(kept)], *shard(part.column(len(kept)))]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    return docs.select(*columns(docs, kept), F.col(quoted(text)).alias("__text")).mapInArrow(released(run), schema)


def without_spans(text: str, spans: str) -> Column:
    """The text with these spans taken out (expressions over SQL column names)."""
    return F.expr(
        f"concat(array_join(transform({spans}, (s, i) -> substring({text}, "
        f"if(i = 0, 0, {spans}[i - 1].end) + 1, s.start - if(i = 0, 0, {spans}[i - 1].end))), ''), "
        f"substring({text}, if(size({spans}) = 0, 0, {spans}[size({spans}) - 1].end) + 1))"
    )
