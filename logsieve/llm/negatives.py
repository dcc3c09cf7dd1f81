"""Hard negatives by Fagin's threshold algorithm.

Vectors are dealt to shards by a hash of their id. A shard keeps its integer components and, for every
dimension, its rows in the order of that component: the sorted candidate lists. Anchors meet the shards in blocks
(a stated set of queries against all rows). For an anchor, the list of a dimension is read from its large end
where the anchor's component is positive and from its small end where it is negative; a component of 0 adds nothing
and its list is not read. All rows met this way are scored by random access to their components, many anchors at a
time as a product of integers. What no list has shown yet can score no more than the threshold: the product of the
anchor with the components at which the lists stand. Lists are read four times as deep in each step, until the
threshold falls strictly below the kth score of every window (strictly, as an equal score may have a smaller id), or
below the window's lower end, or the lists are read out.

The search runs twice: for the positives, whose window is everything of the anchor's label, and for the negatives,
with one window of scores for each positive. A shard returns no more than k rows for a window, and of these the
best k are taken over all shards; nothing else of the pairs leaves a task. Shards and blocks of anchors have
fixed sizes in bytes, so a task's memory does not grow, whatever one label or one vector repeated holds.

Defined results: a row whose id, label, vector or any component is null or not finite takes no part; of several
rows of one id the least by label and components stands for it; vectors of different lengths are multiplied over
the components both have; equal scores are ordered by id; a window without rows gives none; an empty table, or
one without anchors, gives no rows; other columns are not read. Scores beyond 64 bits are an error."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.llm.base import quoted, written

# Bytes of integer components of a shard and of a block of anchors, and the most rows of a shard.
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 8 << 20
SHARD_ROWS = 8192
# Anchors that are scored by one product, and the depth of the first step into the lists.
TOGETHER = 32
FIRST_DEPTH = 16
# Ends of a window that is everything.
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def prepared(rows: DataFrame, row_id: Column, label: Column, vector: Column, scale: int) -> DataFrame:
    """id, label, parts (floor of scale * component) of the rows that take part, one per id."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    named = rows.select(row_id.cast("long").alias("id"), label.cast("long").alias("label"), vector.cast("array<double>").alias("vector"))
    whole = named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    parts = F.transform("vector", lambda x: F.floor(F.lit(float(scale)) * x))
    return (
        whole.select("id", F.struct("label", parts.alias("parts")).alias("row"))
        .groupBy("id")
        .agg(F.min("row").alias("row"))
        .select("id", "row.label", "row.parts")
    )


@dataclass
class Shard:
    """Rows in the order of their ids, and for each dimension in the order of its component."""

    ids: np.ndarray
    labels: np.ndarray
    parts: np.ndarray  # rows by dimensions
    order: np.ndarray  # dimensions by places (below 65,536), ascending

    @classmethod
    def of(cls, ids: np.ndarray, labels: np.ndarray, parts: np.ndarray) -> Shard:
        by_id = np.argsort(ids, kind="stable")
        parts = parts[by_id]
        return cls(ids[by_id], labels[by_id], parts, np.ascontiguousarray(np.argsort(parts, axis=0, kind="stable").T.astype(np.uint16)))


def matrix(lists: list[np.ndarray], width: int) -> np.ndarray:
    """Integer vectors as rows of ``width``, shorter ones filled with zeros."""
    out = np.zeros((len(lists), width), dtype=np.int64)
    for i, one in enumerate(lists):
        out[i, : min(width, len(one))] = one[:width]
    return out


def exact(a: np.ndarray, b: np.ndarray) -> type:
    """A type in which the products of integers of ``a`` and ``b`` and their sums are exact."""
    most = lambda x: max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))
    bound = most(a) * most(b) * max(1, a.shape[1])
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object


@dataclass
class Window:
    """The k best rows of an anchor with scores from ``low`` to ``high``."""

    low: int
    high: int
    k: int


def threshold_search(
    shard: Shard, ids: np.ndarray, labels: np.ndarray, parts: np.ndarray, windows: list[list[Window]], same: bool
) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """For each anchor and window, places in the shard and scores of its best rows of the same or of other
    labels, the anchor itself left out; best first."""
    n = len(shard.ids)
    kind = exact(shard.parts, parts)
    held, asked = shard.parts.astype(kind), parts.astype(kind)
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in ids]
    at = np.arange(shard.parts.shape[1])
    for start in range(0, len(ids), TOGETHER):
        group = range(start, min(start + TOGETHER, len(ids)))
        own = asked[start : group.stop]
        positive, negative = np.maximum(own, 0), np.minimum(own, 0)
        seen = np.zeros((len(own), n), dtype=bool)
        scored = np.zeros(n, dtype=bool)
        scores = np.zeros((len(own), n), dtype=kind)
        active, depth = list(range(len(own))), 0
        while active:
            before, depth = depth, min(n, max(FIRST_DEPTH, 4 * depth))
            top, bottom = shard.order[:, n - depth : n - before], shard.order[:, before:depth]
            for g in active:
                seen[g, top[own[g] > 0].ravel()] = True
                seen[g, bottom[own[g] < 0].ravel()] = True
                if depth == n:  # rows that only lists of components 0 hold
                    seen[g] = True
            fresh = np.flatnonzero(seen[active].any(axis=0) & ~scored)
            scores[:, fresh] = own @ held[fresh].T
            if kind is object and np.abs(scores[:, fresh]).max(initial=0) > MOST:
                raise OverflowError("a score is out of 64 bits")
            scored[fresh] = True
            limit = positive @ held[shard.order[:, n - depth], at] + negative @ held[shard.order[:, depth - 1], at]
            still = []
            for g in active:
                label = shard.labels == labels[start + g]
                may = np.flatnonzero(seen[g] & (label if same else ~label) & (shard.ids != ids[start + g]))
                best = [_best(may, scores[g], w) for w in windows[start + g]]
                bound = int(limit[g])
                if depth == n or all(
                    w.low > w.high or bound < w.low or (len(s) == w.k and bound < s[-1])
                    for w, (_, s) in zip(windows[start + g], best)
                ):
                    found[start + g] = best
                else:
                    still.append(g)
            active = still
    return found


def _best(places: np.ndarray, scores: np.ndarray, window: Window) -> tuple[np.ndarray, np.ndarray]:
    """Of ``places`` (ascending, so by id) the best k in the window."""
    own = scores[places]
    inside = (own >= window.low) & (own <= window.high)
    places, own = places[inside], own[inside]
    if len(own) > 4 * window.k:
        may = own >= np.partition(own, len(own) - window.k)[len(own) - window.k]
        places, own = places[may], own[may]
    best = np.argsort(-own, kind="stable")[: window.k]
    return places[best], own[best].astype(np.int64)


def _index(rows: DataFrame, shards: int, width: int) -> DataFrame:
    """The shards, one row each: components and lists as bytes."""

    def build(table: pa.Table) -> pa.Table:
        ids, labels = (table.column(c).to_numpy() for c in ("id", "label"))
        made = Shard.of(ids, labels, matrix(_lists(table.column("parts")), width))
        parts = made.parts.astype(np.result_type(*map(np.min_scalar_type, (-1, made.parts.min(), made.parts.max()))))
        arrays = {"ids": made.ids, "labels": made.labels, "parts": parts, "orders": made.order}
        packed = {k: pa.array([v.tobytes()], pa.binary()) for k, v in arrays.items()}
        return pa.table({"shard": table.column("shard")[:1], "kind": [parts.dtype.str], **packed})

    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(
        build, "shard int, kind string, ids binary, labels binary, parts binary, orders binary"
    )


def _lists(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [x.values.to_numpy(zero_copy_only=False) for chunk in column.chunks for x in chunk]


def _searched(index: DataFrame, shards: int, anchors: DataFrame, blocks: int, k: int, same: bool) -> DataFrame:
    """anchor_id, nth (of the window), row_id, score: the k best rows of each shard in each window of the
    anchors (id, label, parts, lows, highs)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[np.ndarray] = [np.zeros((0, 4), dtype=np.int64)]
        if left.num_rows and right.num_rows:
            ids, labels = (np.frombuffer(left.column(c)[0].as_py(), np.int64) for c in ("ids", "labels"))
            kind = left.column("kind")[0].as_py()
            parts = np.frombuffer(left.column("parts")[0].as_py(), kind).reshape(len(ids), -1)
            order = np.frombuffer(left.column("orders")[0].as_py(), np.uint16).reshape(parts.shape[1], -1)
            shard = Shard(ids, labels, parts, order)
            anchor = right.column("id").to_numpy()
            windows = [
                [Window(low, high, k) for low, high in zip(lows, highs)]
                for lows, highs in zip(right.column("lows").to_pylist(), right.column("highs").to_pylist())
            ]
            own = matrix(_lists(right.column("parts")), parts.shape[1])
            found = threshold_search(shard, anchor, right.column("label").to_numpy(), own, windows, same)
            for a, best in zip(anchor, found):
                for nth, (places, scores) in enumerate(best):
                    out.append(np.stack([np.full(len(places), a), np.full(len(places), nth), ids[places], scores], axis=1))
        rows = np.concatenate(out)
        return pa.table(dict(zip(("anchor_id", "nth", "row_id", "score"), rows.T)))

    # Every block meets every shard; both have bounded sizes.
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    questions = anchors.select("id", "label", "parts", "lows", "highs", block, every)
    copies = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    pairs = copies.groupBy("shard", "block").cogroup(questions.groupBy("shard", "block"))
    found = pairs.applyInArrow(run, "anchor_id long, nth long, row_id long, score long")
    return found.withColumn("rank", F.expr("row_number() OVER (PARTITION BY anchor_id, nth ORDER BY score DESC, row_id)")).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    row_id: Column,
    label: Column,
    vector: Column,
    anchor: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each row for which
    ``anchor`` holds (a condition on ``id``) and each of its best ``positives`` of the same label, the best
    ``negatives`` of other labels that score from ``low`` to ``high`` percent of the positive."""
    table = written(prepared(rows, row_id, label, vector, scale), "vectors")
    counted = table.agg(
        F.count("*").alias("n"), F.max(F.size("parts")).alias("width"), F.count_if(anchor).alias("anchors")
    ).first()
    width = max(1, counted.width or 0)
    shards = max(1, -(-counted.n // max(1, min(SHARD_ROWS, SHARD_BYTES // (8 * width)))))
    blocks = max(1, -(-counted.anchors * 8 * width // BLOCK_BYTES))
    index = written(_index(table, shards, width), "index")
    anchors = table.where(anchor)
    everything = anchors.withColumns({"lows": F.array(F.lit(LEAST)), "highs": F.array(F.lit(MOST))})
    best = written(_searched(index, shards, everything, blocks, positives, same=True), "positives")
    share = lambda percent: F.col("score").cast("decimal(38,0)") * percent / 100
    ends = best.select(
        "anchor_id",
        "rank",
        F.struct(
            F.col("rank"),
            F.ceil(share(low)).cast("long").alias("low"),
            F.floor(share(high)).cast("long").alias("high"),
        ).alias("window"),
    )
    # No more than ``positives`` windows of an anchor.
    windows = ends.groupBy("anchor_id").agg(F.sort_array(F.collect_list("window")).alias("windows"))
    asked = anchors.join(windows, anchors.id == windows.anchor_id).select(
        "id", "label", "parts", F.col("windows.low").alias("lows"), F.col("windows.high").alias("highs")
    )
    found = _searched(index, shards, written(asked, "anchors"), blocks, negatives, same=False)
    named = best.select("anchor_id", (F.col("rank") - 1).cast("long").alias("nth"), F.col("row_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(named, ["anchor_id", "nth"]).select(
        "anchor_id",
        "positive_id",
        "rank",
        F.col("row_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
