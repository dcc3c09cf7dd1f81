"""A trie of conversations by their common first turns, from ternary search trees per range shard.

1. Rows. Turns are put in order by one range-partitioned sort of narrow rows (id, turn, digest), so that one
   conversation of very many turns is many tasks' work; a turn's place is its place in its partition plus the
   counts of the partitions before. A conversation's first turns are those of its base (see ``rebuilt``). Turns are packed
   to rows of at most ``SEGMENT`` turns, with the digest of all that comes before them.
2. Shards. Rows are range-partitioned by segment, digest of what comes before, and turns; then id. A shard is a
   run of sorted rows of at most ``SHARD_TURNS`` turns (one row at least). It encodes its turns by a dictionary of
   their sorted digests and inserts its distinct sequences of codes into a ternary search tree, medians first, so
   that the tree is balanced. A node's middle child begins the level of the next turn. An iterative traversal,
   deepest nodes first, adds up members, leaves and savings.
3. Boundaries. Only prefixes of a shard's first and last row can go on in another shard (those of rows that go on
   in a further segment are open as well). These nodes are merged by their digest; each is owned by the first shard
   that has it, and what it adds to the sums of its ancestors is added up in that shard, where all of them
   are. All other nodes are final where they were made.
4. Segments are worked off from the last to the first; the sums of a tree of a later segment are added to the node
   that it goes on from. Conversations of up to SEGMENT turns are one segment.

A first turn or a whole conversation that a third of all rows share is spread over many shards. The ids of the
conversations that end at a node are hashed in one stream, sorted by id, as SHA-256 has to be: a shard hands on
its ids as one text, and a task holds one such text at a time.

Defined results: rows without an id are no conversation; a null role or text is empty; turns of one conversation
with equal numbers (null counts as one, before all others) are ordered by their digests, repeated rows are repeated
turns; an empty table gives no nodes, not even a root; other columns are not read; texts of any length
are held by their digests and lengths only."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from logsieve.llm.base import quoted, written
from logsieve.operators.lookup import lookup_join

SEGMENT = 4096
SHARD_TURNS = 100_000
# Bytes of a digest.
KEY = 16
ROOT = bytes(KEY)


def turn_digest() -> Column:
    """The first half of the SHA-256 of a turn's role and text, the role's length before them."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.substring(F.sha2(whole, 256), 1, 2 * KEY))


def ordered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 1), key, size of every row of ``turns`` (conv_id, turn, role, text)."""
    narrow = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        turn_digest().alias("key"),
        F.octet_length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long").alias("size"),
    )
    by = ["conv_id", "turn", "key"]
    laid = narrow.repartitionByRange(*by).sortWithinPartitions(*by).withColumns(
        {"part": F.spark_partition_id(), "seq": F.monotonically_increasing_id()}
    )
    laid = written(laid, "turns")
    parts = laid.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    before = "coalesce(sum(n) OVER (PARTITION BY conv_id ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"
    parts = parts.select("conv_id", "part", "first", F.expr(before).alias("before"))
    return laid.join(parts, ["conv_id", "part"]).select(
        "conv_id", (F.col("before") + F.col("seq") - F.col("first") + 1).alias("place"), "key", "size"
    )


def rebuilt(turns: DataFrame, spread: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Every conversation c, and the turns (conv_id, place, key, size) that make it up: the first h of
    conversation c - c % spread, then its own after its first h; h is the CRC-32 of c's digits modulo heads."""
    places = written(ordered_turns(turns), "places")
    head = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(heads))
    base = F.col("conv_id") - F.col("conv_id") % spread
    every = places.where("place = 1").select("conv_id", head.alias("h"), base.alias("base"))
    first = (
        places.where((F.col("place") < heads) & (F.col("conv_id") % spread == 0))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(F.struct("place", "key", "size"))).alias("first"))  # heads - 1 at most
        .select(F.col("conv_id").alias("base"), "first")
    )
    every = written(
        every.join(first, "base", "left").select(
            "conv_id", "h", F.when(F.col("h") > 0, F.slice("first", F.lit(1), F.greatest("h", F.lit(1)).cast("int"))).alias("taken")
        ),
        "conversations",
    )
    given = every.select("conv_id", F.inline("taken"))
    # Where the base has fewer turns than h, the conversation's own move up.
    missing = every.withColumn("missing", F.col("h") - F.coalesce(F.size("taken"), F.lit(0)))
    moves = missing.where("missing > 0").select(F.col("conv_id").alias("key"), "missing")
    own = places.where(F.col("place") > head).select(F.col("conv_id").alias("key"), "place", F.col("key").alias("turn_key"), "size")
    own = lookup_join(own, moves, how="left", bound=moves).select(
        F.col("key").alias("conv_id"),
        (F.col("place") - F.coalesce("missing", F.lit(0))).alias("place"),
        F.col("turn_key").alias("key"),
        "size",
    )
    return every.select("conv_id"), given.unionByName(own)


def segments(every: DataFrame, turns: DataFrame, most: int = SEGMENT) -> DataFrame:
    """segment, prefix (digest of all before), keys, sizes (packed), conv_id, more (another segment follows):
    every conversation in rows of at most ``most`` turns; one without turns has one row without any."""
    packed = (
        turns.withColumn("segment", F.floor((F.col("place") - 1) / most).cast("long"))
        .groupBy("conv_id", "segment")
        .agg(F.sort_array(F.collect_list(F.struct("place", "key", "size"))).alias("turns"))
        .select("conv_id", "segment", "turns.key", "turns.size")
    )
    packed = every.join(packed, "conv_id", "left").select("conv_id", F.coalesce("segment", F.lit(0)).alias("segment"), "key", "size")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [b"".join(k or ()) for k in batch.column(2).to_pylist()]
            sizes = [np.array(s or (), dtype=np.int64).tobytes() for s in batch.column(3).to_pylist()]
            arrays = [*batch.columns[:2], *(pa.array(x, pa.binary()) for x in (keys, sizes, map(_digest, keys)))]
            yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", "segment", "keys", "sizes", "own"])

    rows = written(packed.mapInArrow(pack, "conv_id long, segment long, keys binary, sizes binary, own binary"), "segments")
    later = rows.where("segment > 0")
    if later.isEmpty():
        prefix, more = F.lit(ROOT), F.lit(False)
    else:  # the digests of the segments before, folded; a row per ``most`` turns takes part
        before = F.expr("collect_list(own) OVER (PARTITION BY conv_id ORDER BY segment ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
        half = lambda data: F.unhex(F.substring(F.sha2(data, 256), 1, 2 * KEY))
        folded = F.aggregate("before", F.lit(ROOT), lambda done, own: half(F.concat(done, own)))
        long = rows.join(later.select("conv_id").distinct(), "conv_id", "left_semi").withColumn("before", before)
        known = long.select(
            "conv_id", "segment", folded.alias("prefix"), F.expr("lead(true, 1, false) OVER (PARTITION BY conv_id ORDER BY segment)").alias("more")
        )
        rows = rows.join(known, ["conv_id", "segment"], "left")
        prefix, more = F.coalesce("prefix", F.lit(ROOT)), F.coalesce("more", F.lit(False))
    return rows.select("segment", prefix.alias("prefix"), "keys", "sizes", "conv_id", more.alias("more"))


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=KEY).digest()


def path_digests(prefix: bytes, keys: list[bytes], segment: int) -> list[bytes]:
    """A digest for each prefix of ``keys`` after what ``prefix`` stands for; that of a whole segment is
    the prefix of the next one, as ``segments`` folds it."""
    state, out = hashlib.blake2b(prefix, digest_size=KEY), []
    for key in keys:
        state.update(key)
        out.append(state.copy().digest())
    if len(keys) == segment:
        out[-1] = hashlib.sha256(prefix + _digest(b"".join(keys))).digest()[:KEY]
    return out


class TernaryTree:
    """Sequences of codes. Nodes are numbered as they are made; node 0 is the root, a prefix without codes. A
    node's ``below`` is the topmost of the search tree of its children, ``low`` and ``high`` lead to its siblings."""

    def __init__(self) -> None:
        self.code, self.parent, self.depth = [-1], [-1], [0]
        self.low, self.below, self.high = [0], [0], [0]

    def child(self, node: int, code: int) -> int:
        """The child of ``node`` for a code, made if it is not there."""
        code_of, low, high = self.code, self.low, self.high
        at = self.below[node]
        if not at:
            self.below[node] = made = self._make(node, code)
            return made
        while True:
            here = code_of[at]
            if code == here:
                return at
            side = low if code < here else high
            if not side[at]:
                side[at] = made = self._make(node, code)
                return made
            at = side[at]

    def _make(self, parent: int, code: int) -> int:
        self.code.append(code)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        for links in (self.low, self.below, self.high):
            links.append(0)
        return len(self.code) - 1

    def insert(self, codes: list[int]) -> int:
        node = 0
        for code in codes:
            node = self.child(node, code)
        return node

    def children(self, node: int) -> Iterator[int]:
        stack = [self.below[node]]
        while stack:
            at = stack.pop()
            if at:
                yield at
                stack += (self.low[at], self.high[at])

    def deepest_first(self) -> list[int]:
        """All nodes, each after every node below it."""
        order = [0]
        for node in order:
            order.extend(self.children(node))
        return order[::-1]


def medians(n: int) -> Iterator[int]:
    """0 to n - 1: the median, then the medians of both halves, and so on."""
    ranges = [(0, n)]
    for low, high in ranges:
        if low < high:
            middle = (low + high) // 2
            yield middle
            ranges += ((low, middle), (middle + 1, high))


@dataclass
class Row:
    prefix: bytes
    keys: bytes
    sizes: bytes
    conv_id: int
    more: bool


# Nodes as shards make them: closed ones are final but for the id of an open parent.
PIECES = (
    "open boolean, key binary, parent binary, parent_conv_id long, depth long, size long, shard long, n long, "
    "least long, children long, leaves long, saved long, ends string"
)


def shard_nodes(rows: list[Row], shard: int, depth: int, segment: int) -> Iterator[tuple]:
    """The nodes (as PIECES) of sorted rows of one segment that begins at ``depth``: a tree for each prefix."""
    start = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or rows[i].prefix != rows[start].prefix:
            yield from _tree_nodes(rows[start:i], start == 0, i == len(rows), shard, depth, segment)
            start = i


def _tree_nodes(rows: list[Row], first: bool, last: bool, shard: int, depth: int, segment: int) -> Iterator[tuple]:
    cut = [[r.keys[i : i + KEY] for i in range(0, len(r.keys), KEY)] for r in rows]
    # The dictionary of this shard: codes in the order of the digests.
    codes = {k: code for code, k in enumerate(sorted(set(chain.from_iterable(cut))))}
    distinct = [i for i in range(len(rows)) if not i or rows[i].keys != rows[i - 1].keys]
    tree, node_of = TernaryTree(), {}
    for m in medians(len(distinct)):
        node_of[distinct[m]] = tree.insert([codes[k] for k in cut[distinct[m]]])
    count = len(tree.code)
    n, least, size, children, leaves, saved = ([0] * count for _ in range(6))
    ends: dict[int, list[int]] = {}
    key = [b""] * count  # of open nodes
    key[0] = rows[0].prefix
    for i, row in enumerate(rows):
        fresh = i in node_of
        node = node_of[i] if fresh else node
        n[node] += 1
        least[node] = row.conv_id if n[node] == 1 else min(least[node], row.conv_id)
        if not row.more:
            ends.setdefault(node, []).append(row.conv_id)
        if fresh:
            above = node
            for own in np.frombuffer(row.sizes, np.int64)[::-1].tolist():
                if size[above]:
                    break
                size[above] = own
                above = tree.parent[above]
        # What may go on elsewhere: prefixes of the first and the last row, and of rows of several segments.
        if (first and i == 0) or (last and i == len(rows) - 1) or row.more:
            above = node
            for digest in reversed(path_digests(rows[0].prefix, cut[i], segment)):
                key[above] = digest
                above = tree.parent[above]
    order = tree.deepest_first()
    for at in order[:-1]:
        parent = tree.parent[at]
        least[parent] = min(least[parent], least[at]) if n[parent] else least[at]
        n[parent] += n[at]
        if not key[at]:  # all below a closed node is closed
            leaves[at] = leaves[at] or 1
            saved[at] += (n[at] - 1) * size[at]
            children[parent] += 1
            leaves[parent] += leaves[at]
            saved[parent] += saved[at]
    for at in order:
        parent, own = tree.parent[at], ends.get(at)
        text = ",".join(map(str, own)) if own else None
        above = key[parent] if at else None
        if not key[at]:
            text = hashlib.sha256((text or "").encode()).hexdigest()
        known = least[parent] if at and not above else None
        yield (
            bool(key[at]), key[at] or None, above or None, known, depth + tree.depth[at], size[at], shard, n[at],
            least[at], children[at], leaves[at], saved[at], text,
        )


def _shards(rows: DataFrame, depth: int, segment: int, most: int) -> DataFrame:
    by = ["prefix", "keys", "conv_id"]
    laid = rows.select(*by, "sizes", "more").repartitionByRange(*by).sortWithinPartitions(*by)
    laid = laid.withColumn("part", F.spark_partition_id().cast("long"))
    kinds = T._parse_datatype_string(PIECES)
    names = kinds.fieldNames()
    types = [to_arrow_type(f.dataType) for f in kinds]

    def batches_of(nodes: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        while part := list(islice(nodes, 5_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, turns, shard = [], 0, None
        for batch in batches:
            for prefix, keys, conv_id, sizes, more, part in zip(*(c.to_pylist() for c in batch.columns)):
                shard = part << 32 if shard is None else shard
                if rows and turns + len(keys) // KEY > most:
                    yield from batches_of(shard_nodes(rows, shard, depth, segment))
                    rows, turns, shard = [], 0, shard + 1
                rows.append(Row(prefix, keys, sizes, conv_id, more))
                turns += len(keys) // KEY + 1
        if rows:
            yield from batches_of(shard_nodes(rows, shard, depth, segment))

    return laid.mapInArrow(run, PIECES)


def _ends(opened: DataFrame) -> DataFrame:
    """key, ends_sha256 of open nodes: their texts in the order of the shards, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, state = None, None
        for batch in batches:
            found = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key == done:
                    state.update(b"," + text.encode())
                    continue
                if state:
                    found.append((done, state.hexdigest()))
                done, state = key, hashlib.sha256(text.encode())
            if found:
                yield _pairs(found)
        if state:
            yield _pairs([(done, state.hexdigest())])

    texts = opened.where("ends IS NOT NULL").select("key", "ends", "shard")
    return texts.repartition("key").sortWithinPartitions("key", "shard").mapInArrow(run, "key binary, ends_sha256 string")


def _pairs(found: list[tuple[bytes, str]]) -> pa.RecordBatch:
    keys, hashes = zip(*found)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(hashes)], names=["key", "ends_sha256"])


def _sums(opened: DataFrame, values: DataFrame) -> DataFrame:
    """key, leaves, saved of open nodes with all open nodes below them. What a node adds (values: key, owner,
    leaves, saved) is added up along its ancestors in its owner, a shard that has them all."""
    mine = opened.select("key", "parent", "depth", "shard").join(
        values.select("key", F.col("owner").alias("shard"), "leaves", "saved"), ["key", "shard"], "left"
    )

    def add_up(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: -r["depth"])
        total = {r["key"]: [r["leaves"] or 0, r["saved"] or 0] for r in rows}
        for r in rows:
            if above := total.get(r["parent"]):
                above[0] += total[r["key"]][0]
                above[1] += total[r["key"]][1]
        leaves, saved = zip(*total.values())
        return pa.table({"key": pa.array(total, pa.binary()), "leaves": leaves, "saved": saved})

    parts = mine.groupBy("shard").applyInArrow(add_up, "key binary, leaves long, saved long")
    return parts.groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _merged(opened: DataFrame, below: DataFrame | None) -> DataFrame:
    """The open nodes of a segment, each once: key, parent, depth, n, least, children, leaves, saved. ``below``
    has the sums (key, children, leaves, saved) of the trees of the next segment."""
    nodes = opened.groupBy("key").agg(
        *(f(c).alias(c) for f, names in ((F.min, ("parent", "depth", "least")), (F.sum, ("n", "children", "leaves", "saved"))) for c in names),
        F.max("size").alias("size"),
        F.min("shard").alias("owner"),
    )
    nodes = written(nodes, "open")
    more = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("children"))
    more = more.withColumns({"leaves": F.lit(0).cast("long"), "saved": F.lit(0).cast("long")})
    if below is not None:
        more = more.unionByName(below)
    more = more.groupBy("key").agg(*(F.sum(c).alias(f"more_{c}") for c in ("children", "leaves", "saved")))
    plus = lambda c: F.col(c) + F.coalesce(f"more_{c}", F.lit(0))
    nodes = nodes.join(more, "key", "left").withColumns({c: plus(c) for c in ("children", "leaves", "saved")})
    own = {
        "leaves": F.col("leaves") + F.when(F.col("children") == 0, 1).otherwise(0),
        "saved": F.col("saved") + (F.col("n") - 1) * F.col("size"),
    }
    nodes = written(nodes.withColumns(own), "values")
    return nodes.drop("leaves", "saved").join(_sums(opened, nodes), "key").select(
        "key", "parent", "depth", "n", "least", "children", "leaves", "saved"
    )


def prefix_nodes(every: DataFrame, turns: DataFrame, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node of
    the trie of the conversations ``every`` (conv_id) with ``turns`` (conv_id, place, key, size)."""
    rows = written(segments(every, turns, segment), "rows")
    last = rows.agg(F.max("segment")).first()[0] or 0
    closed, opened, below = [], [], None
    for level in range(last, -1, -1):
        pieces = written(_shards(rows.where(F.col("segment") == level), level * segment, segment, shard_turns), "nodes")
        partial = pieces.where("open")
        nodes = written(_merged(partial, below).join(_ends(partial), "key", "left"), "merged")
        closed.append(pieces.where("NOT open"))
        # The root of a later segment's tree is the node that it goes on from.
        opened.append(nodes.where("parent IS NOT NULL") if level else nodes)
        below = nodes.where("parent IS NULL").select("key", "children", "leaves", "saved")
    merged, final = reduce(DataFrame.unionByName, opened), reduce(DataFrame.unionByName, closed)
    lookup = merged.select("key", F.col("least").alias("above"))
    merged = merged.withColumn("ends", F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())))
    shown = ["least", "depth", "n", "children", "leaves", "saved", "ends"]
    waiting = merged.select(*shown, F.col("parent").alias("key")).unionByName(
        final.where("parent IS NOT NULL").select(*shown, F.col("parent").alias("key"))
    )
    # The root has no parent; a key that no node has keeps its row.
    found = lookup_join(waiting.withColumn("key", F.coalesce("key", F.lit(b""))), lookup, how="left", bound=lookup)
    known = final.where("parent IS NULL").select(*shown, F.col("parent_conv_id").alias("above"))
    return found.select(*shown, "above").unionByName(known).select(
        F.col("least").alias("conv_id"),
        "depth",
        F.col("above").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"),
    )


def conversation_trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    segment: int = SEGMENT,
    shard_turns: int = SHARD_TURNS,
) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations (see ``rebuilt`` and ``prefix_nodes``)."""
    given = {"conv_id": conv_id, "turn": turn, "role": role, "text": text}
    every, turns = rebuilt(conversations.select(*(F.col(quoted(c)).alias(n) for n, c in given.items())))
    return prefix_nodes(every, turns, segment, shard_turns)
