"""Shards by a k-d tree over document metadata.

A node that holds more than one shard is split along its widest dimension (extent relative to the
whole table's) at the weighted median, weights being bytes: a node of k shards gives floor(k/2) to its
left side, and its bytes in the same proportion. Medians come from distributed histograms: each pass
sums bytes into at most 1,024 bins per node, the driver picks the bin that holds the median, and the
next pass divides that bin, until a bin is small against a shard. Nothing but these bounded sums reaches
the driver, and nothing but the narrow metadata is read by the passes.

Every dimension is a 62-bit integer: 40 bits of the metadata's order, then 22 bits of a hash, so that
rows of one source, language or size can be told apart and a value that a third of all rows share is
split like any other. The order of a text is the rank of its whole value among all distinct ones, by a range-partitioned
sort of these; whole numbers count from the least one, in steps that make the greatest fit. The hash bits do not count
for a dimension's extent, so a node of one source is not split along the source while another dimension differs.

Defined results: a null text has no bytes; null metadata sort first; ids may be of any type, those that are no whole
numbers are ordered by a hash; a metadata column that the table lacks is no dimension; repeated rows are dealt by the
number they got when the metadata table was written; an empty table gives no rows; other columns are
left out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsieve.llm.base import quoted, written
from logsieve.operators.lookup import lookup_join

BINS = 1024
ORDER_BITS, TIE_BITS = 40, 22
# A median's bin is divided until it holds at most this share of a shard's bytes.
NEAR = 0.0005
# Rows of a shard that are numbered together, about.
SLOT_ROWS = 50_000


@dataclass
class Node:
    first: int  # shards first .. first + count - 1
    count: int
    dim: int = -1
    at: int = 0  # rows below it go left
    left: Node | None = None
    right: Node | None = None

    def leaves(self) -> list[Node]:
        return [self] if self.left is None else self.left.leaves() + self.right.leaves()

    def column(self, dims: list[str]) -> Column:
        """The first shard of the leaf in which a row lies."""
        if self.left is None:
            return F.lit(self.first)
        return F.when(F.col(dims[self.dim]) < self.at, self.left.column(dims)).otherwise(self.right.column(dims))


def ranks(narrow: DataFrame, column: str) -> DataFrame:
    """key, rank (from 1) of the distinct values of a column, in their order."""
    values = narrow.select(F.col(column).alias("key")).where("key IS NOT NULL").distinct()
    laid = values.repartitionByRange("key").sortWithinPartitions("key")
    laid = written(laid.withColumns({"part": F.spark_partition_id(), "seq": F.monotonically_increasing_id()}), "kd-values")
    parts = laid.groupBy("part").agg(F.count("*").alias("n"), F.min("seq").alias("first"))  # a row per task
    before = F.expr("coalesce(sum(n) OVER (ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")
    parts = parts.select("part", "first", before.alias("before"))
    return written(laid.join(F.broadcast(parts), "part").select("key", (F.col("before") + F.col("seq") - F.col("first") + 1).alias("rank")), "kd-ranks")


def scaled(narrow: DataFrame, column: str) -> Column:
    """A whole number from the least one on, in steps of a power of two that make the greatest fit."""
    low, high = narrow.agg(F.min(column), F.max(column)).first()
    if low is None:
        return F.lit(0).cast("long")
    shift = max(0, (high - low).bit_length() - ORDER_BITS + 1)
    return F.coalesce(F.shiftright(F.col(column), shift) - F.lit(low >> shift) + 1, F.lit(0))


def metadata(docs: DataFrame, doc_id: str, text: str, texts: list[str]) -> DataFrame:
    """The narrow table that all passes read: id, size, checksum and the dimensions d0, d1, ..."""
    data = F.coalesce(F.encode(F.col(quoted(text)), "UTF-8"), F.lit(b""))
    whole = isinstance(docs.schema[doc_id].dataType, T.IntegralType)
    key = F.col(quoted(doc_id)).cast("long") if whole else F.xxhash64(F.col(quoted(doc_id)))
    texts = [c for c in texts if c.lower() in {n.lower() for n in docs.columns}]
    narrow = docs.select(
        F.col(quoted(doc_id)).alias("doc_id"),
        key.alias("id_order"),
        (F.octet_length(data) + 8).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.monotonically_increasing_id().alias("row"),
        *(F.col(quoted(c)).cast("string").alias(f"t{i}") for i, c in enumerate(texts)),
    )
    narrow = written(narrow, "kd-rows")
    most = (1 << ORDER_BITS) - 1
    orders = [F.least("size", F.lit(most)), scaled(narrow, "id_order")]
    dims = narrow
    for i in range(len(texts)):
        rank = ranks(narrow, f"t{i}")
        dims = lookup_join(dims.withColumnRenamed(f"t{i}", "key"), rank, how="left", bound=rank)
        dims = dims.withColumn(f"r{i}", F.coalesce("rank", F.lit(0))).drop("key", "rank")
        orders.append(F.least(f"r{i}", F.lit(most)))
    tie = F.shiftleft(F.xxhash64("doc_id", "size", "text_crc32").bitwiseAND((1 << 14) - 1), TIE_BITS - 14)
    tie = tie + F.xxhash64("row").bitwiseAND((1 << (TIE_BITS - 14)) - 1)
    return written(
        dims.select(
            "doc_id",
            "size",
            "text_crc32",
            "row",
            *((F.shiftleft(o.cast("long"), TIE_BITS) + tie).alias(f"d{i}") for i, o in enumerate(orders)),
        ),
        "kd-metadata",
    )


def grow(meta: DataFrame, shards: int) -> Node:
    """The tree, by histogram passes over the metadata."""
    dims = [c for c in meta.columns if c[0] == "d" and c[1:].isdigit()]
    root, whole = Node(0, shards), None
    while any(x.count > 1 for x in root.leaves()):
        open_nodes = {x.first: x for x in root.leaves() if x.count > 1}
        at_node = meta.withColumn("node", root.column(dims)).where(F.col("node").isin(list(open_nodes)))
        extents = {
            r["node"]: r
            for r in at_node.groupBy("node")
            .agg(F.sum("size").alias("bytes"), *(f(d).alias(f"{n}_{d}") for d in dims for n, f in (("lo", F.min), ("hi", F.max))))
            .collect()
        }
        if whole is None:
            if not extents:
                return root
            whole = next(iter(extents.values()))
            whole_bytes = whole["bytes"]
        spans = {}  # node: [dimension, lowest value, highest value, bytes wanted below the split]
        for first, node in open_nodes.items():
            e = extents.get(first)
            if e is None:  # fewer rows than shards
                node.dim, node.at = 0, 0
                continue
            extent = lambda of, d: (of[f"hi_{d}"] >> TIE_BITS) - (of[f"lo_{d}"] >> TIE_BITS)
            wide = [extent(e, d) / max(1, extent(whole, d)) for d in dims]
            k = max(range(len(dims)), key=lambda i: (wide[i], -i))
            node.dim = k
            spans[first] = [k, e[f"lo_{dims[k]}"], e[f"hi_{dims[k]}"], e["bytes"] * (node.count // 2) / node.count]
        near = NEAR * whole_bytes / shards
        while spans:
            steps = {n: max(1, -(-(s[2] - s[1] + 1) // BINS)) for n, s in spans.items()}
            value, low, high, step = (
                _by_node({n: f(n, s) for n, s in spans.items()})
                for f in (lambda n, s: F.col(dims[s[0]]), lambda n, s: F.lit(s[1]), lambda n, s: F.lit(s[2]), lambda n, s: F.lit(steps[n]))
            )
            sums = (
                at_node.where(F.col("node").isin(list(spans)))
                .select("node", "size", value.alias("v"), low.alias("lo"), high.alias("hi"), step.alias("step"))
                .where("v BETWEEN lo AND hi")
                .groupBy("node", F.expr("(v - lo) DIV step").alias("bin"))
                .agg(F.sum("size").alias("bytes"))
                .collect()
            )
            for n in list(spans):
                k, lo, hi, want = spans[n]
                below = 0
                for b, weight in sorted((r["bin"], r["bytes"]) for r in sums if r["node"] == n):
                    if below + weight >= want:
                        break
                    below += weight
                start = lo + b * steps[n]
                if weight <= near or steps[n] == 1:
                    after = below + weight - want < want - below
                    open_nodes[n].at = start + steps[n] if after else start
                    del spans[n]
                else:
                    spans[n] = [k, start, start + steps[n] - 1, want - below]
        for node in open_nodes.values():
            half = node.count // 2
            node.left, node.right = Node(node.first, half), Node(node.first + half, node.count - half)
    return root


def _by_node(values: dict[int, Column]) -> Column:
    (first, value), *rest = values.items()
    column = F.when(F.col("node") == first, value)
    for n, v in rest:
        column = column.when(F.col("node") == n, v)
    return column


def kd_shards(
    docs: DataFrame,
    shards: int = 24,
    doc_id: str = "doc_id",
    text: str = "text",
    texts: tuple[str, ...] = ("source", "lang"),
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot: the row's place in its shard, from 0 without gaps.

    Rows are numbered in groups by a hash of their number in the metadata table; a group's first slot
    is the sum of those before it, so no task sees a whole shard."""
    meta = metadata(docs, doc_id, text, list(texts))
    tree = grow(meta, shards)
    dims = [c for c in meta.columns if c[0] == "d" and c[1:].isdigit()]
    groups = max(1, meta.count() // (shards * SLOT_ROWS) + 1)
    placed = meta.select(
        "doc_id",
        "size",
        "text_crc32",
        "row",
        tree.column(dims).cast("int").alias("shard"),
        F.pmod(F.xxhash64("row"), F.lit(groups)).alias("part"),
    )
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    place = Window.partitionBy("shard", "part").orderBy("doc_id", "row")
    return (
        placed.withColumn("place", F.row_number().over(place) - 1)
        .join(offsets, ["shard", "part"])
        .select("doc_id", "size", "text_crc32", "shard", (F.col("base") + F.col("place")).cast("long").alias("slot"))
    )
