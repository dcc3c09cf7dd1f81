import zlib

import pytest
from pyspark.sql import functions as F

from logsieve.llm.kdshards import grow, kd_shards, metadata

SF = "/root/testdata/sf0.01"


def check(rows, docs, shards):
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in rows), key=str) == sorted(
        ((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in docs), key=str
    )
    slots = {}
    for r in rows:
        assert 0 <= r.shard < shards
        slots.setdefault(r.shard, []).append(r.slot)
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))


def test_near_equal_bytes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = kd_shards(docs, 24).collect()
    check(rows, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 24)
    sizes = [0] * 24
    for r in rows:
        sizes[r.shard] += r.size
    largest = max(r.size for r in rows)
    assert max(sizes) - min(sizes) <= 2 * largest
    again = {(r.doc_id, r.shard) for r in kd_shards(docs.repartition(3), 24).collect()}
    same = len(again & {(r.doc_id, r.shard) for r in rows})
    assert same > 0.95 * len(rows)


def test_a_hot_value_is_split(spark):
    docs = spark.range(20_000).selectExpr("id doc_id", "'same text' text", "'hot' source", "'en' lang")
    counts = [r["count"] for r in kd_shards(docs, 24).groupBy("shard").count().collect()]
    assert len(counts) == 24 and max(counts) <= 1.05 * min(counts)
    alike = spark.range(20_000).selectExpr("7L doc_id", "'same text' text", "'hot' source", "'en' lang")
    counts = [r["count"] for r in kd_shards(alike, 24).groupBy("shard").count().collect()]
    assert max(counts) <= 20_000 / 24 * 8


def test_medians_are_weighted(spark):
    docs = spark.range(3000).selectExpr("id doc_id", "repeat('a', int(id)) text", "cast(null as string) source", "'en' lang")
    meta = metadata(docs, "doc_id", "text", ["source", "lang"])
    tree = grow(meta, 2)
    below = meta.where(F.col(f"d{tree.dim}") < tree.at).agg(F.sum("size")).first()[0]
    assert abs(below / meta.agg(F.sum("size")).first()[0] - 0.5) < 0.002


@pytest.mark.parametrize("rows", [[], [(1, "a", "s", None)], [(None, None, None, None)] * 3 + [(2, "", "s", "é"), (2, "x" * 500_000, "s", "é")]])
def test_small_tables(spark, rows):
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, lang string, D0 int")
    got = kd_shards(docs, 24).collect()
    check(got, [(r[0], r[1]) for r in rows], 24)


def nodes(tree):
    yield tree
    if tree.left is not None:
        yield from nodes(tree.left)
        yield from nodes(tree.right)


def brute_split(rows, node, dims, whole):
    """The rows of each leaf, and for every split its dimension, what lies below it and what it wanted."""
    if node.left is None:
        return
    extent = lambda rs, d: (max(r[d] for r in rs) >> 22) - (min(r[d] for r in rs) >> 22)
    wide = [extent(rows, d) / max(1, extent(whole, d)) for d in dims]
    assert node.dim == max(range(len(dims)), key=lambda i: (wide[i], -i))
    total, want = sum(r["size"] for r in rows), None
    want = total * (node.count // 2) / node.count
    d = dims[node.dim]
    below = [r for r in rows if r[d] < node.at]
    # The weighted median by sorting: the split after the row with which the sum comes nearest to what is wanted.
    best, run = want, 0
    for r in sorted(rows, key=lambda r: r[d]):
        run += r["size"]
        best = min(best, abs(run - want))
    tolerance = 0.0005 * sum(r["size"] for r in whole) / 24 + 1
    assert abs(sum(r["size"] for r in below) - want) <= best + tolerance
    brute_split(below, node.left, dims, whole)
    brute_split([r for r in rows if r[d] >= node.at], node.right, dims, whole)


def test_medians_by_sorting(spark):
    meta = metadata(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id", "text", ["source", "lang"])
    rows = [r.asDict() for r in meta.collect()]
    brute_split(rows, grow(meta, 24), ["d0", "d1", "d2", "d3"], rows)


def test_sources_with_a_common_beginning(spark):
    """Values are ordered whole, and what one node's rows share is not what it is split along."""
    docs = spark.range(4000).selectExpr("id doc_id", "repeat('a', int(id % 37)) text", "concat('source-0', id % 7) source", "'en' lang")
    meta = metadata(docs, "doc_id", "text", ["source", "lang"])
    tree = grow(meta, 24)
    rows = meta.join(docs.select("doc_id", "source"), "doc_id").collect()
    order = {r.source: r.d2 >> 22 for r in rows}
    assert [order[s] for s in sorted(order)] == list(range(1, 8)) and {r.d3 >> 22 for r in rows} == {1}
    assert any(n.dim == 2 for n in nodes(tree))

    def walk(node, own):
        if node.left is None:
            return
        assert len({r[f"d{node.dim}"] >> 22 for r in own}) > 1
        walk(node.left, [r for r in own if r[f"d{node.dim}"] < node.at])
        walk(node.right, [r for r in own if r[f"d{node.dim}"] >= node.at])

    walk(tree, rows)


def test_ids_of_any_kind(spark):
    wide = [(i, "x" * (i % 50)) for i in (-(2**63), -5, -1, 0, 1, 2**40, 2**62, 2**63 - 1)] + [(None, None)]
    docs = spark.createDataFrame(wide * 30, "doc_id long, text string")
    check(kd_shards(docs, 24).collect(), wide * 30, 24)
    meta = metadata(docs, "doc_id", "text", ["source", "lang"])
    assert [c for c in meta.columns if c.startswith("d") and c[1:].isdigit()] == ["d0", "d1"]
    ids = {r.doc_id: r.d1 >> 22 for r in meta.collect()}
    assert ids[-(2**63)] == 1 and ids[-1] <= ids[0] < ids[2**62] < ids[2**63 - 1] and ids[None] == 0
    named = [(f"n{i}", "y" * i) for i in range(100)] + [(None, "z")]
    check(kd_shards(spark.createDataFrame(named, "doc_id string, text string"), 24).collect(), named, 24)
