import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest

from logsieve.llm import prefixtrie
from logsieve.llm.prefixtrie import TernaryTree, conversation_trie, medians

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            convs[c].append((t is not None, t or 0, digest, (role, text)))
    own = {c: [v[3] for v in sorted(t)] for c, t in convs.items()}
    nodes, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        turns = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
        ends[turns].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    for p, m in nodes.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
            leaves[p[:d]] += not kids[p]
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return sorted(
        (m[0], len(p), nodes[p[:-1]][0] if p else -(10**9), len(m), kids[p], leaves[p], saved[p], sha(ends.get(p, [])))
        for p, m in nodes.items()
    )


def trie(df, **options):
    rows = conversation_trie(df, **options).collect()
    return sorted(tuple(-(10**9) if n == "parent_conv_id" and r[n] is None else r[n] for n in NAMES) for r in rows)


SCHEMA = "conv_id long, turn int, role string, text string, key string, prefix int"


def table(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(parts)


def test_tree():
    r = random.Random(1)
    sequences = sorted({tuple(r.randrange(6) for _ in range(r.randrange(5))) for _ in range(300)})
    tree = TernaryTree()
    at = {sequences[m]: tree.insert(list(sequences[m])) for m in medians(len(sequences))}
    assert set(at) == set(sequences)
    prefixes = {s[:d] for s in sequences for d in range(len(s) + 1)}
    assert len(tree.code) == len(prefixes)
    seen = set()
    for node in tree.deepest_first():
        assert all(c in seen for c in tree.children(node))
        seen.add(node)
    assert len(seen) == len(prefixes)
    for s, node in at.items():
        path = []
        while node:
            path.append(tree.code[node])
            node = tree.parent[node]
        assert tuple(path[::-1]) == s
    # Medians first: the search tree of the root's children is not deeper than it has to be.
    wide, order = TernaryTree(), list(medians(1000))
    assert sorted(order) == list(range(1000))
    for m in order:
        wide.insert([m])
    depth, level = 0, [wide.below[0]]
    while level:
        depth, level = depth + 1, [x for n in level for x in (wide.low[n], wide.high[n]) if x]
    assert depth == 10


def rows_with_shared_turns(r, n):
    rows = []
    for c in range(n):
        for t in range(r.randrange(1, 12)):
            text = "hello" if t == 0 and c % 3 == 0 else r.choice("abc") * r.randrange(1, 3)
            rows.append((c, t, r.choice(["user", "user", "assistant"]), text))
    return rows


@pytest.mark.parametrize("segment, shard_turns", [(4096, 100_000), (4, 40), (5, 1)])
def test_shards_and_segments(spark, segment, shard_turns):
    rows = rows_with_shared_turns(random.Random(segment), 120)
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1150) for t in range(4)]  # one conversation very often
    long = min(200, 6 * segment + 2)  # of several segments, each of which is a round of jobs
    rows += [(2001, t, "user", "x" * (t % 5)) for t in range(long)]
    rows += [(2002, t, "user", "x" * (t % 5)) for t in range(long - 2)]
    assert trie(table(spark, rows), segment=segment, shard_turns=shard_turns) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", ""), (2, 0, None, "é" * 3), (2, 0, "user", "b"), (2, 0, "user", "b"), (2, None, "u", "c")]
    rows += [(None, 0, "user", "lost"), (-3, 1, "user", "a"), (-5, 1, "user", "a"), (-7, 2, "x", None), (10, 0, "a", "long " * 300_000)]
    rows += [(11, t, "a", "turn") for t in range(3)] + [(57, 0, "only", "one")]
    assert trie(table(spark, rows)) == brute(rows)
    assert trie(table(spark, rows, 1).withColumnRenamed("text", "a b.c"), text="a b.c") == brute(rows)
    assert conversation_trie(table(spark, rows).where("false")).count() == 0


def test_whole_table_with_small_shards(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(x) for x in df.select("conv_id", "turn", "role", "text").collect()]
    assert trie(df, shard_turns=30) == brute(rows)
    assert prefixtrie.SEGMENT >= 4096
