import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from logsieve.llm.components import components
from logsieve.llm.hyperminhash import drop_near_duplicates, estimate, near_duplicates, registers
from logsieve.llm.shingles import shingle_sets

WORD = re.compile("[^\x20\x09-\x0d]+")


def shingles(text, n=5):
    w = WORD.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute(rows, percent=85):
    """(id, n, component) by all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(s), least.get(find(i), d)) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def family(r, words, n, edits):
    base = [r.choice(words) for _ in range(n)]
    out = [" ".join(base)]
    for _ in range(edits):
        own = list(base)
        for _ in range(max(1, n // 70)):
            own[r.randrange(n)] = r.choice(words)
        out.append(r.choice([" ", "\n", "\t "]).join(own))
    return out


def corpus(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)] + ["Ä", "é", "ÉT", "ÜB"]
    texts = [None, "", " \n", "a", "A", "a b", "a b c d e f g h i j", "A b C d e f g h i j k", "a b c d e f g h i j k l m"]
    for n in (12, 40, 150, 300, 900):
        texts += family(r, words, n, 12)
    chain = [r.choice(words) for _ in range(200)]
    for i in range(12):  # each like the one before it only
        texts.append(" ".join(chain))
        chain[i * 15 : i * 15 + 8] = [r.choice(words) for _ in range(8)]
    texts += [" ".join(r.choice(words) for _ in range(r.randrange(3, 200))) for _ in range(60)]
    texts += [texts[20]] * 9
    r.shuffle(texts)
    return [(i * 7 + 3, t) for i, t in enumerate(texts)] + [(None, texts[5]), (None, "only null here"), (None, "only null here"), (3, texts[0])]


def test_shingle_sets_match():
    for rows in (corpus(1),):
        texts = [t or "" for _, t in rows]
        sets = shingle_sets([t.encode() for t in texts], 5)
        assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
        for i in range(0, len(texts), 7):
            for j in range(0, len(texts), 5):
                both = len(np.intersect1d(sets[i], sets[j]))
                assert both == len(shingles(texts[i]) & shingles(texts[j]))


def test_estimates():
    r = np.random.RandomState(1)
    for n in (50, 1000, 20_000):
        for share in (0.5, 0.85, 0.95):
            errors = []
            for _ in range(20):
                every = r.randint(0, 1 << 62, n, dtype=np.int64).astype(np.uint64) * np.uint64(3)
                both = int(n * share)
                a, b = every[: both + (n - both) // 2], np.r_[every[:both], every[both + (n - both) // 2 :]]
                e, error = estimate(registers(np.unique(a)), registers(np.unique(b)), len(a), len(b))
                errors.append(e - share)
                assert abs(e - share) < 6 * error
            assert abs(np.mean(errors)) < 0.05


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, component_id string").repartition(5)
    got = near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    kept = left.collect()
    wordless = [d for d, t in rows if not shingles(t)]
    want = {c for d, n, c in brute(rows) if n and c is not None}
    assert sorted(r.doc_id for r in kept if shingles(r.text) and r.doc_id is not None) == sorted(want)
    assert len([r for r in kept if not shingles(r.text)]) == len(wordless)
    assert len([r for r in kept if r.doc_id is None and shingles(r.text)]) == 1


def test_ids_of_any_type_and_long_texts(spark):
    """String ids, clashing and nested columns, a text of a million words, blocks bounded by bytes."""
    long = " ".join(f"w{i % 9973}x{i}" for i in range(1_000_000))
    rows = [("b", long, "k", "m"), ("a", long + " end", "k", "m"), ("c", "one two", None, None), ("c", "one two", None, None), (None, "", "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id string, text string, key string, mark string").withColumn("row", F.struct("key"))
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_duplicates(docs).collect()), key=str)
    assert got == sorted([("a", "a", True), ("b", "a", False), ("c", "c", True), ("c", "c", True), (None, None, True)], key=str)
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns and sorted((r.doc_id or "" for r in left.collect())) == ["", "a", "c"]


def test_blocks_by_bytes(spark, monkeypatch):
    from logsieve.llm import hyperminhash

    monkeypatch.setattr(hyperminhash, "BLOCK_BYTES", 5_000)
    r = random.Random(13)
    words = [f"w{i}" for i in range(500)]
    rows = list(enumerate(family(r, words, 200, 60)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs).collect()
    assert sorted(((x.doc_id, x.n_shingles, x.component_id) for x in got), key=str) == brute(rows)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).count() == 0 and drop_near_duplicates(docs).count() == 0


def test_components(spark):
    r = random.Random(4)
    edges = [(i, i + 1) for i in range(0, 300)] + [(500, x) for x in range(600, 700)] + [(r.randrange(1000, 1200), r.randrange(1000, 1200)) for _ in range(120)]
    got = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    assert got == root


def test_common_elements():
    from logsieve.llm import hyperminhash

    r = np.random.RandomState(3)
    sets = [np.unique(r.randint(0, 400, r.randint(0, 200)).astype(np.uint64)) for _ in range(30)]
    left, right = np.arange(0, 12), np.arange(8, 30)
    hyperminhash.COLUMNS, kept = 37, hyperminhash.COLUMNS
    got = hyperminhash.common(sets, left, right)
    hyperminhash.COLUMNS = kept
    assert got.tolist() == [[len(np.intersect1d(sets[x], sets[y])) for y in right] for x in left]


def test_a_loose_family(spark, monkeypatch):
    """Copies that are linked with few of the others, in more than one block."""
    from logsieve.llm import hyperminhash

    monkeypatch.setattr(hyperminhash, "BLOCK", 20)
    r = random.Random(11)
    words = [f"w{i}" for i in range(500)]
    rows = list(enumerate(t for n, m in ((60, 50), (90, 40)) for t in family(r, words, n * 3, m)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs).collect()
    assert sorted(((x.doc_id, x.n_shingles, x.component_id) for x in got), key=str) == brute(rows)


@pytest.mark.parametrize("percent", [1, 5, 20, 50, 70, 80, 85, 90, 99])
def test_bands_follow_the_threshold(percent):
    from logsieve.llm.hyperminhash import layout

    count, rows = layout(percent)
    assert (1 - (percent / 100) ** rows) ** count < 1e-6
    assert count * rows <= max(192, 14 / (percent / 100) + 1)


def test_pairs_of_half_the_words(spark):
    """Pairs just over a low threshold, most of which share no band of six registers."""
    r = random.Random(12)
    rows = []
    for i in range(40):
        words = [f"w{i}x{k}" for k in range(304)]
        own = words[:-95] + [f"v{i}x{r.randrange(10**6)}" for _ in range(95)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(own))]
    assert all(0.5 <= len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) < 0.53 for (_, a), (_, b) in zip(rows[::2], rows[1::2]))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), percent=50).collect()
    assert sorted((x.doc_id, x.component_id) for x in got) == [(d, d - d % 2) for d, _ in rows]
