import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from logsieve.llm import brown
from logsieve.llm.brown import score_texts


def split(text):
    return (text or "").encode().lower().split() + [b""]


def held(doc_id):
    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % 7 == 2


def base(rows):
    counts = Counter(w for d, t in rows if not held(d) for w in split(t))
    n, v = sum(counts.values()), len(counts)
    return [(d, held(d), len(split(t)), sum(counts[w] > 0 for w in split(t)), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in split(t))) for d, t in rows]


def corpus():
    """Two kinds of words in turn: the classes can be told from the neighbours alone."""
    r = random.Random(2)
    a, b = [f"a{i}" for i in range(40)], [f"b{i}" for i in range(40)]
    rows = []
    for i in range(700):
        words = [r.choice(a if k % 2 else b) for k in range(r.randrange(2, 40))] + [r.choice(["RARE", "Ünï"]) + str(r.randrange(400))] * r.randrange(2)
        rows.append((i, r.choice([" ", "\n\t"]).join(words)))
    return rows + [(9001, None), (9002, ""), (None, "a1 b1"), (None, "a1 b1"), (9003, "w" * 3000 + " a1"), (9004, "a2 " * 60_000)]


@pytest.mark.parametrize("known", [131_072, 30])
def test_base_and_score(spark, monkeypatch, known):
    monkeypatch.setattr(brown, "KNOWN", known)
    rows = corpus()
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double")
    got = {}
    for r in score_texts(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    for d, h, n, k, total, value in base(rows):
        for r in got[d]:
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, n, k, total)
            assert abs(r.base_score - value) < 1e-6 * max(1, abs(value))
    unseen = [r for d, rs in got.items() for r in rs if r.held_out and d is not None and d < 9000]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
    assert len(got[None]) == 2


def test_it_is_a_distribution(spark, monkeypatch):
    """Probabilities of all next tokens sum to one: texts of one word, and the unknown word's share."""
    rows = corpus()[:300]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    vocabulary = sorted({w.decode() for d, t in rows if not held(d) for w in split(t)} - {""})
    probes = [(i, w) for i, w in zip((i for i in range(10_000, 99_999) if held(i)), vocabulary)]
    empty = next(i for i in range(100_000, 200_000) if held(i))
    unknown = [(i, f"zz{i}") for i in range(200_000, 201_500) if held(i)]
    got = {r.doc_id: r.score for r in score_texts(docs.union(spark.createDataFrame([*probes, (empty, ""), *unknown], "doc_id long, text string"))).collect()}
    # A text of one word is that word and the end, so words of one class share the end's factor: sum the first factor only.
    assert 0 < 10 ** got[empty] < 1
    assert sum(10 ** got[i] for i, _ in probes) < 1


def test_exchange_finds_the_classes(spark):
    """Words of two kinds in turn: no class holds both, and rounds never lose information."""
    r = random.Random(7)
    names = list(range(400))
    r.shuffle(names)
    ids = [x for _ in range(1500) for x in (*(names[r.randrange(200) * 2 + k % 2] for k in range(60)), brown.END)]
    symbols = spark.createDataFrame([(bytearray(np.array(ids, dtype=np.uint16).tobytes()),)], "symbols binary")
    classes, pairs = brown.exchange(symbols, 400)
    kinds = [Counter(int(classes[names[i]]) for i in range(k, 400, 2)) for k in (0, 1)]
    mixed = sum(min(kinds[0][c], kinds[1][c]) for c in range(brown.CLASSES))
    assert mixed <= 0.03 * 400
    start = np.zeros_like(pairs)
    first = np.concatenate([np.arange(brown.FREQUENT) % brown.CLASSES, np.arange(brown.CLASSES, brown.ALL_CLASSES)])
    np.add.at(start, (first[[brown.END, *ids[:-1]]], first[ids]), 1)
    assert brown.information(pairs) > brown.information(start) + 0.5 * len(ids) * math.log(2)
    assert pairs.sum() == len(ids)


def test_empty(spark):
    assert score_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = next(i for i in range(100) if held(i))
    (row,) = score_texts(spark.createDataFrame([(one, "a b")], "doc_id long, text string")).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)


def kinds_in_turn(n_rare):
    """Frequent words of two kinds in turn, and rare ones (some of over 64 bytes) that stand for either kind."""
    r = random.Random(3)
    kinds = [[f"{k}{i}" for i in range(15)] for k in "ab"]
    rare = [[f"{k}rare{i}" + "x" * (100 * (i % 5 == 0)) for i in range(n_rare)] for k in "ab"]
    rows = []
    for i in range(5000):
        words = [r.choice(kinds[k % 2]) for k in range(20)]
        for k in (3, 6, 13, 16):
            words[k] = rare[k % 2][(2 * i + k // 10) % n_rare]
        rows.append((i, " ".join(words)))
    return rows


@pytest.mark.parametrize("known, n_rare", [(30, 100), (131_072, 7000)])
def test_words_beyond_the_rounds_have_learned_classes(spark, monkeypatch, known, n_rare):
    """A rare word is likelier where its kind stands, whether its count is broadcast or joined."""
    monkeypatch.setattr(brown, "KNOWN", known)
    rows = kinds_in_turn(n_rare)
    counts = Counter(w for d, t in rows if not held(d) for w in t.split())
    order = sorted(counts, key=lambda w: (len(w) > brown.KNOWN_BYTES, -counts[w], w))
    rare = order[min(known, brown.FREQUENT) :]
    rare = rare[:: 1 + len(rare) // 400]
    assert any(len(w) > brown.KNOWN_BYTES for w in rare) and any(len(w) <= brown.KNOWN_BYTES for w in rare)
    ids = (i for i in range(10_000, 9_999_999) if held(i))
    texts = {}
    for w in rare:
        for fits in (True, False):
            k = "ab"[(w[0] == "a") == fits]
            texts[next(ids)] = (w, fits, f"{k}1 {w} {k}2")
    docs = spark.createDataFrame([*rows, *((i, t) for i, (_, _, t) in texts.items())], "doc_id long, text string")
    score = {texts[r.doc_id][:2]: r.score for r in score_texts(docs).where("doc_id >= 10000").collect()}
    better = [score[w, True] > score[w, False] + 0.3 for w in rare]
    assert sum(better) >= 0.97 * len(rare)


def test_best_classes_are_those_of_brute_force(monkeypatch):
    monkeypatch.setattr(brown, "CONTEXTS", 50)
    r = np.random.default_rng(4)
    pairs = r.integers(0, 500, (brown.ALL_CLASSES, brown.ALL_CLASSES))
    lengths = [1, 1, 2, 3, 7, 40, 20_000, 1, 5]
    sides = r.integers(0, brown.ALL_CLASSES**2, sum(lengths)).astype(np.uint16)
    n, best = brown.best_classes(np.repeat(np.arange(len(lengths)), lengths), sides, pairs)
    assert n.tolist() == lengths
    more = lambda x, n: (x + n) * math.log(x + n) - (x * math.log(x) if x else 0)
    others = range(brown.CLASSES, brown.ALL_CLASSES - 1)
    for i, end in enumerate(np.cumsum(lengths)):
        around = [divmod(s, brown.ALL_CLASSES) for s in sides[end - lengths[i] : end].tolist()]
        before, after = (Counter(x) for x in zip(*around))
        gains = []
        for c in range(brown.CLASSES):
            gain = sum(more(pairs[b, c] + sum(pairs[b, o] for o in others) / brown.CLASSES, n) for b, n in before.items())
            gain += sum(more(pairs[c, a] + sum(pairs[o, a] for o in others) / brown.CLASSES, n) for a, n in after.items())
            gain -= more(pairs[:, c].sum() + sum(pairs[:, o].sum() for o in others) / brown.CLASSES, len(around))
            gain -= more(pairs[c].sum() + sum(pairs[o].sum() for o in others) / brown.CLASSES, len(around))
            gains.append(gain)
        assert gains[best[i]] >= max(gains) - 1e-6


def test_place_joins_a_word_over_batches(spark, monkeypatch):
    """A word's contexts from many tasks are one word, also where an Arrow batch ends inside it."""
    monkeypatch.setattr(brown, "CONTEXTS", 4)
    rows = [(f"w{i % 7}".encode(), np.array([i % 7 * 82] * (1 + i % 3), dtype=np.uint16).tobytes()) for i in range(210)]
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        pairs = np.diag(np.full(brown.ALL_CLASSES, 1000))
        got = brown.place(spark.createDataFrame(rows, "word binary, sides binary").repartition(5), pairs).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert sorted((bytes(r.word), r.n, r["class"]) for r in got) == [(f"w{i}".encode(), 60, i) for i in range(7)]


def test_classes_of_words_met_are_a_distribution(spark, monkeypatch):
    """Texts of one word, with as many unknown words as were met once and one more by checksum: less than one in all."""
    monkeypatch.setattr(brown, "KNOWN", 40)
    rows = [(d, t) for d, t in corpus()[:300]]
    words = Counter(w for d, t in rows if not held(d) for w in split(t) if w)
    ids = (i for i in range(10_000, 999_999) if held(i))
    probes = {next(ids): w.decode() for w in words}
    new = {c: next(f"zz{i}" for i in range(9999) if zlib.crc32(f"zz{i}".encode()) % 16 == c) for c in range(16)}
    once = Counter(zlib.crc32(w) % 16 for w, n in words.items() if n == 1)
    unknown = {next(ids): c for c in new}
    texts = [*probes.items(), *((i, new[c]) for i, c in unknown.items())]
    table = spark.createDataFrame([*rows, *texts], "doc_id long, text string")
    score = {r.doc_id: r.score for r in score_texts(table).where("doc_id >= 10000").collect()}
    total = sum(10 ** score[i] for i in probes) + sum(10 ** score[i] * (once[c] + 1) for i, c in unknown.items())
    assert 0 < total < 1
