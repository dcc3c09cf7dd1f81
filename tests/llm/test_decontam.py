import random
import re

import numpy as np
from pyspark.sql import functions as F

from logsieve.llm.decontam import Block, find_contamination, without_spans, words
from logsieve.llm.fmindex import FMIndex, suffix_array


def test_suffix_array_and_search():
    r = random.Random(3)
    for _ in range(60):
        text = np.array([r.randrange(1, 5) for _ in range(r.randrange(1, 60))] * r.choice([1, 1, 4]))
        whole = [*text.tolist(), 0]
        assert suffix_array(np.array(whole)).tolist() == sorted(range(len(whole)), key=lambda i: whole[i:])
        index = FMIndex(text, 5)
        patterns = [tuple(r.randrange(1, 5) for _ in range(r.randrange(1, 6))) for _ in range(20)]
        padded = np.zeros((20, 5), dtype=np.int64)
        for i, p in enumerate(patterns):
            padded[i, : len(p)] = p
        low, high = index.search(padded, np.array([len(p) for p in patterns]))
        for p, a, b in zip(patterns, low, high):
            want = [i for i in range(len(text)) if tuple(text[i : i + len(p)]) == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def brute(docs, items, n=10):
    """Per document: words, hit words, items."""
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    cut = lambda t: word.findall("".join(c.lower() if c < "\x80" else c for c in t or ""))
    out = []
    for text in docs:
        own, hit, met = cut(text), set(), set()
        for item, t in items:
            w = cut(t)
            for at in range(max(1, len(w) - n + 1) if w else 0):
                window = w[at : at + n]
                for i in range(len(own) - len(window) + 1):
                    if own[i : i + len(window)] == window:
                        hit.update(range(i, i + len(window)))
                        if item is not None:
                            met.add(item)
        out.append((len(own), len(hit), sorted(met)))
    return out


def fixture():
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)] + ["Ünder", "AÉ", "x9"]
    item = lambda n: "-".join(r.choice(vocabulary) for _ in range(n))
    items = [(10 - i, item(r.choice([3, 9, 10, 11, 25]))) for i in range(9)]
    items += [(None, item(12)), (20, None), (21, " .,"), (items[0][0], items[0][1])]
    docs = [None, "", "?!", " \n".join(f"q{i}" for i in range(50))]
    for _ in range(60):
        parts = [item(r.randrange(6)) for _ in range(3)] + [r.choice(items)[1] or "" for _ in range(2)]
        r.shuffle(parts)
        docs.append(r.choice([" ", "\n", " other "]).join(parts).upper())
    docs += [docs[-1]] * 5 + ["z " * 30_000 + items[4][1] + " z" * 1000]
    return docs, items


def test_against_brute_force(spark):
    docs, items = fixture()
    frame = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)], "doc_id long, text string, Items string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = find_contamination(frame, bench)
    assert out.columns == ["doc_id", "text", "n_words", "n_hit", "items", "spans"]
    got = {r.doc_id: r for r in out.withColumn("rest", without_spans("text", "spans")).collect()}
    for i, want in enumerate(brute(docs, items)):
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == want, docs[i]
        text, kept, end = docs[i] or "", "", 0
        inside = sum(len(words(text[a:b].encode())) for a, b in got[i].spans)
        assert inside == want[1]
        for a, b in got[i].spans:
            assert a >= end
            kept, end = kept + text[end:a], b
        assert docs[i] is None or got[i].rest == kept + text[end:]


def test_blocks_are_merged(spark, monkeypatch):
    from logsieve.llm import decontam

    monkeypatch.setattr(decontam, "BLOCK_WORDS", 30)
    docs, items = fixture()
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, text string")
    got = {r.doc_id: r for r in find_contamination(frame, spark.createDataFrame(items, "item_id long, text string")).collect()}
    for i, want in enumerate(brute(docs, items)):
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == want


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert find_contamination(docs, bench).select("n_words", "n_hit").collect() == [(2, 0)]
    assert find_contamination(docs.limit(0), bench).count() == 0
    assert Block([], 10).search([[b"a"]])[0].size == 0


def test_on_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs, bench = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    got = find_contamination(docs, bench).agg(F.sum("n_hit"), F.sum(F.size("items"))).first()
    assert got[0] > 0 and got[1] > 0
