import re

import pytest

import corpus_pipeline
from tests.llm.test_decontam import brute as brute_windows
from tests.llm.test_hyperminhash import brute as brute_near
from tests.llm.test_pii import brute as brute_pii

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage was given and gave, on the whole tables."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        given = docs
        docs = corpus_pipeline.written(stage(spark, docs, SF), "test")
        out.append((given.collect(), docs.collect(), given.columns, docs.columns))
    return out


def test_quality(stages):
    given, gave, names, kept_names = stages[0]
    assert names == kept_names
    texts = {r.doc_id: r.text for r in given}
    assert 0 < len(gave) < len(given)
    for r in gave:
        lines = texts[r.doc_id].split("\n")
        assert r.text == texts[r.doc_id] or all(x in lines for x in r.text.split("\n"))
        assert r.n_chars == len(r.text)


def test_near_duplicates(stages):
    given, gave, names, kept_names = stages[1]
    assert names == kept_names
    want = {c for _, _, c in brute_near([(r.doc_id, r.text) for r in given], percent=80)}
    assert sorted(r.doc_id for r in gave) == sorted(want)
    assert {tuple(r) for r in gave} <= {tuple(r) for r in given}


def test_decontamination(spark, stages):
    given, gave, names, kept_names = stages[2]
    assert names == kept_names
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = dict(zip((r.doc_id for r in given), brute_windows([r.text for r in given], items)))
    texts = {r.doc_id: r.text for r in given}
    left = {r.doc_id: r for r in gave}
    for d, (n, n_hit, _) in hits.items():
        if not n_hit:
            assert left[d].text == texts[d]
        elif n_hit == n:
            assert d not in left
        else:
            (now,) = brute_windows([left[d].text], [])
            assert now[0] == n - n_hit and left[d].n_chars == len(left[d].text)
    assert any(h[1] for h in hits.values())


def test_personal_data(stages):
    given, gave, names, kept_names = stages[3]
    assert names == kept_names and len(given) == len(gave)
    texts = {r.doc_id: r.text for r in given}
    touched = 0
    for r in gave:
        found = brute_pii(texts[r.doc_id])
        touched += bool(found)
        for _, a, b in found:
            assert texts[r.doc_id][a:b] not in r.text
        if not found:
            assert r.text == texts[r.doc_id]
    assert touched and any(re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", r.text) for r in gave)


def test_tokens(stages):
    import public_tokenizers
    import tiktoken

    given, gave, _, _ = stages[4]
    ranks, pattern = corpus_pipeline.vocabulary()
    exact = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in given}
    assert len(gave) == len(given)
    for r in gave:
        assert r.ids == exact.encode_ordinary(texts[r.doc_id]) and r.n_tokens == len(r.ids) and r.round_trip


def test_odd_rows(spark):
    """Every stage takes nulls, repeats, empty and long texts, and an empty table."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a b c", "en", "s", 5), (None, "a b c", "en", "s", 5)]
    rows += [(4, "It was, they said, the best of days. " * 1 + "x" * 300_000 + " y.", "en", None, 7)] * 2
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= n
            if name != "byte_bpe":
                assert out.columns == docs.columns
        assert corpus_pipeline.near_duplicates(spark, docs, SF).count() == (4 if n else 0)


def test_near_copies_below_the_threshold_of_op10(spark):
    """Of sets of similarity 0.82 the stage keeps one."""
    words = [f"w{i}" for i in range(304)]
    other = words[:-30] + [f"v{i}" for i in range(30)]
    third = words[:-40] + [f"u{i}" for i in range(40)]
    rows = [(1, " ".join(words), "en", "s", 0), (2, " ".join(other), "en", "s", 0), (3, " ".join(third), "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()) == [1, 3]
