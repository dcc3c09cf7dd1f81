import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from logsieve.llm import negatives
from logsieve.llm.negatives import Shard, Window, hard_negatives, matrix, threshold_search


def brute(rows, positives=5, negatives=3, every=50, low=50, high=95):
    whole = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        parts = [math.floor(256 * x) for x in v]
        whole[i] = min(whole.get(i, (label, parts)), (label, parts))
    out = []
    for a, (label, q) in whole.items():
        if a % every:
            continue
        score = {b: sum(x * y for x, y in zip(q, v)) for b, (_, v) in whole.items() if b != a}
        best = sorted(score, key=lambda b: (-score[b], b))
        for p in [b for b in best if whole[b][0] == label][:positives]:
            s = score[p]
            found = [b for b in best if whole[b][0] != label and low * s <= 100 * score[b] <= high * s]
            out += [(a, p, r, b, s, score[b]) for r, b in enumerate(found[:negatives], 1)]
    return sorted(out)


def mined(df):
    found = hard_negatives(df, F.col("vec_id"), F.col("label"), F.col("embedding"), F.col("id") % 50 == 0)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r[n] for n in names) for r in found.collect())


SCHEMA = "vec_id long, label int, embedding array<double>, rank string, shard int"


def test_ties_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SHARD_ROWS", 60)
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 200)
    r = random.Random(2)
    rows = [(i, r.choice([0, 0, 0, 1, 2]), [r.choice([-0.5, 0.0, 0.25, 0.5, 0.7]) for _ in range(4)]) for i in range(300)]
    rows += [(i, 1, [0.5, 0.5, 0.0, 0.25]) for i in range(300, 460)]  # one vector very often
    rows += [(500, None, [0.5] * 4), (501, 1, None), (502, 1, [0.5, None]), (503, 1, [float("nan")] * 4), (504, 0, [float("inf")] * 4)]
    rows += [(505, 1, [0.5]), (506, 0, []), (None, 0, [0.5] * 4), (550, 0, [0.0] * 4), (600, 1, [0.25, 0.5, 0.5, 0.5, 0.5, 0.5])]
    rows += [(-50, 2, [-0.5, -0.5, -0.25, -0.5]), *rows[:5], (7, 2, [0.1] * 4)]
    df = spark.createDataFrame([(*x, "x", 1) for x in rows], SCHEMA)
    want = brute(rows)
    assert len(want) > 50 and mined(df) == want
    assert mined(df.where("false")) == [] and mined(df.where("vec_id % 50 <> 0")) == []


@pytest.mark.parametrize("scale", [300.0, 3e6, 3e15])
def test_large_components_are_exact(spark, scale):
    r = random.Random(4)
    rows = [(i, i % 2, [scale * r.uniform(-1, 1) * (1 if i % 9 else 1e-3) for _ in range(3)]) for i in range(120)]
    if scale < 1e9:
        assert mined(spark.createDataFrame([(*x, "x", 1) for x in rows], SCHEMA)) == brute(rows)
    else:  # products beyond 64 bits
        with pytest.raises(Exception, match="Overflow|too large|out of"):
            mined(spark.createDataFrame([(*x, "x", 1) for x in rows], SCHEMA))


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert mined(df) == brute([tuple(r) for r in df.select("vec_id", "label", "embedding").collect()])


def test_search_stops_at_the_threshold():
    """With one dominant dimension, the first steps into the lists are enough."""
    n = 5000
    parts = np.zeros((n, 3), dtype=np.int64)
    parts[:, 0] = np.random.RandomState(1).permutation(n) - n // 2
    shard = Shard.of(np.arange(n), np.arange(n) % 2, parts)
    read = []

    class Watched(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, tuple) and isinstance(at[1], slice):
                read.append(at[1].stop - at[1].start)
            return np.asarray(self)[at]

    shard.order = shard.order.view(Watched)
    asked = matrix([np.array([3, 0, 0]), np.array([-2, 1, 0])], 3)
    window = [[Window(negatives.LEAST, negatives.MOST, 5)]] * 2
    found = threshold_search(shard, np.array([-1, -2]), np.array([1, 0]), asked, window, True)
    for (places, scores), label, q in zip((f[0] for f in found), (1, 0), asked):
        every = sorted(((int(parts[i] @ q), -i) for i in range(n) if i % 2 == label), reverse=True)[:5]
        assert [(int(s), -int(i)) for s, i in zip(scores, places)] == every
    assert max(read) < n / 4
