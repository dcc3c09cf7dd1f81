import zlib

import numpy as np
from pyspark.sql import functions as F

from logsieve.llm.fourier import isotonic, score_quality


def test_isotonic():
    x, y = isotonic(np.arange(6.0), np.array([0, 3, 1, 5, 9, 10.0]), np.full(6, 10.0))
    assert len(x) == 5 and (np.diff(y) > 0).all() and 0 < y[0] and y[-1] < 1
    assert abs(x[1] - 1.5) < 1e-9 and abs(y[1] - 0.2) < 0.01


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    rows = score_quality(docs, labels).join(labels, "doc_id").where("held_out").collect()
    for r in rows[:50]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.5)
    bad, good = ([r for r in rows if r.quality == q] for q in (0, 1))
    wrong = lambda of, q: sum(r.predicted != q for r in of) / len(of)
    assert wrong(good, 1) < 0.02 and wrong(bad, 0) < 0.1
    # Calibrated: scores of a class of bins mean what they say.
    assert abs(np.mean([r.score for r in rows]) - len(good) / len(rows)) < 0.03


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "x " * 100_000), (None, "a b"), (None, "a b"), (4, "é")]
    docs = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, held_out string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in score_quality(docs, none).collect()] == [0.5] * 6
    some = spark.createDataFrame([(i, i % 2) for i in range(1, 5)] + [(1, None), (None, 1)], "doc_id long, quality int")
    got = score_quality(docs, some).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert score_quality(docs.limit(0), some).count() == 0


def test_nothing_leaks(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    crc = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 3
    flipped = labels.withColumn("quality", F.when(crc == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, two = (sorted(map(tuple, score_quality(docs, x).collect())) for x in (labels, flipped))
    assert np.allclose([r[2] for r in one], [r[2] for r in two])
