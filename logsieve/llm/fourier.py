"""A quality score: ridge regression on random Fourier features of document statistics.

The statistics are SQL expressions over the text alone. Random Fourier features stand for a Gaussian kernel
over them; every task adds up its part of the normal equations, whose size does not depend on the number of
rows, and their sum is solved once. A fold of the labelled rows that took no part is used to calibrate the
raw scores by isotonic regression, from counts in bins.

Defined results: a null or empty text has statistics of zero and is scored like any other; rows are labelled
by the mean of their id's labels; repeated rows are scored alike; without labels every score is 0.5; labels,
ids and other columns are never inputs of a score; an empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.functions.once import with_once
from logsieve.llm.base import quoted, written
from logsieve.llm.sums import summed

FEATURES = 256
WIDTH = 1.0  # of the kernel, times the root of the number of statistics
RIDGE = 1.0
SEED = 11
# One of so many labelled rows calibrates, the others fit.
CALIBRATE = 4
# Bins of the raw score, between these limits.
BINS, LOW, HIGH = 2000, -0.5, 1.5

STATISTICS = [
    "log_chars",
    "log_words",
    "word_length",
    "distinct",
    "symbols",
    "digits",
    "marks",
    "capitals",
    "shouts",
    "log_lines",
    "repeated_lines",
    "words_per_line",
    "stutter",
]


def statistics(docs: DataFrame, text: str, keep: list[Column]) -> DataFrame:
    """``keep`` columns and the statistics of each text (doubles)."""
    df = docs.select(*keep, F.coalesce(F.col(quoted(text)), F.lit("")).alias("__t"))
    names = df.columns[:-1]
    df = with_once(df, "__w", F.array_remove(F.split("__t", r"[ \t\n\x0b\f\r]+"), ""))
    df = with_once(df, "__l", F.filter(F.split("__t", "\n"), lambda x: F.btrim(x) != ""))
    df = with_once(df, "__h", F.transform("__w", lambda w: F.xxhash64(w)))
    count = lambda pattern: F.regexp_count("__t", F.lit(pattern)).cast("double")
    chars, words, lines = (F.greatest(x.cast("double"), F.lit(1.0)) for x in (F.length("__t"), F.size("__w"), F.size("__l")))
    values = [
        F.log1p(F.length("__t").cast("double")),
        F.log1p(F.size("__w").cast("double")),
        F.least(chars / words, F.lit(50.0)),
        F.size(F.array_distinct("__h")) / words,
        count(r"[#*$%\&|<>]") / chars,
        count("[0-9]") / chars,
        count("[.,;:!?]") / words,
        count(r"\p{Lu}") / chars,
        count("!") / words,
        F.log1p(F.size("__l").cast("double")),
        (F.size("__l") - F.size(F.array_distinct("__l"))) / lines,
        F.log1p(words / lines),
        F.size(F.filter("__h", lambda h, i: h.eqNullSafe(F.get("__h", i - 1)))) / words,
    ]
    return df.select(*names, *(v.cast("double").alias(n) for v, n in zip(values, STATISTICS)))


class Features:
    """Standardised statistics as random Fourier features and a constant."""

    def __init__(self, mean: list[float], deviation: list[float]):
        r = np.random.RandomState(SEED)
        d = len(STATISTICS)
        self.mean, self.deviation = np.array(mean), np.maximum(np.array(deviation), 1e-6)
        self.frequency = r.normal(0, 1 / (WIDTH * np.sqrt(d)), (d, FEATURES))
        self.phase = r.uniform(0, 2 * np.pi, FEATURES)

    def __call__(self, batch: pa.RecordBatch) -> np.ndarray:
        x = np.stack([batch.column(s).to_numpy() for s in STATISTICS], axis=1).reshape(-1, len(STATISTICS))
        x = np.clip((x - self.mean) / self.deviation, -8, 8)
        z = np.sqrt(2 / FEATURES) * np.cos(x @ self.frequency + self.phase)
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)


def ridge(rows: DataFrame, features: Features) -> np.ndarray:
    """The weights that fit label (a column of ``rows``)."""
    size = FEATURES + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, moment = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                z = features(part)
                square += z.T @ z
                moment += z.T @ part.column("label").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(size), pa.int64()),
                pa.array([r.tobytes() for r in square], pa.binary()),
                pa.array([m.tobytes() for m in moment], pa.binary()),
            ],
            names=["i", "square", "moment"],
        )

    sums = rows.select(*STATISTICS, "label").mapInArrow(run, "i long, square binary, moment binary")
    square, moment = np.zeros((size, size)), np.zeros(size)
    for row in summed(sums, "i", ["square", "moment"], np.float64).toLocalIterator():
        square[row["i"]] = np.frombuffer(row["square"])
        moment[row["i"]] = np.frombuffer(row["moment"])[0]
    return np.linalg.solve(square + RIDGE * np.eye(size), moment)


def isotonic(values: np.ndarray, right: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising values at points, for sorted points with so many rows of which so many are right: neighbours that
    would fall are pooled. One more right and wrong row at the ends keep scores inside 0 and 1."""
    blocks: list[list[float]] = []
    for x, r, n in zip(values, right, total):
        blocks.append([x * n, r, n])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    points = np.array([b[0] / b[2] for b in blocks])
    share = np.array([(b[1] + 0.02) / (b[2] + 0.04) for b in blocks])
    return points, np.maximum.accumulate(share)


def scored(rows: DataFrame, keep: list[str], score) -> DataFrame:
    """``keep`` columns and the score that a function of a batch gives."""
    kinds = {f.name: f for f in rows.schema.fields}
    schema = ", ".join([*(f"{quoted(c)} {kinds[c].dataType.simpleString()}" for c in keep), "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [*(batch.column(c) for c in keep), pa.array(score(batch), pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, "score"])

    return rows.select(*keep, *STATISTICS).mapInArrow(run, schema)


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    folds: int = 3,
    held: int = 1,
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row; rows whose id has the checksum remainder ``held``
    teach nothing."""
    own_id = F.col(quoted(doc_id))
    crc = F.crc32(F.encode(F.coalesce(own_id.cast("string"), F.lit("")), "UTF-8"))
    keep = [own_id.alias("doc_id"), (crc % folds == held).alias("held_out"), (crc.bitwiseXOR(F.shiftright(crc, 11)) % CALIBRATE == 0).alias("calibrates")]
    table = written(statistics(docs, text, keep), "statistics")
    known = (
        labels.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(label)).alias("label"))
        .where("label IS NOT NULL")
        .groupBy("doc_id")
        .agg((F.avg("label") >= 0.5).cast("double").alias("label"))
    )
    taught = written(table.where("NOT held_out").join(known, "doc_id"), "labelled")
    moments = taught.where("NOT calibrates").agg(
        F.count("*").alias("n"),
        *(F.avg(s).alias(f"mean_{s}") for s in STATISTICS),
        *(F.stddev_pop(s).alias(f"dev_{s}") for s in STATISTICS),
    ).first()
    if not moments["n"]:
        return table.select("doc_id", "held_out", F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))
    features = Features(*([moments[f"{m}_{s}"] for s in STATISTICS] for m in ("mean", "dev")))
    weights = ridge(taught.where("NOT calibrates"), features)
    raw = lambda batch: np.clip(features(batch) @ weights, LOW, HIGH)
    bins = (
        scored(taught.where("calibrates"), ["label"], raw)
        .groupBy(F.floor((F.col("score") - LOW) / (HIGH - LOW) * BINS).alias("bin"))
        .agg(F.avg("score").alias("at"), F.sum("label").alias("right"), F.count("*").alias("n"))
        .orderBy("bin")
        .collect()
    )
    points, share = isotonic(*(np.array([r[c] for r in bins], dtype=float) for c in ("at", "right", "n")))
    if not len(points):
        points, share = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    calibrated = lambda batch: np.interp(raw(batch), points, share)
    return scored(table, ["doc_id", "held_out"], calibrated).withColumn(
        "predicted", (F.col("score") >= 0.5).cast("int")
    )
