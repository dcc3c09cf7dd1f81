"""Dead letters: one JSON object per line, ``error``, ``line`` (if known) and ``raw``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from logsieve.operators.cef import reject_json

DEAD_LETTER_SCHEMA = "error string, line bigint, raw string"


def write_dead_letters(
    letters: DataFrame, path: str, batch_id: int | None = None, run: str = "stream"
) -> int:
    """Write `(error, line, raw)` rows and return how many. With a batch id a repeated
    write by the same run replaces the first; without one, rows are added."""
    seen = Observation()
    text = letters.select(
        reject_json(F.col("error"), F.col("line"), F.col("raw")).alias("value")
    ).observe(seen, F.count(F.lit(1)).alias("n"))
    if batch_id is None:
        text.write.mode("append").text(path)
    else:
        text.write.mode("overwrite").text(f"{path}/run={run}/batch_id={batch_id}")
    return seen.get["n"]


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DEAD_LETTER_SCHEMA).json(path).select("error", "line", "raw")
