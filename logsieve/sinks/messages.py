"""Messages out, with bounded retries; what cannot be published goes to dead letters."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from logsieve.sinks.deadletters import write_dead_letters

PUBLISH_FAILED = "publish_failed"

# A writer takes a frame with a `value` column and runs one action on it.
Writer = Callable[[DataFrame], None]


@dataclass(frozen=True)
class Published:
    published: int
    failed: int
    attempts: int


def text_writer(path: str) -> Writer:
    """Messages as lines of text files."""

    def write(values: DataFrame) -> None:
        values.write.mode("append").text(path)

    return write


def publish(
    messages: DataFrame,
    write: Writer,
    dead_letters: str,
    attempts: int = 3,
    backoff: float = 0.25,
    batch_id: int | None = None,
    run: str = "publish",
) -> Published:
    """Hand the non-null values to the writer, trying again after a growing pause. After
    the last failure the values are kept as dead letters, those of an earlier try of the
    same run and batch being replaced.

    Delivery is at least once: an attempt that failed half-way may have published part.
    """
    values = messages.select("value").filter(F.col("value").isNotNull())
    count = F.count(F.lit(1)).alias("n")
    for attempt in range(1, attempts + 1):
        seen = Observation()
        try:
            write(values.observe(seen, count))
        except Exception as failure:  # whatever the writer raises counts as a failed attempt
            if attempt == attempts:
                print(f"publishing failed {attempts} times, keeping dead letters: {failure}")
            else:
                time.sleep(backoff * attempt)
        else:
            return Published(seen.get["n"], 0, attempt)
    lost = values.select(
        F.lit(PUBLISH_FAILED).alias("error"),
        F.lit(None).cast("bigint").alias("line"),
        F.col("value").alias("raw"),
    )
    return Published(0, write_dead_letters(lost, dead_letters, batch_id, run), attempts)
