"""Publishing in units that are acknowledged one by one.

A unit is what one task reads of one file of a written table. A task sends its units with a client of its own and
returns a row for each: how many messages were sent, or why it was given up. A unit without an acknowledgement is sent
again, the others are not; after the last attempt only the units that are still missing become dead letters. So one
broken task costs its own messages again, not those of the whole batch. Only a row per unit reaches the driver.

Delivery is at least once, per unit: one that was given up half-way is sent again whole, as is one whose task
is lost before it has returned.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsieve.sinks.deadletters import write_dead_letters
from logsieve.sinks.messages import PUBLISH_FAILED, Published

# Sends some messages, all or (by raising) none that count.
Sender = Callable[[list[str]], None]

ACKS = "unit string, sent bigint, error string"


@dataclass(frozen=True)
class TaskWriter:
    """How tasks send messages. `open` is called in every task and gives its sender; it must be a function
    that Spark can ship. `at_once`: messages per call of the sender."""

    open: Callable[[], Sender]
    at_once: int = 500


def with_unit(table: DataFrame) -> DataFrame:
    """Add `unit` to a table read from files: the file, and the place in it from which a task reads."""
    return table.withColumn("unit", F.concat_ws("#", F.col("_metadata.file_path"), F.col("_metadata.file_block_start").cast("string")))


def send_units(messages: DataFrame, writer: TaskWriter) -> DataFrame:
    """Send `messages` (unit, value), those of a unit one after the other; a row (ACKS) per unit, with an
    `error` if it was given up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender, unit, sent, error, waiting = None, None, 0, None, []

        def flush() -> None:
            nonlocal sender, sent, error
            if waiting and error is None:
                try:
                    sender = sender or writer.open()
                    sender(list(waiting))
                    sent += len(waiting)
                except Exception as failure:  # whatever the client raises gives up this unit
                    error, sender = f"{type(failure).__name__}: {failure}", None
            waiting.clear()

        def done() -> pa.RecordBatch:
            flush()
            return pa.RecordBatch.from_arrays(
                [pa.array([unit]), pa.array([sent], pa.int64()), pa.array([error], pa.string())], names=["unit", "sent", "error"]
            )

        for batch in batches:
            units = batch.column(0).dictionary_encode()
            code = units.indices.to_numpy()
            starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else []
            for a, b in zip(starts, [*starts[1:], len(code)]):
                own = batch.column(0)[int(a)].as_py()
                if own != unit:
                    if unit is not None:
                        yield done()
                    unit, sent, error = own, 0, None
                values = batch.column(1).slice(int(a), int(b - a)).to_pylist()
                for at in range(0, len(values), writer.at_once):
                    waiting.extend(values[at : at + writer.at_once])
                    if len(waiting) >= writer.at_once:
                        flush()
        if unit is not None:
            yield done()

    return messages.select("unit", "value").mapInArrow(run, ACKS)


def publish_units(
    messages: DataFrame,
    writer: TaskWriter,
    dead_letters: str,
    attempts: int = 3,
    backoff: float = 0.25,
    batch_id: int | None = None,
    run: str = "publish",
) -> Published:
    """Send the non-null values of `messages` (unit, value: a written table `with_unit`), units without an
    acknowledgement again after a growing pause. What is missing in the end is kept as dead letters, those of an
    earlier try of the same run and batch being replaced."""
    values = messages.select("unit", "value").filter(F.col("value").isNotNull())
    spark, acknowledged, published, left = messages.sparkSession, [], 0, values
    for attempt in range(1, attempts + 1):
        acks = send_units(left, writer).collect()  # a row per split of a batch of files
        acknowledged += [(r.unit,) for r in acks if r.error is None]
        published += sum(r.sent for r in acks if r.error is None)
        failed = [r for r in acks if r.error is not None]
        done = spark.createDataFrame(acknowledged, "unit string")
        left = values.join(F.broadcast(done), "unit", "left_anti") if acknowledged else values
        if not failed:
            return Published(published, 0, attempt)
        if attempt < attempts:
            time.sleep(backoff * attempt)
    print(f"{len(failed)} units not acknowledged after {attempts} attempts, keeping dead letters: {failed[0].error}")
    lost = left.select(F.lit(PUBLISH_FAILED).alias("error"), F.lit(None).cast("bigint").alias("line"), F.col("value").alias("raw"))
    return Published(published, write_dead_letters(lost, dead_letters, batch_id, run), attempts)
