"""Messages to the log table, micro-batch by micro-batch.

Each batch is an ordinary DataFrame run through the batch operators, so a stream and
a batch job give the same rows. Batches are written in parallel and by id: a batch
that is run again after a failure replaces what its first run left behind.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logsieve.operators.enrich import classify
from logsieve.operators.events import parse_events
from logsieve.operators.lookup import PreparedTools
from logsieve.operators.metrics import observe_books, window_counts
from logsieve.operators.projection import log_projection, violations
from logsieve.schema import URL_KEYS
from logsieve.session import checkpoint_location
from logsieve.sinks.deadletters import write_dead_letters
from logsieve.sinks.tables import write_logs

BAD_JSON = "bad_json"


@dataclass(frozen=True)
class Outputs:
    """Folders the enrichment writes to."""

    logs: str
    dead_letters: str
    violations: str
    metrics: str

    @classmethod
    def under(cls, root: str) -> Outputs:
        root = root.rstrip("/")
        return cls(*(f"{root}/{name}" for name in ("logs", "dead_letters", "violations", "metrics")))


def process_batch(
    messages: DataFrame,
    batch_id: int,
    tools: DataFrame | PreparedTools,
    outputs: Outputs,
    url_keys: tuple[str, ...] = URL_KEYS,
    fallback: str | None = None,
    run: str = "stream",
) -> None:
    """Enrich one batch of messages and write its logs, violations, dead letters and
    counts, below the name of the run. The messages stay in the source's splits. Only
    events that are kept and unreadable messages stay while the outputs are written; what is
    dropped is counted as it passes. So a batch is read, parsed and joined once; the source's
    rate options bound it."""
    extra = tuple(k for k in url_keys if k not in URL_KEYS)
    events = parse_events(messages, extra_keys=extra)
    counted, seen = observe_books(classify(events, tools, url_keys))
    batch = counted.filter(F.col("reason").isin("kept", BAD_JSON))
    batch = batch.withColumn("value", F.when(F.col("reason") == BAD_JSON, F.col("value"))).persist()
    part = f"run={run}/batch_id={batch_id}"
    try:
        batch.write.format("noop").mode("overwrite").save()  # reads, parses, joins and counts, once
        kept = batch.filter(F.col("reason") == "kept")
        write_logs(log_projection(kept, fallback), outputs.logs, batch_id, run, seen.get["kept"])
        violations(kept).write.mode("overwrite").parquet(f"{outputs.violations}/{part}")
        unread = batch.filter(F.col("reason") == BAD_JSON).select(
            F.lit(BAD_JSON).alias("error"),
            F.lit(None).cast("bigint").alias("line"),
            F.col("value").alias("raw"),
        )
        write_dead_letters(unread, outputs.dead_letters, batch_id, run)
        books = messages.sparkSession.createDataFrame([seen.get], "read long, kept long, rejected long, dropped long")
        books.coalesce(1).write.mode("overwrite").parquet(f"{outputs.metrics}/{part}")
    finally:
        batch.unpersist()


def start_enrichment(
    messages: DataFrame,
    load_tools: Callable[[], DataFrame | PreparedTools],
    outputs: Outputs,
    checkpoint: str | None = None,
    seconds: int = 30,
    drain: bool = False,
    url_keys: tuple[str, ...] = URL_KEYS,
    fallback: str | None = None,
) -> StreamingQuery:
    """Start the stream. `messages` has a `value` column; `load_tools` is called for
    every batch, so changes of the dimension take effect with the next one; with
    `ToolDimension.current` an unchanged dimension is not even read again.

    A batch is started every `seconds`; with `drain` the stream works off what is there
    and ends. Size batches with the source's rate options.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        process_batch(batch, batch_id, load_tools(), outputs, url_keys, fallback, run_of(batch))

    writer = messages.writeStream.foreachBatch(run).option(
        "checkpointLocation", checkpoint_location(messages.sparkSession, "enrichment", checkpoint)
    )
    trigger = {"availableNow": True} if drain else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


def run_of(batch: DataFrame) -> str:
    """The id of the stream that a micro-batch belongs to: it stays while its checkpoint does."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"


def start_window_counts(
    events: DataFrame, ts: str, path: str, checkpoint: str | None = None, seconds: int = 30, drain: bool = False
) -> StreamingQuery:
    """Start counting events per event-time window. Each micro-batch adds its own counts, and a
    batch that is run again replaces them, so that no event is too late and no window waits for
    the next; `read_window_counts` adds them up."""

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = window_counts(batch, ts, seconds)
        counts.write.mode("overwrite").parquet(f"{path}/run={run_of(batch)}/batch_id={batch_id}")

    writer = events.writeStream.foreachBatch(write).option(
        "checkpointLocation", checkpoint_location(events.sparkSession, "window_counts", checkpoint)
    )
    trigger = {"availableNow": True} if drain else {"processingTime": f"{seconds} seconds"}
    return writer.trigger(**trigger).start()


def read_window_counts(spark: SparkSession, path: str) -> DataFrame:
    parts = spark.read.parquet(path)
    return parts.groupBy("window_start", "window_end").agg(F.sum("n").alias("n"))
