"""The two jobs end to end, and their command line.

``ingest`` turns one log file (or a folder of one kind) into JSON messages; ``enrich``
turns messages into the log table. Run either with spark-submit::

    spark-submit logsieve/jobs.py ingest --input in.csv --messages out/msgs --dead-letters out/dlq
    spark-submit logsieve/jobs.py enrich --messages out/msgs --tools tools.parquet --output out
"""

from __future__ import annotations

import argparse
import datetime as dt
import hashlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, astuple, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsieve.operators.maintain import RETENTION_DAYS
from logsieve.operators.cef import cef_outcomes, parse_cef
from logsieve.operators.metrics import observe_parse
from logsieve.schema import CEF_URL_KEYS, URL_KEYS
from logsieve.session import configure, scratch
from logsieve.sinks.acknowledged import TaskWriter, publish_units, with_unit
from logsieve.sinks.deadletters import write_dead_letters
from logsieve.sinks.messages import Published, Writer, publish, text_writer
from logsieve.sinks.tables import compact_logs, compact_tools, drop_folder, expire_logs, sync_tools, vacuum
from logsieve.sources.changes import CHANGES, ToolDimension
from logsieve.sources.files import Rows, file_batches, outcomes, read_logs, route
from logsieve.sources.kafka import TopicOptions, read_topic, topic_writer
from logsieve.sources.lines import block_offsets, with_line_numbers
from logsieve.sources.tools import tools_loader
from logsieve.streaming.enrichment import Outputs, start_enrichment

MALFORMED_ROW = "malformed_row"
BATCH_BYTES = 16 << 30


@dataclass(frozen=True)
class Ingested:
    processed: int
    failed: int
    published: int
    publish_failed: int


def ingest(
    spark: SparkSession,
    path: str,
    write: Writer | TaskWriter,
    dead_letters: str,
    kind: str | None = None,
    extensions: tuple[str, ...] = (),
    batch_bytes: int = BATCH_BYTES,
    **options,
) -> Ingested:
    """Publish a log file's records and keep its rejects as dead letters.

    write: takes all records at once, or as a `TaskWriter` task by task, each acknowledged by itself.
    kind: record kind of a folder whose name does not tell it.
    extensions: CEF extension keys to publish besides src and dst.
    batch_bytes: files are published in batches of about this size, one file at least; each
    batch is tried again and kept as dead letters by itself.
    """
    kind = kind or route(path)
    # The same input has the same name: repeated, it replaces its own dead letters.
    name = hashlib.sha256(path.encode()).hexdigest()[:16]
    total = Ingested(0, 0, 0, 0)
    for batch_id, files in enumerate(file_batches(spark, path, batch_bytes)):
        source = read_logs(spark, files, kind, **options)
        if kind == "cef":
            done = _ingest_cef(source, write, dead_letters, extensions, batch_id, name)
        else:
            done = _ingest_rows(source, write, dead_letters, batch_id, name)
        total = Ingested(*(a + b for a, b in zip(astuple(total), astuple(done))))
    return total


def _ingest_cef(
    lines: DataFrame, write: Writer | TaskWriter, dead_letters: str, extensions: tuple[str, ...], batch_id: int, name: str
) -> Ingested:
    place = ["file", "block", "seq"]
    parsed = cef_outcomes(parse_cef(lines), keep=place, extensions=extensions)
    with _staged(parsed.withColumn("failed", F.col("error").isNotNull())) as (staged, seen):
        sent = _publish(staged, write, dead_letters, batch_id, name)
        # One row per split, read twice: to measure it and to join it. Only the places of the lines are read.
        offsets = block_offsets(staged.select(*place)).persist()
        try:
            rejects = with_line_numbers(staged.filter("failed").select(*place, "error", "value"), offsets)
            letters = rejects.select("error", "line", F.col("value").alias("raw"))
            write_dead_letters(letters, dead_letters, batch_id, f"{name}-rejects")
        finally:
            offsets.unpersist()
    return Ingested(seen["processed"], seen["failed"], sent.published, sent.failed)


def _ingest_rows(rows: Rows, write: Writer | TaskWriter, dead_letters: str, batch_id: int, name: str) -> Ingested:
    with _staged(outcomes(rows)) as (staged, seen):
        sent = _publish(staged, write, dead_letters, batch_id, name)
        malformed = staged.filter("failed").select(
            F.lit(MALFORMED_ROW).alias("error"),
            F.lit(None).cast("bigint").alias("line"),
            F.col("value").alias("raw"),
        )
        write_dead_letters(malformed, dead_letters, batch_id, f"{name}-rejects")
    return Ingested(seen["processed"], seen["failed"], sent.published, sent.failed)


@contextmanager
def _staged(classified: DataFrame) -> Iterator[tuple[DataFrame, dict[str, int]]]:
    """The outcomes of one pass over the input as a table in the shared folder, records apart from what
    `failed`, and the counters of that pass. Publishing, trying again and numbering rejects read the table,
    so the input is read and parsed once. The table goes in the end."""
    spark = classified.sparkSession
    path = scratch(spark, "ingest")
    counted, seen = observe_parse(classified, F.col("failed"))
    counted.write.partitionBy("failed").parquet(path)
    schema = T.StructType([f for f in classified.schema if f.name != "failed"]).add("failed", T.BooleanType())
    try:
        yield spark.read.schema(schema).parquet(path), seen.get
    finally:
        drop_folder(spark, path)


def _publish(staged: DataFrame, write: Writer | TaskWriter, dead_letters: str, batch_id: int, name: str) -> Published:
    records, run = staged.filter("NOT failed"), f"{name}-publish"
    if isinstance(write, TaskWriter):
        return publish_units(with_unit(records), write, dead_letters, batch_id=batch_id, run=run)
    return publish(records.select("value"), write, dead_letters, batch_id=batch_id, run=run)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="logsieve", description=__doc__.split("\n")[0])
    jobs = parser.add_subparsers(dest="job", required=True)

    one = jobs.add_parser("ingest", help="log file to JSON messages")
    one.add_argument("--input", required=True)
    one.add_argument("--kind", choices=("cef", "csv", "parquet"))
    one.add_argument("--extension", action="append", default=[], help="further CEF key to publish")
    one.add_argument("--lenient", action="store_true", help="drop white space before a CSV cell")
    one.add_argument("--split-lines", action="store_true", help="every line of a CSV file is a record; cells hold no line breaks")
    one.add_argument("--batch-bytes", type=int, default=BATCH_BYTES, help="bytes of files published at once")
    one.add_argument("--dead-letters", required=True)
    out = one.add_mutually_exclusive_group(required=True)
    out.add_argument("--messages", help="folder for message files")
    out.add_argument("--brokers", help="brokers of the topic to publish to")
    one.add_argument("--topic", default=TopicOptions.topic)

    two = jobs.add_parser("enrich", help="messages to the log table, as a stream")
    two.add_argument("--output", required=True)
    dimension = two.add_mutually_exclusive_group(required=True)
    dimension.add_argument("--tools", help="folder of the tools")
    dimension.add_argument("--tools-state", help="folder that follow-tools keeps up to date")
    two.add_argument("--tools-format", default="parquet")
    two.add_argument("--checkpoint")
    two.add_argument("--window-seconds", type=int, default=30)
    two.add_argument("--max-per-batch", type=int, default=TopicOptions.max_per_batch, help="most messages of a topic per batch")
    two.add_argument("--min-partitions", type=int, help="least tasks a topic's batch is read in")
    two.add_argument("--max-bytes", type=int, default=16 << 30, help="most bytes of message files per batch, one file at least")
    two.add_argument("--drain", action="store_true", help="work off what is there and end")
    two.add_argument("--fallback-now", action="store_true", help="unreadable times become now")
    two.add_argument("--cef-keys", action="store_true", help="also look up CEF destinations")
    source = two.add_mutually_exclusive_group(required=True)
    source.add_argument("--messages", help="folder of message files")
    source.add_argument("--brokers", help="brokers of the topic to read")
    two.add_argument("--topic", default=TopicOptions.topic)
    two.add_argument("--group-id")

    three = jobs.add_parser("expire", help="delete log rows that are past retention")
    three.add_argument("--logs", required=True)
    three.add_argument("--days", type=int, default=RETENTION_DAYS)
    three.add_argument("--as-of", type=dt.date.fromisoformat, help="default: today in UTC")

    five = jobs.add_parser("compact-logs", help="many small folders of a month of the log table to one")
    five.add_argument("--logs", required=True)
    five.add_argument("--month", type=int, help="such as 202401; default: every month")
    five.add_argument("--least", type=int, default=2, help="least folders of a month that are worth it")
    five.add_argument("--vacuum", action="store_true", help="also delete what earlier compactions have replaced")

    six = jobs.add_parser("follow-tools", help="keep the tools dimension up to date from a feed of changes")
    six.add_argument("--changes", required=True, help="folder of JSON lines: the tools' columns and deleted")
    six.add_argument("--state", required=True, help="folder of the dimension")
    six.add_argument("--checkpoint")
    six.add_argument("--window-seconds", type=int, default=30)
    six.add_argument("--drain", action="store_true", help="work off what is there and end")

    four = jobs.add_parser("compact-tools", help="current version of each tool to a table of its own")
    four.add_argument("--tools", required=True)
    four.add_argument("--target", required=True)
    return parser


def _run_expire(spark: SparkSession, args: argparse.Namespace) -> None:
    today = args.as_of or dt.datetime.now(dt.timezone.utc).date()
    print(expire_logs(spark, args.logs, today, args.days))


def _run_compact_logs(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.vacuum:
        print(vacuum(spark, args.logs))
    print(compact_logs(spark, args.logs, args.month, args.least))


def _run_compact(spark: SparkSession, args: argparse.Namespace) -> None:
    compact_tools(spark, args.tools, args.target)


def _run_ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.messages:
        write = text_writer(args.messages)
    else:
        write = topic_writer(TopicOptions(args.brokers, args.topic))
    dialect = {"lenient": args.lenient, "multiline": not args.split_lines}
    kind = args.kind or route(args.input)
    options = dialect if kind == "csv" else {}
    done = ingest(spark, args.input, write, args.dead_letters, kind, tuple(args.extension), args.batch_bytes, **options)
    print(asdict(done))


def _run_follow(spark: SparkSession, args: argparse.Namespace) -> None:
    changes = spark.readStream.schema(CHANGES).json(args.changes)
    ToolDimension(spark, args.state).follow(changes, args.checkpoint, args.window_seconds, args.drain).awaitTermination()


def _run_enrich(spark: SparkSession, args: argparse.Namespace) -> None:
    outputs = Outputs.under(args.output)
    if args.tools_state:
        dimension = ToolDimension(spark, args.tools_state)
        load, tools = dimension.current, dimension.tools()
    else:
        load = tools_loader(spark, args.tools, args.tools_format)
        tools = load()
    sync_tools(tools, f"{args.output.rstrip('/')}/tools")
    if args.messages:
        stream = spark.readStream.option("maxBytesPerTrigger", args.max_bytes).text(args.messages)
    else:
        stream = read_topic(
            spark,
            TopicOptions(
                args.brokers,
                args.topic,
                group_id=args.group_id,
                max_per_batch=args.max_per_batch,
                min_partitions=args.min_partitions,
            ),
        )
    start_enrichment(
        stream,
        load,
        outputs,
        args.checkpoint,
        args.window_seconds,
        args.drain,
        URL_KEYS + (CEF_URL_KEYS if args.cef_keys else ()),
        "now" if args.fallback_now else None,
    ).awaitTermination()


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = configure(SparkSession.builder.appName(f"logsieve-{args.job}").getOrCreate())
    {
        "ingest": _run_ingest,
        "enrich": _run_enrich,
        "follow-tools": _run_follow,
        "expire": _run_expire,
        "compact-logs": _run_compact_logs,
        "compact-tools": _run_compact,
    }[args.job](spark, args)


if __name__ == "__main__":
    main()
