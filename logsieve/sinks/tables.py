"""The written tables: logs by month, tools by version, Parquet copies of a CSV file."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.functions.once import quoted
from logsieve.operators.lookup import fits_broadcast, normalise_tools
from logsieve.operators.maintain import RETENTION_DAYS, latest_tools, month_of, retained
from logsieve.sinks.manifest import (
    COMPACTED,
    Conflict,
    Manifest,
    commit,
    folders,
    live_folders,
    read_folders,
    read_log_table,
    read_manifest,
)
from logsieve.sources.files import Rows, good_rows

# The order of rows within a file of the log table.
SORT_KEY = ("date", "eventtime", "tool_id", "srcip")


# Rows of a file of the log table, about.
ROWS_PER_FILE = 2_000_000
# Times are written in a type that Parquet keeps least and greatest values of, so that readers skip files.
_TIMES = ("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")


def write_logs(
    logs: DataFrame,
    path: str,
    batch_id: int | None = None,
    run: str | None = None,
    rows: int | None = None,
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """Write the log table's columns and the insertion time, partitioned by month and clustered.

    Rows are dealt to files by sampled ranges of month and SORT_KEY, and sorted within them. So the
    files of a write have disjoint ranges, and a filter on a time skips most of a month by the footers. A
    day, or a single key, that holds many rows is spread over several files by a hash of the row.
    `rows` is the number of rows if the caller knows it, else they are counted.

    Below the month lie the run that wrote the rows (a stream by its query's id) and its batch: writing
    the same batch of the same run again replaces it and touches nothing else; without a batch id, the
    rows are a run of their own.
    """
    stamped = logs.withColumn("_inserted_at", F.current_timestamp()).withColumn("yyyymm", month_of(F.col("date")))
    laid_out = clustered(stamped, logs.columns, rows, rows_per_file)
    run = run or ("stream" if batch_id is not None else f"batch-{uuid.uuid4().hex}")
    placed = laid_out.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id or 0).cast("bigint")})
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    with _setting(logs.sparkSession, *_TIMES):
        writer.partitionBy("yyyymm", "run", "batch_id").option("compression", "snappy").parquet(path)


def clustered(logs: DataFrame, columns: list[str], rows: int | None, rows_per_file: int) -> DataFrame:
    """The rows in about `rows_per_file` each of disjoint ranges; only rows equal in all `columns` stay together."""
    count = logs.count() if rows is None else rows
    by = ["yyyymm", *SORT_KEY]
    dealt = logs.withColumn("_deal", F.xxhash64(*(F.col(quoted(c)) for c in columns)))
    parts = dealt.repartitionByRange(max(1, -(-count // rows_per_file)), *by, "_deal")
    # The month leads the sort so that the partitioned write adds no sort of its own.
    return parts.drop("_deal").sortWithinPartitions(*by)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def compact_logs(
    spark: SparkSession, path: str, month: int | None = None, least: int = 2, rows_per_file: int = ROWS_PER_FILE
) -> list[str]:
    """Write the rows of the live folders of a month (or of every month that has at least `least` of them)
    anew as one folder with disjoint files, and switch readers over (see `manifest`); returns the new folders.
    The last batch of each run is left alone, as a stream may write it again. What is replaced stays
    on disk for readers that have begun; `vacuum` deletes it."""
    if not read_manifest(spark, path).version:  # readers must know of manifests before there is a second copy
        with suppress(Conflict):
            commit(spark, path, Manifest(1))
    settled = _settled(live_folders(spark, path))
    months: dict[str, list[str]] = {}
    for folder in settled:
        months.setdefault(folder.split("/")[0].removeprefix("yyyymm="), []).append(folder)
    done = []
    for name, chosen in sorted(months.items()):
        if len(chosen) < max(2, least) or (month is not None and name != str(month)):
            continue
        target = f"yyyymm={name}/run={COMPACTED}{uuid.uuid4().hex}/batch_id=0"
        rows = read_folders(spark, path, chosen)
        columns = [c for c in rows.columns if c not in ("yyyymm", "run", "batch_id")]
        laid_out = clustered(rows.select(*columns, "yyyymm"), columns, None, rows_per_file).drop("yyyymm")
        with _setting(spark, *_TIMES):
            laid_out.write.option("compression", "snappy").parquet(f"{path.rstrip('/')}/{target}")
        switch(spark, path, chosen, target)
        done.append(target)
    return done


def _settled(live: list[str]) -> list[str]:
    """The folders that their run will not write again: all but the last batch of each stream."""
    last: dict[str, int] = {}
    place = {f: (f.split("/")[1], int(f.rsplit("=", 1)[1])) for f in live}
    for run, batch in place.values():
        last[run] = max(batch, last.get(run, batch))
    whole = (f"run={COMPACTED}", "run=batch-")
    return [f for f, (run, batch) in place.items() if batch < last[run] or run.startswith(whole)]


def switch(spark: SparkSession, path: str, old: list[str], new: str, attempts: int = 5) -> None:
    """From here on `new` is read in place of the folders `old`."""
    for attempt in range(attempts):
        manifest = read_manifest(spark, path)
        if not all(map(manifest.is_live, old)):
            raise Conflict("another job has replaced some of these folders")
        replaced = manifest.replaced | {f for f in old}
        compacted = (manifest.compacted - set(old)) | {new}
        try:
            return commit(spark, path, Manifest(manifest.version + 1, replaced, compacted))
        except Conflict:
            if attempt == attempts - 1:
                raise


def vacuum(spark: SparkSession, path: str, abandoned: bool = False) -> list[str]:
    """Delete the folders that the manifest has replaced, and with `abandoned` also those that compactions left
    behind without a switch (no compaction may be running then). Call it once readers of older versions are done."""
    manifest = read_manifest(spark, path)
    there = folders(spark, path)
    left = [f for f in there if f in manifest.replaced or (abandoned and not manifest.is_live(f))]
    for folder in left:
        drop_folder(spark, f"{path.rstrip('/')}/{folder}")
    gone = manifest.replaced & set(there)
    if gone:
        commit(spark, path, Manifest(manifest.version + 1, manifest.replaced - gone, manifest.compacted))
    return left


def tool_versions(tools: DataFrame) -> DataFrame:
    """Rows of the tools table from the dimension: each row with a url, as it is; rows
    without a time of change are changed now."""
    now = F.current_timestamp()
    return normalise_tools(tools).select(
        F.col("id").alias("tool_id"),
        "url",
        F.coalesce("name", F.lit("")).alias("name"),
        F.col("score").cast("float").alias("score"),
        F.coalesce("risk", F.lit("")).alias("risk"),
        F.coalesce("ai_category", F.lit("")).alias("ai_category"),
        F.coalesce("updated_at", now).alias("updated_at"),
        now.alias("created_at"),
    )


def sync_tools(tools: DataFrame, path: str) -> None:
    """Add the dimension's rows to the tools table; `latest_tools` reads the current ones."""
    tool_versions(tools).write.mode("append").parquet(path)


def write_converted(rows: Rows, path: str) -> None:
    """A file's good rows as Snappy Parquet, all columns text."""
    parts = [p.df.select(*p.cells()) for p in good_rows(rows).parts()]
    named = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    named.write.mode("errorifexists").option("compression", "snappy").parquet(path)


def expire_logs(spark: SparkSession, path: str, as_of: dt.date, days: int = RETENTION_DAYS) -> list[str]:
    """Delete what `retained` leaves out of a log table; returns the folders that were dropped or
    rewritten. Months before the horizon are dropped unread. Of the horizon's own month, and of rows
    without a date, only folders (month, run, batch) with expired rows are written anew: first beside
    the table, then in place, each folder replaced whole."""
    logs = read_log_table(spark, path)
    horizon = as_of - dt.timedelta(days=days)
    first = horizon.year * 100 + horizon.month
    part = ["yyyymm", "run", "batch_id"]
    expired = logs.filter("yyyymm < %d" % first).select("yyyymm").distinct().collect()
    done = [f"yyyymm={r.yyyymm}" for r in expired]
    edge = logs.filter(F.col("yyyymm").isNull() | (F.col("yyyymm") == first))
    left = retained(edge, as_of, days).select(*part, F.lit(1).alias("kept"))
    gone = edge.select(*part, F.lit(0).alias("kept")).unionByName(left).groupBy(*part)
    # A row per folder, of one month and of those without a date.
    touched = gone.agg(F.count_if(F.col("kept") == 0).alias("n"), F.sum("kept").alias("left")).filter("left < n")
    rows = touched.collect()
    if rows:
        on = touched.select(*(F.col(p).alias(f"_{p}") for p in part))
        on = F.broadcast(on) if fits_broadcast(on) else on
        same = [F.col(p).eqNullSafe(F.col(f"_{p}")) for p in part]
        keep = retained(edge, as_of, days).join(on, same, "left_semi")
        aside = f"{path.rstrip('/')}_expiring_{uuid.uuid4().hex}"
        keep.write.parquet(aside)  # in the files' order, which the second write keeps
        writer = spark.read.parquet(aside).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        with _setting(spark, *_TIMES):
            writer.partitionBy(*part).parquet(path)
        drop_folder(spark, aside)
    null = "__HIVE_DEFAULT_PARTITION__"
    for r in rows:
        folder = f"yyyymm={null if r.yyyymm is None else r.yyyymm}/run={r.run}/batch_id={r.batch_id}"
        done.append(folder)
        if not r.left:
            drop_folder(spark, f"{path}/{folder}")
    for r in expired:
        drop_folder(spark, f"{path}/yyyymm={r.yyyymm}")
    return done


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system it lies on."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def compact_tools(spark: SparkSession, path: str, target: str) -> None:
    """Write the current version of each tool to `target`, a table of its own that replaces the
    versions once readers use it."""
    latest_tools(spark.read.parquet(path)).write.mode("overwrite").parquet(target)
