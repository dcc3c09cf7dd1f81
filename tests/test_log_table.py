"""The log table's files: disjoint ranges, compaction with a switch, crashes in between."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from logsieve.jobs import main
from logsieve.sinks import tables
from logsieve.sinks.manifest import Conflict, Manifest, commit, folders, live_folders, read_log_table, read_manifest
from logsieve.sinks.tables import compact_logs, expire_logs, switch, vacuum, write_logs

SCHEMA = "date date, eventtime timestamp, tool_id long, srcip string, log_id long"


def logs(spark, n, hot=0.0, start="2024-01-01", step=89):
    """Rows some 89 seconds apart; a share of them at one moment, with one tool and address."""
    i = F.col("id")
    usual = F.timestamp_micros(F.unix_micros(F.lit(f"{start} 00:00:00").cast("timestamp")) + i * step * 1_000_000)
    hit = F.pmod(F.xxhash64("id"), F.lit(1000)) < int(1000 * hot)
    time = F.when(hit, F.lit("2024-01-20 12:00:00").cast("timestamp")).otherwise(usual)
    return spark.range(n).select(
        time.cast("date").alias("date"),
        time.alias("eventtime"),
        F.when(hit, 7).otherwise(i % 5).alias("tool_id"),
        F.when(hit, "1.1.1.1").otherwise(F.concat(F.lit("10.0.0."), (i % 250).cast("string"))).alias("srcip"),
        i.alias("log_id"),
    )


def ranges(path):
    """(least, greatest time, rows) of each file by its footer."""
    out = []
    for file in glob.glob(f"{path}/yyyymm=*/run=*/batch_id=*/*.parquet"):
        meta = pq.read_metadata(file)
        at = meta.schema.names.index("eventtime")
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        assert all(s is not None and s.has_min_max for s in stats)
        out.append((min(s.min for s in stats), max(s.max for s in stats), meta.num_rows))
    return sorted(out)


def test_files_have_disjoint_ranges(spark, tmp_path):
    path = str(tmp_path / "logs")
    write_logs(logs(spark, 28_000), path, rows_per_file=1000)
    found = ranges(path)
    assert len(found) > 20 and sum(n for _, _, n in found) == 28_000
    assert all(a[1] <= b[0] for a, b in zip(found, found[1:]))
    assert max(n for _, _, n in found) < 2500
    # A filter on one hour reads a small part of the month: rows that the scan gives after skipping by footers.
    hour = read_log_table(spark, path).filter("eventtime >= '2024-01-20 11:00:00' AND eventtime < '2024-01-20 12:00:00'")
    met = [r for r in found if r[0] < dt.datetime(2024, 1, 20, 12, tzinfo=dt.timezone.utc) and r[1] >= dt.datetime(2024, 1, 20, 11, tzinfo=dt.timezone.utc)]
    assert len(met) <= 2 and hour.count() > 30
    hour.write.format("noop").mode("overwrite").save()
    assert scanned(hour) <= sum(n for _, _, n in met)


def scanned(df):
    """Rows that the scan of a frame gave in its own last run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    stack, total = [plan], 0
    while stack:
        node = stack.pop()
        if node.nodeName().startswith("Scan"):
            total += node.metrics().apply("numOutputRows").value()
        if node.nodeName() == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
    return total


def test_a_hot_moment_is_dealt_to_many_files(spark, tmp_path):
    path = str(tmp_path / "logs")
    write_logs(logs(spark, 20_000, hot=0.35), path, rows_per_file=1000)
    sizes = [n for _, _, n in ranges(path)]
    assert sum(sizes) == 20_000 and max(sizes) < 2500


def batches(spark, path, n, run="q"):
    for batch in range(n):
        write_logs(logs(spark, 40, start=f"2024-0{1 + batch % 2}-0{1 + batch % 9}").withColumn("log_id", F.col("log_id") + 1000 * batch), path, batch, run, 40)


def ids(spark, path):
    return sorted(r.log_id for r in read_log_table(spark, path).select("log_id").collect())


def test_many_batches_become_few_files(spark, tmp_path):
    path = str(tmp_path / "logs")
    batches(spark, path, 30)
    whole = ids(spark, path)
    assert len(whole) == 1200 and len(live_folders(spark, path)) == 30
    main(["compact-logs", "--logs", path])
    assert ids(spark, path) == whole
    # One folder a month, and the last batch, which its stream may write again.
    assert len(live_folders(spark, path)) == 3 and len(folders(spark, path)) == 32
    # A batch that is written again, replaced or not, changes nothing.
    for batch in (3, 29):
        write_logs(logs(spark, 40, start=f"2024-0{1 + batch % 2}-0{1 + batch % 9}").withColumn("log_id", F.col("log_id") + 1000 * batch), path, batch, "q", 40)
    assert ids(spark, path) == whole
    batches(spark, path, 4, "r")
    more = ids(spark, path)
    assert len(more) == 1360
    main(["compact-logs", "--logs", path, "--month", "202401", "--vacuum"])
    assert ids(spark, path) == more
    vacuum(spark, path)
    assert ids(spark, path) == more and folders(spark, path) == live_folders(spark, path)
    assert not read_manifest(spark, path).replaced
    expire_logs(spark, path, dt.date(2024, 4, 30), 85)  # keeps February from its fifth day
    left = read_log_table(spark, path).select(F.min("date"), F.count("*")).first()
    assert left[0] == dt.date(2024, 2, 5) and 0 < left[1] < len(more)


@pytest.mark.parametrize("step", ["write", "before", "after"])
def test_a_crash_leaves_every_row_once(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "logs")
    batches(spark, path, 5)
    whole = ids(spark, path)

    def die(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost"):
        if step == "write":
            m.setattr(tables, "clustered", die)
        elif step == "before":
            m.setattr(tables, "switch", die)
        else:
            m.setattr(tables, "commit", lambda *a: (commit(*a), die()))
        compact_logs(spark, path)
    assert ids(spark, path) == whole
    compact_logs(spark, path)
    assert ids(spark, path) == whole
    vacuum(spark, path, abandoned=True)
    assert ids(spark, path) == whole and folders(spark, path) == live_folders(spark, path)


def test_two_compactions_at_once(spark, tmp_path):
    path = str(tmp_path / "logs")
    batches(spark, path, 4)
    month = live_folders(spark, path, "202401")
    switch(spark, path, month, "yyyymm=202401/run=compact-a/batch_id=0")
    with pytest.raises(Conflict):
        switch(spark, path, month, "yyyymm=202401/run=compact-b/batch_id=0")
    with pytest.raises(Conflict):
        commit(spark, path, Manifest(1, frozenset(), frozenset()))
    assert read_manifest(spark, path).version == 1
    assert [f for f in os.listdir(f"{path}/_manifest") if f.endswith(".json")] == ["000000000001.json"]
