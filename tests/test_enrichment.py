"""Lookup, join strategies, projection, streaming and table upkeep."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from logsieve.functions.records import row_to_map
from logsieve.operators import lookup, maintain
from logsieve.operators.cef import cef_json, cef_records, parse_cef
from logsieve.operators.enrich import classify, drop_audit, enrich, with_lookup_key
from logsieve.operators.events import parse_events, parse_json_map
from logsieve.operators.metrics import reconcile
from logsieve.operators.projection import log_projection, violations
from logsieve.plans import inputs
from logsieve.plans.queries import all_queries
from logsieve.schema import CEF_URL_KEYS, LOG_COLUMNS, URL_KEYS
from logsieve.sinks.deadletters import read_dead_letters
from logsieve.jobs import main
from logsieve.operators.metrics import observe_books, window_counts
from logsieve.sinks.tables import expire_logs, sync_tools, write_logs
from logsieve.sources.kafka import TopicOptions
from logsieve.sources.tools import tools_loader
from logsieve.streaming.enrichment import (
    Outputs,
    process_batch,
    read_window_counts,
    start_enrichment,
    start_window_counts,
)

SF_DIR = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(str, df.collect()))


def _plan(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture(scope="module")
def tools(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [
        (1, "chat", " Chat.AI ", "true", "text", 9.5, "low", at),
        (2, "old", "dup.ai", "true", None, None, None, at),
        (3, "new", "DUP.ai", "no", None, None, None, at + dt.timedelta(days=1)),
        (4, "tie", "tie.ai", "no", None, 1.0, None, at),
        (5, "tie", "tie.ai", "1", None, 2.0, None, at),
        (6, "blank", "  ", "true", None, None, None, at),
        (7, None, None, "true", None, None, None, at),
        (8, "plain", "plain.com", None, None, None, None, at),
    ]
    schema = "id long, name string, url string, has_ai string, ai_category string, score double, risk string, updated_at timestamp"
    return spark.createDataFrame(rows, schema)


def test_latest_tool_of_each_key(tools):
    found = {r.key: (r.id, r.has_ai, r.score) for r in lookup.tools_by_key(tools).collect()}
    assert found == {
        "chat.ai": (1, True, 9.5), "dup.ai": (3, False, 0.0), "tie.ai": (5, True, 2.0),
        "plain.com": (8, False, 0.0),
    }


MESSAGES = [
    ({"dstname": " CHAT.ai ", "url": "x"}, " CHAT.ai ", "kept"),
    ({"dstname": "", "url": "tie.ai"}, "tie.ai", "kept"),
    ({"URL": "Dup.AI"}, "Dup.AI", "not_ai"),
    ({"hostname": "plain.com"}, "plain.com", "not_ai"),
    ({"tool_url": "nowhere"}, "nowhere", "no_match"),
    ({"dstName": "chat.ai"}, "", "no_url"),
    ({"dstname": "   ", "url": "chat.ai"}, "   ", "no_url"),
    ({"dst": "chat.ai"}, "", "no_url"),
]


def _events(spark):
    values = [(json.dumps(m),) for m, _, _ in MESSAGES] + [("{bad",)]
    return parse_events(spark.createDataFrame(values, "value string"))


def test_every_event_gets_its_reason(spark, tools):
    got = {r.value: (r.tool_url, r.reason) for r in classify(_events(spark), tools).collect()}
    assert got == {**{json.dumps(m): (u, r) for m, u, r in MESSAGES}, "{bad": ("", "bad_json")}
    audit = {r.reason: r.n for r in drop_audit(classify(_events(spark), tools)).collect()}
    assert audit == {"kept": 2, "not_ai": 2, "no_match": 1, "no_url": 3, "bad_json": 1}
    assert tuple(reconcile(classify(_events(spark), tools)).first()) == (9, 2, 1, 6)
    assert _rows(enrich(_events(spark), tools).select("tool_id", "tool_url")) == _rows(
        classify(_events(spark), tools).filter("reason = 'kept'").select("tool_id", "tool_url")
    )


def test_maps_and_structs_give_the_same_keys(spark):
    messages = inputs.keyed_messages(spark, SF_DIR)
    by_map = with_lookup_key(parse_json_map(messages)).select("event_id", "key")
    assert _rows(by_map) == _rows(with_lookup_key(parse_events(messages)).select("event_id", "key"))


def test_csv_records_enrich_without_messages(spark, tools):
    frame = spark.createDataFrame([("7", "chat.ai")], "logid string, dstname string")
    events = frame.select(row_to_map(frame.columns, [F.col(c) for c in frame.columns]).alias("event"))
    row = log_projection(enrich(events, tools)).first()
    assert (int(row.log_id), row.tool_id, row.dstname) == (7, 1, "chat.ai")


def test_cef_events_can_be_looked_up(spark, tools):
    line = "CEF:0|V|P|1|2|N|7|src=1.1.1.1 dst=9.9.9.9 dhost=chat.ai"
    records = cef_records(parse_cef(spark.createDataFrame([(line,)], "value string")), extensions=("dhost",))
    messages = records.select(cef_json(records).alias("value"))
    assert enrich(parse_events(messages), tools).count() == 0
    keys = URL_KEYS + CEF_URL_KEYS
    assert enrich(parse_events(messages, extra_keys=CEF_URL_KEYS), tools, keys).first().tool_id == 1


@pytest.mark.parametrize("operator", [enrich, classify])
def test_large_lookup_gives_the_same_rows(spark, monkeypatch, operator):
    events = parse_events(inputs.log_messages(spark, SF_DIR, broken_every=9))
    dimension = inputs.tools_with_duplicates(spark, SF_DIR)
    small = operator(events, dimension).drop("event")
    monkeypatch.setattr(lookup, "MAX_BROADCAST_ROWS", 0)
    large = operator(events, dimension).drop("event")
    plan = _plan(large).split("== Physical Plan ==")[1]
    assert "SortMergeJoin" in plan and plan.count("from_json(ArrayType") == 1  # one pass over the events
    assert _rows(large) == _rows(small)


def test_a_hot_key_is_dealt_to_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(lookup, "MAX_BROADCAST_ROWS", 0)
    events = spark.range(0, 9000, 1, 4).selectExpr("if(id % 3 = 0, 'hot', concat('k', id)) key", "id")
    dimension = spark.range(9000).selectExpr("concat('k', id) key", "id tool").union(spark.sql("SELECT 'hot', -1L"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = lookup.lookup_join(events, dimension).withColumn("task", F.spark_partition_id())
        hot = rows.filter("key = 'hot'").groupBy("task").count().collect()
        assert rows.count() == 9000 and sum(r["count"] for r in hot) == 3000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(hot) >= 4 and max(r["count"] for r in hot) < 1500


def test_flagship_plan(spark):
    plan = _plan(all_queries()["enrich_ai_tools"](spark, SF_DIR))
    physical = plan[plan.index("== Physical Plan =="):]
    assert "BroadcastHashJoin" in physical and "SortMergeJoin" not in physical
    # Read as an array, every message is parsed once; the guard for odd text is a map.
    assert physical.count("from_json(ArrayType") == 1


def test_no_query_runs_python_per_row(spark):
    for name, query in all_queries().items():
        plan = _plan(query(spark, SF_DIR))
        assert not any(p in plan for p in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas")), name


def test_projection_defaults_and_fallback(spark, tools):
    event = {"dstname": "chat.ai", "logid": str(2**64 - 1), "eventtime": "nope", "proto": "256", "srcip": "x"}
    enriched = enrich(parse_events(spark.createDataFrame([(json.dumps(event),)], "value string")), tools)
    logs = log_projection(enriched)
    assert logs.columns == [c.name for c in LOG_COLUMNS] and len(logs.columns) == 43
    row = logs.first()
    assert (int(row.log_id), row.proto, row.srcip, row.type) == (2**64 - 1, 0, "0.0.0.0", "")
    assert (row.date, row.eventtime, row.time) == (None, None, None)
    assert row.tool_score == 9.5
    now = log_projection(enriched, fallback="now").first()
    assert now.date is not None and now.eventtime is not None and len(now.time) == 8
    assert {(r.column, r.raw, r.rule) for r in violations(enriched).collect()} == {
        ("eventtime", "nope", "bad_time"), ("proto", "256", "out_of_range"), ("srcip", "x", "not_ipv4"),
    }


def _write_messages(folder, name, messages):
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(messages) + "\n")


def _message(i, host="chat.ai"):
    return json.dumps({"logid": str(i), "eventtime": f"2024-0{1 + i % 2}-01T00:00:00Z", "dstname": host})


@pytest.fixture
def stream(spark, tools, tmp_path):
    source, dimension = tmp_path / "in", str(tmp_path / "tools")
    os.makedirs(source)
    tools.write.parquet(dimension)
    for n in range(2):
        _write_messages(source, f"{n}.txt", [_message(n * 5 + i) for i in range(5)] + ["{bad"])
    outputs = Outputs.under(str(tmp_path / "out"))

    def run():
        lines = spark.readStream.option("maxFilesPerTrigger", 1).text(str(source))
        query = start_enrichment(
            lines, tools_loader(spark, dimension), outputs, str(tmp_path / "cp"), drain=True
        )
        query.awaitTermination(120)
        assert query.exception() is None

    return run, source, dimension, outputs


def test_stream_equals_batch_and_resumes(spark, tools, stream):
    run, source, dimension, outputs = stream
    run()
    logs = spark.read.parquet(outputs.logs)
    columns = [c.name for c in LOG_COLUMNS]
    batch = log_projection(enrich(parse_events(spark.read.text(str(source))), tools))
    assert _rows(logs.select(columns)) == _rows(batch.select(columns))
    assert logs.select("batch_id").distinct().count() == 2
    assert sorted(r.yyyymm for r in logs.select("yyyymm").distinct().collect()) == [202401, 202402]
    assert [r.raw for r in read_dead_letters(spark, outputs.dead_letters).collect()] == ["{bad"] * 2
    metrics = spark.read.parquet(outputs.metrics)
    assert sorted(map(tuple, metrics.select("read", "kept", "rejected", "dropped").collect())) == [(6, 5, 1, 0)] * 2
    assert spark.read.parquet(outputs.violations).count() == 0

    run()
    assert spark.read.parquet(outputs.logs).count() == 10
    # The dimension is read again for each batch: a new tool counts from the next one on.
    spark.createDataFrame([(99, "new.ai", "true")], "id long, url string, has_ai string").write.mode(
        "append"
    ).parquet(dimension)
    _write_messages(source, "2.txt", [_message(100, "new.ai")])
    run()
    assert spark.read.parquet(outputs.logs).filter("tool_id = 99").count() == 1


def test_a_replayed_batch_replaces_itself(spark, tools, tmp_path):
    outputs = Outputs.under(str(tmp_path / "out"))
    messages = spark.createDataFrame([(_message(i),) for i in range(4)] + [("3",)], "value string")
    for _ in range(2):
        process_batch(messages, 0, tools, outputs)
    assert spark.read.parquet(outputs.logs).count() == 4
    assert read_dead_letters(spark, outputs.dead_letters).count() == 1
    assert spark.read.parquet(outputs.metrics).count() == 1


def test_stream_checkpoint_defaults_to_the_shared_folder(spark):
    from logsieve import checkpoint_location

    shared = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_location(spark, "x") == f"{shared}/x"
    assert checkpoint_location(spark, "x", "/own") == "/own"


def test_streaming_windows(spark, tmp_path):
    path = str(tmp_path / "events")
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").select("event_id", "ts")
    events.write.parquet(path)
    out = str(tmp_path / "counts")

    def run():
        lines = spark.readStream.schema(events.schema).parquet(path)
        start_window_counts(lines, "ts", out, str(tmp_path / "cp"), drain=True).awaitTermination(120)

    run()
    late = events.orderBy("ts").limit(3)  # as late as can be, and counted all the same
    late.write.mode("append").parquet(path)
    run()
    whole = spark.read.parquet(path)
    assert _rows(read_window_counts(spark, out)) == _rows(window_counts(whole, "ts"))


def test_topic_options():
    options = TopicOptions("b:1", "t", group_id="g", max_per_batch=5)
    assert options.reader_options() == {
        "kafka.bootstrap.servers": "b:1", "subscribe": "t", "startingOffsets": "latest",
        "kafka.group.id": "g", "maxOffsetsPerTrigger": "5",
    }
    assert options.writer_options() == {"kafka.bootstrap.servers": "b:1", "topic": "t"}


def test_logs_are_laid_out_by_month_and_sorted(spark, tmp_path):
    events = parse_events(inputs.log_messages(spark, SF_DIR))
    path = str(tmp_path / "logs")
    write_logs(log_projection(enrich(events, inputs.tools(spark, SF_DIR))), path)
    logs = spark.read.parquet(path)
    assert logs.columns[-4:] == ["_inserted_at", "yyyymm", "run", "batch_id"]
    order = logs.select("date", "eventtime", "tool_id", "srcip", F.col("_metadata.file_path").alias("f"))
    by_file = {}
    for r in order.withColumn("at", F.monotonically_increasing_id()).orderBy("at").collect():
        by_file.setdefault(r.f, []).append(tuple(r)[:4])
    assert all(rows == sorted(rows) for rows in by_file.values())
    plan = _plan(logs.filter("yyyymm = 202401"))
    assert "PartitionFilters: [isnotnull(yyyymm" in plan


def test_two_streams_and_a_batch_share_a_table(spark, tools, tmp_path):
    """Batch numbers start again with each checkpoint, yet no rows are lost."""
    dimension, outputs = str(tmp_path / "tools"), Outputs.under(str(tmp_path / "out"))
    tools.write.parquet(dimension)
    for n in range(2):
        source = tmp_path / f"in{n}"
        os.makedirs(source)
        _write_messages(source, "0.txt", [_message(10 * n + i) for i in range(3)] + ["{bad"])
        start_enrichment(
            spark.readStream.text(str(source)), tools_loader(spark, dimension), outputs, str(tmp_path / f"cp{n}"), drain=True
        ).awaitTermination(120)
    more = parse_events(spark.createDataFrame([(_message(99),)], "value string"))
    for _ in range(2):
        write_logs(log_projection(enrich(more, tools)), outputs.logs)
    logs = spark.read.parquet(outputs.logs)
    assert sorted(int(r.log_id) for r in logs.collect()) == [0, 1, 2, 10, 11, 12, 99, 99]
    assert read_dead_letters(spark, outputs.dead_letters).count() == 2
    assert spark.read.parquet(outputs.metrics).count() == 2
    assert "PartitionFilters: [isnotnull(yyyymm" in _plan(logs.filter("yyyymm = 202401"))


def test_micro_batches_are_not_shuffled_before_they_are_parsed(spark, tools, tmp_path, monkeypatch):
    from logsieve.streaming import enrichment

    plans = []
    monkeypatch.setattr(enrichment, "observe_books", lambda batch: plans.append(_plan(batch)) or observe_books(batch))
    messages = spark.createDataFrame([(_message(i),) for i in range(4)], "value string")
    process_batch(messages, 0, tools, Outputs.under(str(tmp_path / "out")))
    assert "RoundRobin" not in plans[0]


def test_expired_rows_are_deleted(spark, tmp_path):
    path, as_of = str(tmp_path / "logs"), dt.date(2024, 6, 15)  # the horizon is 2024-03-17
    days = [dt.date(2024, 1, 5), dt.date(2024, 3, 16), dt.date(2024, 3, 17), dt.date(2024, 6, 1), None]
    rows = [(d, None, i, "x") for i, d in enumerate(days)]
    schema = "date date, eventtime timestamp, tool_id long, srcip string"
    for batch_id, chosen in ((0, rows), (1, rows[2:4]), (2, rows[1:2])):
        write_logs(spark.createDataFrame(chosen, schema), path, batch_id, "q")
    kept = sorted((r.tool_id, r.batch_id) for r in spark.read.parquet(path).filter("tool_id in (2, 3, 4)").collect())
    main(["expire", "--logs", path, "--as-of", "2024-06-15"])
    # The row without a date was inserted just now, after the horizon.
    assert sorted((r.tool_id, r.batch_id) for r in spark.read.parquet(path).collect()) == kept
    assert not os.path.exists(f"{path}/yyyymm=202401") and expire_logs(spark, path, as_of) == []
    far = dt.date(2200, 1, 1)
    expire_logs(spark, path, far)
    assert spark.read.schema("tool_id long").parquet(path).count() == 0


def test_retention_keeps_the_boundary_day(spark):
    as_of = dt.date(2024, 4, 1)
    days = [as_of - dt.timedelta(days=n) for n in (91, 90, 89)] + [None]
    logs = spark.createDataFrame([(d,) for d in days], "date date").withColumn(
        "yyyymm", maintain.month_of(F.col("date"))
    )
    assert {r.date for r in maintain.retained(logs, as_of).collect()} == {*days[1:]}
    assert [r.yyyymm for r in maintain.expired_months(logs, as_of).collect()] == [202312] * (days[0].month == 12)


def test_synced_tools_keep_their_latest_version(spark, tools, tmp_path):
    path = str(tmp_path / "tools")
    sync_tools(tools, path)
    newer = tools.filter("id = 1").withColumn("name", F.lit("renamed")).withColumn(
        "updated_at", F.lit("2024-05-01").cast("timestamp")
    )
    sync_tools(newer, path)
    latest = maintain.latest_tools(spark.read.parquet(path))
    assert latest.filter("tool_id = 1").first().name == "renamed"
    assert latest.count() == 6 and spark.read.parquet(path).count() == 7


def test_tools_source_must_have_the_essentials(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1, "x")], "id long, url string").write.parquet(path)
    with pytest.raises(ValueError, match="has_ai"):
        tools_loader(spark, path)()
