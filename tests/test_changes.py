"""The dimension that a feed of changes keeps up to date."""

from __future__ import annotations

import json
import os
import shutil

import pytest

from logsieve.jobs import main
from logsieve.operators.enrich import classify, enrich
from logsieve.operators.events import parse_events
from logsieve.sources.changes import ToolDimension
from logsieve.streaming.enrichment import Outputs, process_batch, start_enrichment

SCHEMA = "id long, name string, url string, has_ai string, score double, updated_at string, deleted boolean"


def changes(spark, *rows):
    return spark.createDataFrame([(i, n, u, ai, 1.0, f"2024-01-01 00:00:{at:02d}", gone) for i, n, u, ai, at, gone in rows], SCHEMA)


def events(spark, *hosts):
    return spark.createDataFrame([(json.dumps({"logid": str(i), "dstname": h}),) for i, h in enumerate(hosts)], "value string")


def reasons(spark, tools, *hosts):
    rows = classify(parse_events(events(spark, *hosts)), tools).select("tool_url", "reason", "tool_name").collect()
    return {r.tool_url: (r.reason, r.tool_name) for r in rows}


def test_insert_change_delete_and_flip(spark, tmp_path):
    dimension = ToolDimension(spark, str(tmp_path / "dim"))
    assert dimension.version() == 0 and dimension.tools().count() == 0
    assert reasons(spark, dimension.current(), "a.ai") == {"a.ai": ("no_match", None)}
    dimension.apply(changes(spark, (1, "A", " A.ai", "true", 1, None), (2, "B", "b.ai", "yes", 1, False), (3, "C", "c.com", "no", 1, False)), 0)
    assert reasons(spark, dimension.current(), "a.ai", "b.ai", "c.com") == {"a.ai": ("kept", "A"), "b.ai": ("kept", "B"), "c.com": ("not_ai", "C")}
    # B is renamed twice and flips, the last time counts; A moves to another url; C goes; D comes.
    version = dimension.apply(
        changes(spark, (2, "B2", "b.ai", "true", 2, False), (2, "B3", "b.ai", "false", 3, False), (1, "A", "new.ai", "true", 2, False), (3, "C", "c.com", "no", 2, True), (4, "D", "d.ai", "1", 2, None)), 1
    )
    want = {"a.ai": ("no_match", None), "new.ai": ("kept", "A"), "b.ai": ("not_ai", "B3"), "c.com": ("no_match", None), "d.ai": ("kept", "D")}
    assert version == 2 and reasons(spark, dimension.current(), *want) == want
    # The same batch again, and changes that are older than the state, also than a deletion.
    assert dimension.apply(changes(spark, (1, "x", "x.ai", "true", 9, False)), 1) == 2
    dimension.apply(changes(spark, (2, "old", "b.ai", "true", 1, False), (3, "old", "c.com", "true", 1, False)), 2)
    assert reasons(spark, dimension.current(), *want) == want
    # Another reader, from the files alone, and the plain frame with the batch operator.
    assert reasons(spark, ToolDimension(spark, str(tmp_path / "dim")).current(), *want) == want
    kept = enrich(parse_events(events(spark, *want)), dimension.tools()).collect()
    assert {r.tool_url for r in kept} == {u for u, (reason, _) in want.items() if reason == "kept"}


def test_an_unchanged_version_is_not_read_again(spark, tmp_path):
    path = str(tmp_path / "dim")
    dimension = ToolDimension(spark, path)
    dimension.apply(changes(spark, (1, "A", "a.ai", "true", 1, None)), 0)
    first = dimension.current()
    for folder in os.listdir(path):
        if folder.startswith("v"):
            shutil.rmtree(f"{path}/{folder}")  # what is not read cannot be missed
    dimension.apply(changes(spark, (9, "Z", "z.ai", "true", 1, None)).limit(0), 1)
    assert dimension.version() == 2 and dimension.current() is first
    outputs = Outputs.under(str(tmp_path / "out"))
    process_batch(events(spark, "a.ai", "b.ai"), 0, dimension.current(), outputs)
    assert spark.read.parquet(outputs.logs).count() == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|FILE_NOT_EXIST"):
        ToolDimension(spark, path).current()


def test_tools_without_ids_and_large_lookups(spark, tmp_path):
    dimension = ToolDimension(spark, str(tmp_path / "dim"))
    dimension.apply(changes(spark, (None, "A", "a.ai", "true", 1, None), (None, "B", "b.ai", "true", 1, None), (None, None, None, None, 1, None)))
    dimension.apply(changes(spark, (None, "A2", "A.ai", "true", 2, None)))
    assert sorted((r.name, r.url) for r in dimension.tools().collect()) == [("A2", "A.ai"), ("B", "b.ai")]
    prepared = dimension.current()
    apart = type(prepared)(prepared.by_key, False)
    assert reasons(spark, apart, "a.ai", "x") == reasons(spark, prepared, "a.ai", "x") == {"a.ai": ("kept", "A2"), "x": ("no_match", None)}


def test_streams_of_changes_and_messages(spark, tmp_path):
    feed, inbox = tmp_path / "feed", tmp_path / "in"
    feed.mkdir()
    inbox.mkdir()
    dimension, outputs = ToolDimension(spark, str(tmp_path / "dim")), Outputs.under(str(tmp_path / "out"))

    def follow(n, *rows):
        lines = [json.dumps(dict(zip(("id", "name", "url", "has_ai", "updated_at", "deleted"), r))) for r in rows]
        (feed / f"{n}.json").write_text("\n".join(lines))
        stream = spark.readStream.schema(SCHEMA).json(str(feed))
        dimension.follow(stream, str(tmp_path / "cp-feed"), drain=True).awaitTermination(120)

    def run(n, *hosts):
        (inbox / f"{n}.txt").write_text("\n".join(json.dumps({"logid": str(n), "dstname": h}) for h in hosts) + "\n{bad\n")
        start_enrichment(spark.readStream.text(str(inbox)), dimension.current, outputs, str(tmp_path / "cp"), drain=True).awaitTermination(120)

    follow(0, (1, "A", "a.ai", "true", "2024-01-01 00:00:01", False))
    run(1, "a.ai", "b.ai")
    follow(1, (1, "A", "a.ai", "true", "2024-01-01 00:00:02", True), (2, "B", "b.ai", "true", "2024-01-01 00:00:02", False))
    run(2, "a.ai", "b.ai", "")
    got = sorted((int(r.log_id), r.tool_name) for r in spark.read.parquet(outputs.logs).collect())
    assert got == [(1, "A"), (2, "B")]
    books = spark.read.parquet(outputs.metrics).select("read", "kept", "rejected", "dropped").collect()
    assert sorted(map(tuple, books)) == [(3, 1, 1, 1), (4, 1, 1, 2)]


def test_books_of_an_empty_batch(spark, tmp_path):
    outputs = Outputs.under(str(tmp_path / "out"))
    dimension = ToolDimension(spark, str(tmp_path / "dim"))
    process_batch(events(spark, "x").limit(0), 0, dimension.current(), outputs)
    assert [tuple(r) for r in spark.read.parquet(outputs.metrics).select("read", "kept", "rejected", "dropped").collect()] == [(0, 0, 0, 0)]


def test_the_jobs(spark, tmp_path):
    feed, state, inbox, out = (tmp_path / n for n in ("feed", "state", "in", "out"))
    feed.mkdir()
    inbox.mkdir()
    (feed / "0.json").write_text('{"id": 1, "name": "A", "url": "a.ai", "has_ai": "true", "updated_at": "2024-01-01T00:00:00Z"}\n')
    (inbox / "0.txt").write_text(json.dumps({"logid": "5", "dstname": "a.ai", "eventtime": "2024-01-01T00:00:00Z"}) + "\n")
    main(["follow-tools", "--changes", str(feed), "--state", str(state), "--checkpoint", str(tmp_path / "cp1"), "--drain"])
    main(["enrich", "--messages", str(inbox), "--tools-state", str(state), "--output", str(out), "--checkpoint", str(tmp_path / "cp2"), "--drain"])
    assert [(int(r.log_id), r.tool_name) for r in spark.read.parquet(f"{out}/logs").collect()] == [(5, "A")]
    assert spark.read.parquet(f"{out}/tools").count() == 1
