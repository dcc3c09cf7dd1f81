"""Units that are acknowledged are not sent again."""

from __future__ import annotations

import json
import os
import uuid
from collections import Counter

import pytest

from logsieve.jobs import ingest
from logsieve.sinks.acknowledged import TaskWriter, publish_units, with_unit
from logsieve.sinks.deadletters import read_dead_letters


def spool(folder, broken, failures):
    """A client that writes what it sends to files of its own, and fails on one message so many times."""

    def open_sender():
        def send(values):
            for v in values:
                if broken in v and len([f for f in os.listdir(folder) if f.startswith("failed")]) < failures:
                    open(f"{folder}/failed-{uuid.uuid4().hex}", "w").close()
                    raise OSError("broker is away")
            with open(f"{folder}/sent-{uuid.uuid4().hex}", "w") as f:
                f.write("\n".join(values))

        return send

    return open_sender


def sent(folder):
    lines = [x for f in os.listdir(folder) if f.startswith("sent") for x in open(f"{folder}/{f}").read().split("\n")]
    return Counter(lines)


@pytest.mark.parametrize("failures", [0, 2, 99])
def test_one_broken_task_of_eight(spark, tmp_path, failures):
    folder, path, dead = tmp_path / "out", str(tmp_path / "staged"), str(tmp_path / "dead")
    folder.mkdir()
    spark.range(0, 80, 1, 8).selectExpr("concat('m', id) AS value").write.parquet(path)
    units = with_unit(spark.read.parquet(path))
    assert units.select("unit").distinct().count() == 8
    done = publish_units(units, TaskWriter(spool(str(folder), "m37", failures), 4), dead, backoff=0.01)
    got = sent(str(folder))
    unit = {f"m{i}" for i in range(30, 40)}
    others = {f"m{i}" for i in range(80)} - unit
    assert {m: got[m] for m in others} == dict.fromkeys(others, 1)
    if failures < 99:
        assert (done.published, done.failed, done.attempts) == (80, 0, 1 + failures) and unit <= set(got)
        assert not os.path.exists(dead)
    else:
        assert (done.published, done.failed, done.attempts) == (70, 10, 3)
        assert {r.raw for r in read_dead_letters(spark, dead).collect()} == unit


def test_ingest_with_a_task_writer(spark, tmp_path):
    folder, source, dead = tmp_path / "out", tmp_path / "in", str(tmp_path / "dead")
    folder.mkdir()
    source.mkdir()
    for name in "abcdef":
        (source / f"{name}.csv").write_text(f'k,n\n{name},"1\n2"\n{name},2\nshort\n')
    for _ in range(2):  # repeated, it replaces its own dead letters
        done = ingest(spark, str(source), TaskWriter(spool(str(folder), '"c"', 99)), dead, kind="csv")
        assert (done.processed, done.failed, done.published + done.publish_failed) == (18, 6, 12)
        letters = [(r.error, r.raw) for r in read_dead_letters(spark, dead).collect()]
        assert sorted(e for e, _ in letters) == ["malformed_row"] * 6 + ["publish_failed"] * done.publish_failed
        assert 2 <= done.publish_failed <= 12 and sum('"c"' in raw for _, raw in letters) == 2
    assert all(json.loads(m)["k"] != "c" for m in sent(str(folder)))


def test_no_messages(spark, tmp_path):
    path = str(tmp_path / "staged")
    spark.sql("SELECT CAST(NULL AS string) AS value").write.parquet(path)
    done = publish_units(with_unit(spark.read.parquet(path)), TaskWriter(spool(str(tmp_path), "x", 0)), str(tmp_path / "dead"))
    assert (done.published, done.failed, done.attempts) == (0, 0, 1)
