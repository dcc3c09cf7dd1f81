"""Files in and out: routing, line numbers, CSV dialect, the ingest job."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from logsieve.jobs import ingest
from logsieve.operators.cef import cef_rejects, parse_cef
from logsieve.operators.metrics import header_report, observe_parse
from logsieve.sinks.deadletters import read_dead_letters
from logsieve.sinks.messages import publish, text_writer
from logsieve.sinks.tables import write_converted
from logsieve.sources import lines as line_source
from logsieve.sources.files import bad_rows, good_rows, messages, read_csv, read_logs, records, route

EDGES = 'Dst Name,url,n\nx.com,u1,007\nshort,u2\nlong,u3,1,extra\n"a ""q"" b",,1.50\n\n  lead, u5 ,3\nbad"q,u6,2\n'
TWINS = "a,b,a,url,URL,x.y\n1,2,3,u,U,z\n4,5,,u2,,\nshort\n"


def _file(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", newline="", encoding="utf8") as f:
        f.write(text)
    return path


def test_routes():
    names = ["a.log", "a.CEF", "b.Csv", "d.e.parquet", "/x.log/part.csv", ".csv", "out.parquet/"]
    assert [route(n) for n in names] == ["cef", "cef", "csv", "parquet", "csv", "csv", "parquet"]
    for name in ("a.txt", "noextension", "/a.log/b"):
        with pytest.raises(ValueError, match=r"supported: \.log, \.cef, \.csv, \.parquet"):
            route(name)


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_logs(spark, str(tmp_path / "none.log"))


def test_line_numbers_in_split_files(spark, tmp_path):
    rng = random.Random(3)
    expected = {}
    for name in ("one.log", "two.log"):
        rows = [f"{name} {i} " + "x" * rng.randint(0, 60) for i in range(4000)]
        rows[17], rows[18] = "", "carriage return\r in the middle"
        _file(tmp_path, name, "\r\n".join(rows) + ("\n" if name == "one.log" else ""))
        expected.update({(name, i + 1): r for i, r in enumerate(rows)})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = line_source.read_lines(spark, str(tmp_path / "*.log"))
        assert lines.rdd.getNumPartitions() > 10
        numbered = line_source.with_line_numbers(lines, line_source.block_offsets(lines)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert {(os.path.basename(r.file), r.line): r.value for r in numbered} == expected


def test_changed_splits_are_an_error(spark, tmp_path):
    path = _file(tmp_path, "a.log", "\n".join("x" * 50 for _ in range(2000)))
    lines = line_source.read_lines(spark, path)
    offsets = spark.createDataFrame(
        line_source.block_offsets(lines).withColumn("n", F.col("n") - 1).collect()
    )
    with pytest.raises(Exception, match="splits changed"):
        line_source.with_line_numbers(lines, offsets).collect()


def test_line_numbers_without_a_broadcast(spark, tmp_path, monkeypatch):
    path = _file(tmp_path, "a.log", "\n".join(f"bad {i}" for i in range(500)))
    monkeypatch.setattr(line_source, "fits_broadcast", lambda df: False)
    lines = line_source.read_lines(spark, path)
    rejects = cef_rejects(parse_cef(lines)).filter(F.col("value").endswith("7"))
    rows = line_source.with_line_numbers(rejects, line_source.block_offsets(lines)).collect()
    assert {r.line for r in rows} == {i + 1 for i in range(500) if i % 10 == 7}


def test_csv_edges(spark, tmp_path):
    rows = read_csv(spark, _file(tmp_path, "a.csv", EDGES))
    assert rows.headers == ["Dst Name", "url", "n"]
    assert [r.event for r in records(rows).collect()] == [
        {"Dst Name": "x.com", "url": "u1", "n": "007"},
        {"Dst Name": 'a "q" b', "n": "1.50"},
        {"Dst Name": "  lead", "url": " u5 ", "n": "3"},
        {"Dst Name": 'bad"q', "url": "u6", "n": "2"},
    ]
    assert [r.value for r in bad_rows(rows).collect()] == ["short,u2", "long,u3,1,extra"]
    assert (records(rows).count(), bad_rows(rows).count(), rows.df.count()) == (4, 2, 6)
    # Asking for one column must not change which rows are good.
    assert [r.url for r in good_rows(rows).df.select("url").collect()] == ["u1", None, " u5 ", "u6"]
    assert good_rows(rows).df.count() == 4
    lenient = records(read_csv(spark, str(tmp_path / "a.csv"), lenient=True)).collect()
    assert lenient[2].event == {"Dst Name": "lead", "url": "u5 ", "n": "3"}


def test_csv_twin_headers(spark, tmp_path):
    rows = read_csv(spark, _file(tmp_path, "b.csv", TWINS))
    assert [r.event for r in records(rows).collect()] == [
        {"a": "3", "b": "2", "url": "u", "URL": "U", "x.y": "z"},
        {"a": "4", "b": "5", "url": "u2"},
    ]
    assert [json.loads(r.value) for r in messages(rows).collect()][1] == {"a": "4", "b": "5", "url": "u2"}
    assert [r.value for r in bad_rows(rows).collect()] == ["short"]
    report = [tuple(r) for r in header_report(rows).orderBy("pos").collect()]
    assert report[5] == (6, "x.y", "xy", 1)


def test_each_file_has_its_own_header(spark, tmp_path):
    _file(tmp_path, "a.csv", "x,y\n1,2\n")
    _file(tmp_path, "b.csv", "y,x\n3,4\n")
    _file(tmp_path, "c.csv", "URL,url,x\nU,u,5\nshort\n")
    _file(tmp_path, "d.csv", "x,y\n6,7\n")
    _file(tmp_path, "e.csv", '"two\nlines",y\n8,9\n')
    _file(tmp_path, "f.csv", "")
    rows = read_csv(spark, str(tmp_path))
    got = sorted(json.dumps(r.event, sort_keys=True) for r in records(rows).collect())
    want = [{"x": "1", "y": "2"}, {"y": "3", "x": "4"}, {"URL": "U", "url": "u", "x": "5"}, {"x": "6", "y": "7"}, {"two\nlines": "8", "y": "9"}]
    assert got == sorted(json.dumps(w, sort_keys=True) for w in want)
    assert len(rows.parts()) == 4 and [r.value for r in bad_rows(rows).collect()] == ["short"]


def test_line_breaks_in_quotes(spark, tmp_path):
    text = 'dstname,url,n\n"two\nlines",u,2\nx,"a ""q"" b",3\n"3\nmore\nlines",u,4\n'
    path = _file(tmp_path, "m.csv", text)
    events = [r.event for r in records(read_csv(spark, path)).collect()]
    assert events == [
        {"dstname": "two\nlines", "url": "u", "n": "2"},
        {"dstname": "x", "url": 'a "q" b', "n": "3"},
        {"dstname": "3\nmore\nlines", "url": "u", "n": "4"},
    ]
    split = read_csv(spark, path, multiline=False)
    assert [r.event for r in records(split).collect()] == [events[1]]
    assert [r.value for r in bad_rows(split).collect()] == ['"two', 'lines",u,2', '"3', "more", 'lines",u,4']


def test_parquet_folders_keep_every_value(spark, tmp_path):
    one, two, three = (str(tmp_path / n) for n in ("one", "two", "three"))
    spark.sql("SELECT 'a' url, 1 n").coalesce(1).write.parquet(one)
    spark.sql("SELECT 'b' url, 'deny' action").coalesce(1).write.mode("append").parquet(one)
    assert {tuple(sorted(r.event.items())) for r in records(read_logs(spark, one, "parquet")).collect()} == {
        (("n", "1"), ("url", "a")), (("action", "deny"), ("url", "b")),
    }
    spark.sql("SELECT 'a' url, 1 n").coalesce(1).write.parquet(two)
    spark.sql("SELECT 'b' url, array('x') n").coalesce(1).write.mode("append").parquet(two)
    assert {tuple(sorted(r.event.items())) for r in records(read_logs(spark, two, "parquet")).collect()} == {
        (("n", "1"), ("url", "a")), (("n", '["x"]'), ("url", "b")),
    }
    twins = spark.newSession()
    twins.conf.set("spark.sql.caseSensitive", "true")
    twins.sql("SELECT 'a' url, 'A' URL").coalesce(1).write.parquet(three)
    spark.sql("SELECT 'b' url").coalesce(1).write.mode("append").parquet(three)
    assert {tuple(sorted(r.event.items())) for r in records(read_logs(spark, three, "parquet")).collect()} == {
        (("URL", "A"), ("url", "a")), (("url", "b"),),
    }


def test_converted_csv_reads_back_the_same(spark, tmp_path):
    rows = read_csv(spark, _file(tmp_path, "a.csv", EDGES))
    out = str(tmp_path / "a.parquet")
    write_converted(rows, out)
    again = read_logs(spark, out)
    assert [r.event for r in records(again).collect()] == [r.event for r in records(rows).collect()]
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_converted(rows, out)


def test_parquet_values_as_text(spark, tmp_path):
    path = str(tmp_path / "p.parquet")
    spark.sql(
        "SELECT 1500000D AS d, true AS b, CAST(NULL AS INT) AS n, '' AS e, array(1,2) AS a,"
        " DATE'2024-01-02' AS day"
    ).write.parquet(path)
    event = records(read_logs(spark, path)).first().event
    assert event == {"d": "1500000.0", "b": "true", "a": "[1,2]", "day": "2024-01-02"}


CEF_TEXT = "CEF:0|V|P|1|2|N|7|src=1.1.1.1 dhost=h\nbroken\nCEF:0|V|P|1|2|N|x|\n\n"


def test_ingest_cef(spark, tmp_path):
    path = _file(tmp_path, "a.log", CEF_TEXT)
    out, dead = str(tmp_path / "m"), str(tmp_path / "d")
    done = ingest(spark, path, text_writer(out), dead, extensions=("dhost",))
    assert (done.processed, done.failed, done.published, done.publish_failed) == (4, 2, 2, 0)
    sent = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert {(m["src"], m["severity"], m["dhost"]) for m in sent} == {("1.1.1.1", 7, "h"), ("", 0, "")}
    letters = {tuple(r) for r in read_dead_letters(spark, dead).collect()}
    assert letters == {("parse_failed", 2, "broken"), ("parse_failed", 4, "")}


@pytest.mark.parametrize("name", ["a.log", "a.csv"])
def test_ingest_reads_its_input_once(spark, tmp_path, name):
    """Once publishing begins, the input may be gone: retries, rejects, numbers and counters do without."""
    path = _file(tmp_path, name, CEF_TEXT if name == "a.log" else EDGES)
    out, dead, calls = str(tmp_path / "m"), str(tmp_path / "d"), []

    def write(values):
        calls.append(1)
        if os.path.exists(path):
            os.remove(path)
        if len(calls) < 3:
            raise OSError("broker is away")
        values.write.mode("append").text(out)

    done = ingest(spark, path, write, dead)
    letters = sorted((r.error, r.line, r.raw) for r in read_dead_letters(spark, dead).collect())
    if name == "a.log":
        assert (done.processed, done.failed, done.published, done.publish_failed) == (4, 2, 2, 0)
        assert letters == [("parse_failed", 2, "broken"), ("parse_failed", 4, "")]
    else:
        assert (done.processed, done.failed, done.published, done.publish_failed) == (6, 2, 4, 0)
        assert [raw for _, _, raw in letters] == ["long,u3,1,extra", "short,u2"]
    assert spark.read.text(out).count() == done.published and len(calls) == 3


def test_line_numbers_of_rejects_in_split_files(spark, tmp_path):
    lines = [f"CEF:0|V|P|1|2|N|7|src=1.1.1.1 msg={'x' * (i % 40)}" if i % 7 else f"bad {i}" for i in range(3000)]
    path = _file(tmp_path, "a.log", "\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        done = ingest(spark, path, text_writer(str(tmp_path / "m")), str(tmp_path / "d"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    letters = {(r.line, r.raw) for r in read_dead_letters(spark, str(tmp_path / "d")).collect()}
    assert letters == {(i + 1, f"bad {i}") for i in range(0, 3000, 7)}
    assert (done.processed, done.failed, done.published) == (3000, len(letters), 3000 - len(letters))


def test_ingest_csv_folder(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    _file(tmp_path / "in", "a.csv", EDGES)
    out, dead = str(tmp_path / "m"), str(tmp_path / "d")
    done = ingest(spark, str(tmp_path / "in"), text_writer(out), dead, kind="csv")
    assert (done.processed, done.failed, done.published) == (6, 2, 4)
    assert {r.error for r in read_dead_letters(spark, dead).collect()} == {"malformed_row"}


class Flaky:
    """A writer whose first calls fail."""

    def __init__(self, failures):
        self.failures, self.calls, self.rows = failures, 0, []

    def __call__(self, values):
        self.calls += 1
        if self.calls <= self.failures:
            raise OSError("broker away")
        self.rows = [r.value for r in values.collect()]


@pytest.mark.parametrize("failures", [0, 1, 2, 3])
def test_publishing_retries_then_keeps_dead_letters(spark, tmp_path, failures):
    values = spark.createDataFrame([("a",), (None,), ("b",)], "value string")
    writer, dead = Flaky(failures), str(tmp_path / "dead")
    sent = publish(values, writer, dead, backoff=0.01)
    assert writer.calls == min(failures + 1, 3)
    if failures < 3:
        assert (sent.published, sent.failed, sorted(writer.rows)) == (2, 0, ["a", "b"])
        assert not os.path.exists(dead)
    else:
        assert (sent.published, sent.failed) == (0, 2)
        letters = {(r.error, r.raw) for r in read_dead_letters(spark, dead).collect()}
        assert letters == {("publish_failed", "a"), ("publish_failed", "b")}


def test_observed_counters(spark, tmp_path):
    lines = line_source.read_lines(spark, _file(tmp_path, "a.log", CEF_TEXT))
    parsed, seen = observe_parse(parse_cef(lines), F.col("error").isNotNull())
    parsed.filter("error IS NULL").write.format("noop").mode("overwrite").save()
    assert seen.get == {"processed": 4, "failed": 2}


def test_publishing_fails_by_batches(spark, tmp_path):
    """A writer that fails on one of three batches leaves only that one in the dead letters; repeated, the
    job replaces them."""
    for name in "abc":
        _file(tmp_path, f"{name}.csv", f"k,n\n{name},1\n{name},2\nshort\n")
    sent, dead = [], str(tmp_path / "dead")

    def write(values):
        got = [r.value for r in values.collect()]
        if any('"b"' in v for v in got):
            raise OSError("broker is away")
        sent.extend(got)

    for _ in range(2):
        sent.clear()
        done = ingest(spark, str(tmp_path / "*.csv"), write, dead, kind="csv", batch_bytes=20)
        assert (done.processed, done.failed, done.published, done.publish_failed) == (9, 3, 4, 2)
        letters = sorted((r.error, r.raw) for r in read_dead_letters(spark, dead).collect())
        assert [e for e, _ in letters] == ["malformed_row"] * 3 + ["publish_failed"] * 2
        assert all('"b"' in raw for e, raw in letters if e == "publish_failed") and len(sent) == 4
