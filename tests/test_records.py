"""CEF lines, JSON messages and dynamic rows: edge cases."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from logsieve.functions import cef
from logsieve.functions.records import map_to_json, row_to_json, row_to_map
from logsieve.operators.cef import cef_json, cef_records, parse_cef
from logsieve.operators.events import event_sql, parse_events, parse_json_map

LINES = {
    "c1": r"CEF:0|Ven\|dor|Prod|1.0|100|Name here|5|src=10.0.0.1 dst=2.1.2.2 msg=hello a\=b world spt=1232",
    "c2": "not cef",
    "c3": "CEF:0|V\\\\|P|1|2|N|High|",
    "c4": "CEF:0|V|P|1|2|N",
    "c5": "CEF:0|V|P|1|2|N|7|",
    "c6": "",
    "c7": "CEF:0|V|P|1|2|N|7|msg=" + "x" * (1024 * 1024),
    "c8": "CEF:0|V|P|1|2|N|7|src=1.1.1.1 src=2.2.2.2",
    "c9": "CEF:0|V|P|1|2|N|7|src= request=http://x/?a=b&c=d dst=2.2.2.2",
    "c10": "Jan 1 host CEF:0|V|P|1|2|N|7|src=1.1.1.1",
    "c11": r"CEF:0|V|P|1|2|N|7|msg=a\\n\nb\\\nc | d\|e  path=C:\dir\temp x\\=y",
    "c12": "CEF:0|V|P|1|2|a\x85b\u2028c|3|src=4.4.4.4 msg=p\x85q",
}


@pytest.fixture(scope="module")
def parsed(spark):
    lines = spark.createDataFrame(list(LINES.items()), "id string, value string")
    rows = cef.with_extension_map(parse_cef(lines), F.col("header.extensions"), "ext").collect()
    return {r.id: r for r in rows}


def test_header_fields(parsed):
    assert parsed["c1"].header.vendor == "Ven|dor"
    assert parsed["c3"].header.vendor == "V\\"
    assert parsed["c3"].header.severity == "High"
    assert parsed["c12"].header.name == "a\x85b\u2028c"
    assert parsed["c5"].ext == {}


def test_rejects(parsed):
    errors = {k: r.error for k, r in parsed.items() if r.error}
    assert errors == {
        "c2": "parse_failed", "c4": "parse_failed", "c6": "parse_failed",
        "c10": "parse_failed",
    }


def test_extensions(parsed):
    assert parsed["c1"].ext == {
        "src": "10.0.0.1", "dst": "2.1.2.2", "msg": "hello a=b world", "spt": "1232",
    }
    assert parsed["c8"].ext == {"src": "2.2.2.2"}
    assert parsed["c9"].ext == {"src": "", "request": "http://x/?a=b&c=d", "dst": "2.2.2.2"}
    assert parsed["c11"].ext == {"msg": "a\\n\nb\\\nc | d|e", "path": r"C:\dir\temp x\=y"}
    assert parsed["c12"].ext["msg"] == "p\x85q"


def test_records_and_json(spark):
    lines = spark.createDataFrame(list(LINES.items()), "id string, value string")
    records = cef_records(parse_cef(lines), keep=["id"], extensions=("request",))
    rows = {r.id: r for r in records.select("*", cef_json(records).alias("j")).collect()}
    assert (rows["c1"].severity, rows["c3"].severity, rows["c5"].severity) == (5, 0, 7)
    assert (rows["c8"].src, rows["c9"].src, rows["c9"].dst) == ("2.2.2.2", "", "2.2.2.2")
    message = json.loads(rows["c9"].j)
    assert message["request"] == "http://x/?a=b&c=d"
    assert message["raw_log"] == LINES["c9"]
    legacy = json.loads(records.filter("id = 'c1'").select(cef_json(records, legacy=True)).first()[0])
    assert legacy == {
        "device_vendor": "Ven|dor", "device_product": "Prod", "signature_id": "100", "Severity": 5,
        "src": "10.0.0.1", "dst": "2.1.2.2", "name": "Name here",
        "timestamp": "0001-01-01T00:00:00Z", "raw_log": "",
    }


@pytest.mark.parametrize(
    "piece", ["\\|", "\\\\", "x ", " ", "a=b ", "k\\=v ", "\\n", "|"], ids=repr
)
def test_long_lines_neither_overflow_nor_stall(spark, piece):
    body = piece * (900_000 // len(piece))
    lines = [f"CEF:0|{body}|P|1|2|N|3|src=1.1.1.1", f"CEF:0|V|P|1|2|N|3|msg={body} src=1.1.1.1"]
    frame = spark.createDataFrame([(v,) for v in lines], "value string")
    assert parse_cef(frame).count() == 2
    records = cef_records(parse_cef(frame)).select("src").collect()
    assert records[-1].src == "1.1.1.1"


MESSAGES = {
    '{"a":1,"url":"x","URL":"Y","n":{"q":[1,2]},"b":true,"z":null}': True,
    '{"action":"first","action":"last"}': True,
    " {} ": True,
    '{"a":[{"b":1}]}': True,
    '{"t":"}] x"}': True,
    "{bad": False,
    "": False,
    "[1,2]": False,
    "3": False,
    "null": False,
    '{"a":1} xyz': False,
    '{"a":1}{"b":2}': False,
    '{"a":1},{"b":2}': False,
    '{"a":1}] }': False,
    "{'a':1}": False,
    '[{"a":1}]': False,
}


def _messages(spark):
    return spark.createDataFrame([(v,) for v in [*MESSAGES, None]], "value string")


@pytest.mark.parametrize("parse", [parse_events, parse_json_map])
def test_only_single_objects_are_events(spark, parse):
    rows = parse(_messages(spark)).collect()
    assert {r.value: r.event is not None for r in rows} == {**MESSAGES, None: False}


def test_values_of_messages(spark):
    first, second = list(MESSAGES)[:2]
    maps = {r.value: r.event for r in parse_json_map(_messages(spark)).collect()}
    assert maps[first] == {"a": "1", "url": "x", "URL": "Y", "n": '{"q":[1,2]}', "b": "true", "z": None}
    assert maps[second] == {"action": "last"}
    structs = parse_events(_messages(spark))
    get = event_sql(structs)
    row = structs.filter(F.col("value") == first).selectExpr(*[f"{get(k)} AS `{k}_{i}`" for i, k in enumerate(("url", "URL"))]).first()
    assert tuple(row) == ("x", "Y")
    assert structs.filter(F.col("value") == second).select("event.action").first()[0] == "last"


def test_many_repeated_keys(spark):
    pairs = [(f"k{i % 997}", str(i)) for i in range(20_000)]
    text = "{" + ",".join(f'"{k}":"{v}"' for k, v in pairs) + "}"
    frame = spark.createDataFrame([(text,), ('{"a":"1","a":"2"}',)], "value string")
    events = [r.event for r in parse_json_map(frame).collect()]
    assert events == [dict(pairs), {"a": "2"}]


def test_rows_to_maps_and_json(spark):
    headers = ["a", "b", "a", "url", "URL", "x.y"]
    frame = spark.createDataFrame(
        [("1", "2", "3", "u", "U", "z"), ("4", "5", "", "u2", None, ""), ("",) * 6],
        "c0 string, c1 string, c2 string, c3 string, c4 string, c5 string",
    )
    columns = [F.col(c) for c in frame.columns]
    expected = [
        {"a": "3", "b": "2", "url": "u", "URL": "U", "x.y": "z"},
        {"a": "4", "b": "5", "url": "u2"},
        {},
    ]
    rows = frame.select(
        row_to_map(headers, columns).alias("m"),
        row_to_json(headers, columns).alias("j"),
        map_to_json(row_to_map(headers, columns)).alias("mj"),
    ).collect()
    assert [r.m for r in rows] == expected
    assert [r.j for r in rows] == [r.mj for r in rows]
    assert [r.j for r in rows] == [
        json.dumps(e, sort_keys=True, separators=(",", ":")) for e in expected
    ]
    assert frame.select(row_to_map([], []).alias("m")).first().m == {}
