"""Coercions and event times: known values, and agreement with Python on random text."""

from __future__ import annotations

import random

import datetime as dt

import pytest
from pyspark.sql import functions as F

from logsieve.functions import coerce
from logsieve.functions.eventtime import BREACH, CLOCK, DAY, INSTANT, with_event_time
from logsieve.functions.text import is_true, lookup_key, normalize_header

MAX64 = 2**64 - 1


def _column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, raw string")


def _evaluate(spark, values, sql):
    rows = _column(spark, values).selectExpr("i", f"{sql} AS x").orderBy("i").collect()
    return [r.x for r in rows]


WHOLE = {
    "12.5": (0, "not_integer"),
    "-5": (0, "out_of_range"),
    "+7": (7, None),
    "1e3": (0, "not_integer"),
    "": (0, None),
    None: (0, None),
    " 42 ": (42, None),
    "0x10": (0, "not_integer"),
    "1_000": (0, "not_integer"),
    "   ": (0, "not_integer"),
    str(MAX64): (MAX64, None),
    str(MAX64 + 1): (0, "out_of_range"),
    "99999999999999999999": (0, "out_of_range"),
    "9" * 40: (0, "out_of_range"),
    "\t18446744073709551615\n": (MAX64, None),
    "9223372036854775808": (2**63, None),
    "0": (0, None),
}


def test_uint64(spark):
    got = _evaluate(spark, list(WHOLE), coerce.to_uint("raw", "uint64"))
    assert [int(g) for g in got] == [v for v, _ in WHOLE.values()]
    breach = coerce.uint_breach("raw", coerce.whole("raw", "uint64"), "uint64")
    assert _evaluate(spark, list(WHOLE), breach) == [r for _, r in WHOLE.values()]


def test_uint64_as_bigint_rejects_the_upper_half(spark):
    values = [str(2**63 - 1), str(2**63)]
    assert _evaluate(spark, values, coerce.to_uint("raw", "uint64", "BIGINT")) == [2**63 - 1, 0]


@pytest.mark.parametrize("kind,limit", [("uint8", 255), ("uint16", 65535), ("uint32", 2**32 - 1)])
def test_narrow_widths(spark, kind, limit):
    values = [str(limit), str(limit + 1), str(MAX64)]
    assert _evaluate(spark, values, coerce.to_uint("raw", kind)) == [limit, 0, 0]


def test_uint_agrees_with_python_on_random_text(spark):
    rng = random.Random(7)
    values = ["".join(rng.choice("0123456789+- .e") for _ in range(rng.randint(1, 6))) for _ in range(500)]

    def expected(text):
        try:
            number = int(text)
        except ValueError:
            return 0
        return number if 0 <= number <= MAX64 else 0

    got = _evaluate(spark, values, coerce.to_uint("raw", "uint64"))
    assert [int(g) for g in got] == [expected(v) for v in values]


def test_float(spark):
    values = [" 1.5 ", "1e3", "abc", "", None, "nan", "inf", "1.5f", "0x1p3", "1e999", "-2.", ".5"]
    assert _evaluate(spark, values, coerce.to_float("raw", "DOUBLE")) == [
        1.5, 1000.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, -2.0, 0.5,
    ]
    rules = _evaluate(spark, values, coerce.float_breach("raw", coerce.finite("raw", "DOUBLE")))
    bad = "not_number"
    assert rules == [None, None, bad, None, None, bad, bad, bad, bad, bad, None, None]


def test_ipv4(spark):
    values = ["10.0.0.1", None, "", "256.1.1.1", "::1", "abc", "1.2.3", " 1.2.3.4", "255.255.255.255"]
    none = coerce.NO_ADDRESS
    assert _evaluate(spark, values, coerce.to_ipv4("raw")) == [
        "10.0.0.1", none, none, none, none, none, none, none, "255.255.255.255",
    ]
    bad = "not_ipv4"
    assert _evaluate(spark, values, coerce.ipv4_breach("raw")) == [
        None, None, None, bad, bad, bad, bad, bad, None,
    ]


TIMES = {
    "2024-01-02T03:04:05Z": ("2024-01-02 03:04:05.000", "2024-01-02", "03:04:05"),
    "2024-01-02T23:30:00-05:00": ("2024-01-03 04:30:00.000", "2024-01-02", "23:30:00"),
    "2024-01-02": ("2024-01-02 00:00:00.000", "2024-01-02", "00:00:00"),
    "20240102": ("2024-01-02 00:00:00.000", "2024-01-02", "00:00:00"),
    "2024-01-02T03Z": ("2024-01-02 03:00:00.000", "2024-01-02", "03:00:00"),
    "2024-01-02T03+05:30": ("2024-01-01 21:30:00.000", "2024-01-02", "03:00:00"),
    "2024-01-02 03:04": ("2024-01-02 03:04:00.000", "2024-01-02", "03:04:00"),
    "2024-01-02T03:04+0200": ("2024-01-02 01:04:00.000", "2024-01-02", "03:04:00"),
    "2024-01-02T03:04:05,5Z": ("2024-01-02 03:04:05.500", "2024-01-02", "03:04:05"),
    "2024-01-02T03:04:05.123987654Z": ("2024-01-02 03:04:05.123", "2024-01-02", "03:04:05"),
    "2024-01-02 03:04:05 +0000 UTC": ("2024-01-02 03:04:05.000", "2024-01-02", "03:04:05"),
    "1700000000": ("2023-11-14 22:13:20.000", "2023-11-14", "22:13:20"),
    "1700000000.25": ("2023-11-14 22:13:20.250", "2023-11-14", "22:13:20"),
    "1700000000123": ("2023-11-14 22:13:20.123", "2023-11-14", "22:13:20"),
    "1700000000123456": ("2023-11-14 22:13:20.123", "2023-11-14", "22:13:20"),
    "1700000000123456789": ("2023-11-14 22:13:20.123", "2023-11-14", "22:13:20"),
    "2024": (None, None, None),
    "nope": (None, None, None),
    "2024-13-01": (None, None, None),
    "2024-01-02T25:00:00Z": (None, None, None),
    "": (None, None, None),
    None: (None, None, None),
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_event_times_in_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        timed = with_event_time(_column(spark, list(TIMES)), "raw").orderBy("i")
        rows = timed.select(
            F.expr(f"date_format(to_utc_timestamp({INSTANT}, '{zone}'), 'yyyy-MM-dd HH:mm:ss.SSS')"),
            F.col(DAY).cast("string"),
            CLOCK,
        ).collect()
        breaches = [r[0] for r in timed.select(BREACH).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [tuple(r) for r in rows] == list(TIMES.values())
    assert breaches == [
        ("bad_time" if k else "no_time") if v[0] is None else None for k, v in TIMES.items()
    ]


def test_truth_of_flags(spark):
    values = ["true", "TRUE", " Yes ", "y", "t", "1", "false", "0", "no", "on", "", None]
    rows = _column(spark, values).select("i", is_true(F.col("raw")).alias("x")).orderBy("i").collect()
    assert [r.x for r in rows] == [True] * 6 + [False] * 6
    numbers = spark.createDataFrame([(0.0,), (2.0,), (None,)], "n double")
    assert [r[0] for r in numbers.select(is_true(F.col("n"), "double")).collect()] == [False, True, False]


def test_keys_strip_like_python(spark):
    values = ["  A\t", "\u3000x\xa0", "\x1fq\n", "in side ", "\u2028", "straße "]
    rows = _column(spark, values).select("i", lookup_key(F.col("raw")).alias("x")).orderBy("i").collect()
    assert [r.x for r in rows] == [v.lower().strip() for v in values]


def test_normalized_headers(spark):
    values = ["Dst-Name 9 ", "header1_deviceVendor", "url"]
    rows = _column(spark, values).select("i", normalize_header(F.col("raw")).alias("x")).orderBy("i")
    assert [r.x for r in rows.collect()] == ["dstname9", "header1devicevendor", "url"]


def test_iso_forms_as_the_language_reads_them(spark):
    import random

    from logsieve.functions.eventtime import BREACH, CLOCK, DAY, INSTANT, with_event_time

    r = random.Random(8)
    texts = ["20240102T030405Z", "2024-01-02T0304", "2024-W01-2", "2024W012", "2024-W01", "2024-01-02_03:04", "2020-W53-7T01:02:03+01:02:03", "20240102 0304-0530", "2024-01-02T03:04:05+010203"]
    for _ in range(600):
        day = dt.date(2000, 1, 1) + dt.timedelta(days=r.randrange(20_000))
        year, week, weekday = day.isocalendar()
        date = r.choice([day.isoformat(), day.strftime("%Y%m%d"), f"{year}-W{week:02}-{weekday}", f"{year}W{week:02}{weekday}"])
        clock = f"{r.randrange(24):02}", f"{r.randrange(60):02}", f"{r.randrange(60):02}"
        time = r.choice([":", ""]).join(clock[: r.randrange(1, 4)])
        if len(time) in (6, 8):
            time += r.choice(["", ".123", ",5", ".123456789"])
        zone = r.choice(["", "Z", "+05", "-0530", "+05:30", "+01:02:03"])
        texts.append(date + r.choice(["T", " ", "x"]) + time + zone if r.random() < 0.9 else date)
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for row in with_event_time(frame, "t").collect():
        want = dt.datetime.fromisoformat(row.t)
        at = want if want.tzinfo else want.replace(tzinfo=dt.timezone.utc)
        assert row[BREACH] is None, row.t
        assert (row[DAY], row[CLOCK]) == (want.date(), want.strftime("%H:%M:%S")), row.t
        got = row[INSTANT].astimezone(dt.timezone.utc)
        assert got == at.astimezone(dt.timezone.utc).replace(microsecond=at.microsecond // 1000 * 1000), row.t
