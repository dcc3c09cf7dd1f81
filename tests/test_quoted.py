"""CSV with quoted line breaks over many splits, against the reader that takes a file in one task."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from logsieve.sources import quoted
from logsieve.sources.files import CORRUPT, bad_rows, csv_options, good_rows, read_csv
from logsieve.sources.quoted import Cells, csv_lines, split_rows, split_states


@pytest.fixture
def small_splits(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k in settings:
        spark.conf.unset(k)


def one_task(spark, path, lenient=False):
    """Every row, good or bad, by Spark's reader of whole files."""
    header = spark.read.options(multiLine="true", **csv_options(lenient)).csv(path).first()
    ddl = ", ".join(f"c{i} string" for i in range(len(header))) + f", {CORRUPT} string"
    reader = spark.read.schema(ddl).options(multiLine="true", columnPruning="false", mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    return sorted(map(tuple, reader.options(**csv_options(lenient)).csv(path, header=True, enforceSchema=True).collect()), key=str)


def ours(spark, path, lenient=False):
    rows = read_csv(spark, path, lenient=lenient)
    return sorted((tuple(r) for p in rows.parts() for r in p.df.collect()), key=str)


def cell(r, lenient):
    kind = r.randrange(8)
    if kind < 3:
        return "".join(r.choice("ab 1.") for _ in range(r.randrange(12)))
    inner = "".join(r.choice(['""', "\n", ",", "x", "yy", " ", "\n\n", "é"]) for _ in range(r.randrange(1, 14)))
    if kind == 7:
        return r.choice(['bad"q', 'a"b"c', '"stray"x', 'x""'])
    return (r.choice(["", " "]) if lenient else "") + f'"{inner}"' + r.choice(["", "", " "])


@pytest.mark.parametrize("seed, lenient, ending", [(1, False, "\n"), (2, True, "\n"), (3, False, "\r\n"), (4, False, "")])
def test_equals_the_one_task_reader(spark, tmp_path, small_splits, seed, lenient, ending):
    r = random.Random(seed)
    rows = [["id", "text", "more"]] + [[str(i), cell(r, lenient), cell(r, lenient)] for i in range(250)]
    rows[40].append("wide")
    rows[60].pop()
    rows[90] = ["90", '"' + "long\n" * 300 + '"', "over many splits"]
    rows[120] = [""]
    line = ending or "\n"
    text = line.join(",".join(x).replace("\n", line) for x in rows) + ending
    path = str(tmp_path / "a.csv")
    with open(path, "w", newline="", encoding="utf8") as f:
        f.write(text)
    lines = csv_lines(spark, path)
    assert lines.rdd.getNumPartitions() > 20
    states = split_states(split_rows(lines, lenient)).collect()
    assert sum(s.inside for s in states) > 5
    # The text of a row that does not fit has line feeds where the file has both characters.
    want = [tuple(x and x.replace("\r\n", "\n") for x in row) for row in one_task(spark, path, lenient)]
    assert ours(spark, path, lenient) == sorted(want, key=str)


def test_without_a_broadcast_and_of_many_files(spark, tmp_path, small_splits, monkeypatch):
    r = random.Random(9)
    monkeypatch.setattr(quoted, "fits_broadcast", lambda df: False)
    for name in ("a.csv", "b.csv", "c.csv"):
        head = "﻿id,text" if name == "b.csv" else "id,text"
        body = "".join(f'{name}{i},"{"line" + chr(10) * r.randrange(3)}{i}"\n' for i in range(80))
        (tmp_path / name).write_text(f"\n{head}\n{body}", encoding="utf8")
    rows = read_csv(spark, str(tmp_path))
    assert rows.headers == ["id", "text"] and not rows.others
    got = {x.id for x in good_rows(rows).df.collect()}
    assert got == {f"{n}{i}" for n in ("a.csv", "b.csv", "c.csv") for i in range(80)} and bad_rows(rows).count() == 0


def test_a_quote_that_never_closes(spark, tmp_path, small_splits):
    body = "".join(f"{i},plain text of row {i}\n" for i in range(100))
    path = str(tmp_path / "a.csv")
    (tmp_path / "a.csv").write_text('id,text\n0,"closed\nhere"\n' + body + '7,"open\n' + body)
    # All that follows is one cell, here without the file's last line break.
    want = [tuple(x and x.rstrip("\n") for x in row) for row in one_task(spark, path)]
    assert ours(spark, path) == want
    assert good_rows(read_csv(spark, path)).df.count() == 102


def test_calm_files_need_no_python_to_be_read(spark, tmp_path, small_splits):
    path = str(tmp_path / "a.csv")
    (tmp_path / "a.csv").write_text("id,text\n" + "".join(f'{i},"quoted, ""{i}"""\n' for i in range(100)))
    df = read_csv(spark, path).df
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Exchange hashpartitioning" not in plan
    assert df.count() == 100


def test_line_states():
    strict, lenient = Cells(), Cells(True)
    outside = ["", "a,b", 'a"b,c', '"x"', '"x""y"', '"x" ,y', '"a"b,c', ' "a', '""', '"""",', '"a"b"c,d']
    inside = ['"', 'a,"b', '"a""', 'a,"b"",c', '"x",  "y"," z', '"""']
    assert not any(strict.ends_inside(x, False) for x in outside)
    assert all(strict.ends_inside(x, False) for x in inside if x != '"x",  "y"," z') and lenient.ends_inside(' "a', False)
    assert [strict.ends_inside(x, True) for x in ("", "a", '"', '"",', 'a",b', 'a","b', 'a"x"y,z')] == [True, True, False, True, False, True, False]


def test_empty_files(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    (tmp_path / "in" / "a.csv").write_text("")
    (tmp_path / "in" / "b.csv").write_text("\n\n")
    rows = read_csv(spark, str(tmp_path / "in"))
    assert rows.headers == [] and bad_rows(rows).count() == 0
    (tmp_path / "in" / "c.csv").write_text('"only\na header",x\n')
    rows = read_csv(spark, str(tmp_path / "in"))
    assert rows.headers == ["only\na header", "x"] and rows.df.select(F.col("x")).count() == 0
