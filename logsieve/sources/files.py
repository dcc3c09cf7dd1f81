"""Log files by extension: CEF lines, CSV and Parquet rows.

Every reader gives text. Types are never guessed, so ``007`` stays ``007`` and a large
whole number is not rewritten as an exponent on its way to the log table.
"""

from __future__ import annotations

import csv
import os
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsieve.functions.once import quoted, with_once
from logsieve.functions.records import row_to_json, row_to_map
from logsieve.functions.text import non_empty
from logsieve.operators.lookup import fits_broadcast
from logsieve.session import kept
from logsieve.sources.lines import read_lines
from logsieve.sources.quoted import Cells, csv_lines, csv_records, split_rows, split_states

# The supported extensions and the kind of record each holds.
ROUTES = {".log": "cef", ".cef": "cef", ".csv": "csv", ".parquet": "parquet"}

CORRUPT = "_corrupt"


@dataclass(frozen=True)
class Rows:
    """Rows of a file with a header of their own, as read.

    headers: verbatim, in file order, repeats included.
    columns: the column of `df` behind each header.
    others: rows of files with other headers.
    """

    df: DataFrame
    headers: list[str]
    columns: list[str]
    others: tuple[Rows, ...] = ()

    def parts(self) -> list[Rows]:
        """These rows and those of every other header, each by itself."""
        return [replace(self, others=()), *self.others]

    def cells(self) -> list[Column]:
        return [F.col(quoted(c)) for c in self.columns]


def route(path: str) -> str:
    """The record kind of a path: cef, csv or parquet."""
    extension = os.path.splitext("x" + os.path.basename(path.rstrip("/")))[1].lower()
    if extension not in ROUTES:
        raise ValueError(
            f"unsupported file format: {extension or 'none'} (supported: {', '.join(ROUTES)})"
        )
    return ROUTES[extension]


def route_column(path: Column) -> Column:
    """`route` for a column of paths; ``unsupported`` where it would raise."""
    extension = F.lower(F.regexp_extract(path, r"(\.[^./]*)$", 1))
    kind = F.when(extension == "", None)
    for known, name in ROUTES.items():
        kind = kind.when(extension == known, name)
    return F.coalesce(kind, F.lit("unsupported"))


def file_batches(spark: SparkSession, path: str, most: int) -> list[list[str]]:
    """The files of a path in groups of at most `most` bytes, one file at least."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    batches, total = [], most + 1
    for file in sorted(spark.read.text(path).inputFiles()):
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(file)
        size = place.getFileSystem(hadoop).getFileStatus(place).getLen()
        if total + size > most:
            batches.append([])
            total = 0
        batches[-1].append(file)
        total += size
    return batches


def read_logs(spark: SparkSession, path: str | list[str], kind: str | None = None, **options):
    """Read a log file, or a folder of them when `kind` is given: lines for cef,
    `Rows` for csv and parquet."""
    kind = kind or route(path)
    if kind == "cef":
        return read_lines(spark, path)
    if kind == "csv":
        return read_csv(spark, path, **options)
    if kind == "parquet":
        return read_parquet(spark, path)
    raise ValueError(f"unknown record kind: {kind}")


def csv_options(lenient: bool = False) -> dict[str, str]:
    """The dialect of a record: comma, double quotes, a doubled quote as the escape."""
    trim = str(lenient).lower()
    return {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": trim, "ignoreTrailingWhiteSpace": "false"}


def read_csv(spark: SparkSession, path: str | list[str], lenient: bool = False, multiline: bool = True) -> Rows:
    """CSV with a header row, comma, double quotes, a doubled quote as the escape.

    Rows with too few or too many cells are kept in `df` with their text in
    `_corrupt`; `good_rows` and `bad_rows` tell them apart. `lenient` drops white space
    before a cell. Cells may hold line breaks in quotes; large files are split all the same
    (see `sources.quoted`), for which one pass over the files finds out how their splits
    begin. With `multiline=False` every line is a record, and lines whose quotes do not close
    are kept as rows that do not fit.

    Each file has its own header: files of one header are read together, and further
    headers are in `others`.
    """
    options = csv_options(lenient)
    lines = csv_lines(spark, path)
    splits = kept(split_rows(lines, lenient), "splits")
    groups = _files_by_header(spark, splits, options)
    parts = []
    for headers, files in groups.items():
        if len(groups) > 1:  # other files may be split otherwise
            lines = csv_lines(spark, files)
            splits = kept(split_rows(lines, lenient), "splits")
        if multiline:
            texts = csv_records(lines, kept(split_states(splits), "states"), lenient)
        else:
            texts = _single_lines(lines, splits)
        parts.append(_csv_rows(texts, list(headers), options, multiline))
    if not parts:
        return Rows(spark.createDataFrame([], T.StructType([])), [], [])
    return replace(parts[0], others=tuple(parts[1:]))


def _files_by_header(spark: SparkSession, splits: DataFrame, options: dict) -> dict[tuple[str, ...], list[str]]:
    """The files of each header, from the rows of their splits. Only a header that goes on in the next
    line is looked up in its file."""
    lenient = options["ignoreLeadingWhiteSpace"] == "true"
    cells = Cells(lenient)
    firsts = splits.where("first IS NOT NULL").groupBy("first").agg(F.sort_array(F.collect_list("file")).alias("files"))
    groups: dict[tuple[str, ...], list[str]] = {}
    found = [(f, r["first"]) for r in firsts.collect() for f in r["files"]]
    for file, line in sorted(found):
        if not cells.ends_inside(line, False):
            header = next(csv.reader([line], skipinitialspace=lenient))
        else:
            header = [h or "" for h in spark.read.options(multiLine="true", **options).csv(file, header=False).first()]
        groups.setdefault(tuple(header), []).append(file)
    return groups


def _single_lines(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """`value`: every line but the first of each file and empty ones."""
    starts = splits.where("start IS NOT NULL").select("file", "block", "start")
    starts = F.broadcast(starts) if fits_broadcast(starts) else starts
    found = lines.filter("value <> ''").join(starts, ["file", "block"], "left")
    return found.filter("start IS NULL OR seq <> start").select("value")


def _csv_rows(texts: DataFrame, headers: list[str], options: dict, multiline: bool) -> Rows:
    folded = {h.lower() for h in headers}
    by_name = len(folded) == len(headers) and not folded & {"", CORRUPT}
    names = headers if by_name else [f"_{i}" for i in range(len(headers))]
    ddl = ", ".join(f"{quoted(n)} string" for n in [*names, CORRUPT])
    parsed = F.from_csv("value", ddl, {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    whole = F.lit(True)
    if not multiline:
        whole = (F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))) % 2 == 0
    rows = with_once(texts, "row", F.when(whole, parsed)).select(
        *(F.col("row")[n].alias(n) for n in names),
        F.when(F.col("row").isNull(), F.col("value")).otherwise(F.col("row")[CORRUPT]).alias(CORRUPT),
    )
    return Rows(rows, headers, names)


def read_parquet(spark: SparkSession, path: str) -> Rows:
    """Parquet with whatever columns it has, each as text; nested values as JSON.

    The files of a folder may have different columns: all are read, and a cell that a file lacks
    is empty. Where their types differ or names differ by case only, files are read by schema, each
    further one in `others`; a schema is then looked up for every file.
    """
    paths = [path] if isinstance(path, str) else path
    # Names that differ by case only need a session that tells them apart.
    exact = spark.newSession()
    exact.conf.set("spark.sql.caseSensitive", "true")
    try:
        names = exact.read.option("mergeSchema", "true").parquet(*paths).columns
    except (PySparkException, Py4JJavaError):
        return _parquet_by_schema(exact, path)
    if len({n.lower() for n in names}) < len(names):
        return _parquet_by_schema(exact, path)
    df = spark.read.option("mergeSchema", "true").parquet(*paths)
    headers = df.columns
    return Rows(df.select(*[as_text(df, h) for h in headers]), headers, headers)


def _parquet_by_schema(session: SparkSession, path: str) -> Rows:
    files = session.read.text(path).inputFiles()
    groups: dict[str, list[str]] = {}
    for file in sorted(files):
        groups.setdefault(session.read.parquet(file).schema.json(), []).append(file)
    parts = []
    for same in groups.values():
        df = session.read.parquet(*same)
        headers, names = df.columns, [f"_{i}" for i in range(len(df.columns))]
        parts.append(Rows(df.select(*[as_text(df, h).alias(n) for h, n in zip(headers, names)]), headers, names))
    return replace(parts[0], others=tuple(parts[1:]))


def as_text(df: DataFrame, column: str) -> Column:
    dtype = df.schema[column].dataType
    source = F.col(quoted(column))
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(source).alias(column)
    return source.cast("string").alias(column)


def good_rows(rows: Rows) -> Rows:
    good = [
        replace(p, df=p.df.filter(F.col(CORRUPT).isNull() & _asked(p))) if CORRUPT in p.df.columns else p
        for p in rows.parts()
    ]
    return replace(good[0], others=tuple(good[1:]))


def bad_rows(rows: Rows) -> DataFrame:
    """The text of rows that do not fit the header, as `value`."""
    return _union(rows, _bad)


def _bad(rows: Rows) -> DataFrame:
    if CORRUPT not in rows.df.columns or not rows.columns:
        return rows.df.select(F.lit(None).cast("string").alias("value")).filter(F.lit(False))
    return rows.df.filter(F.col(CORRUPT).isNotNull() & _asked(rows)).select(F.col(CORRUPT).alias("value"))


def _asked(rows: Rows) -> Column:
    """Always true: a reader refuses to be asked for nothing but the text of bad rows, hence the
    first cell."""
    return F.coalesce(*rows.cells()[:1], F.lit("")) >= F.lit("")


def _union(rows: Rows, of: Callable[[Rows], DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, map(of, rows.parts()))


def records(rows: Rows, name: str = "event") -> DataFrame:
    """Good rows as maps of header to text, without their empty cells."""
    return _union(good_rows(rows), lambda p: p.df.select(row_to_map(p.headers, p.cells()).alias(name)))


def messages(rows: Rows, name: str = "value") -> DataFrame:
    """Good rows as JSON messages: sorted keys, no empty cells."""
    return _union(good_rows(rows), lambda p: p.df.select(row_to_json(p.headers, p.cells()).alias(name)))


def outcomes(rows: Rows) -> DataFrame:
    """Every row once: whether it `failed` to fit, and as `value` its JSON message or, if it failed, its text."""

    def of(part: Rows) -> DataFrame:
        message = row_to_json(part.headers, part.cells())
        if CORRUPT not in part.df.columns:
            return part.df.select(F.lit(False).alias("failed"), message.alias("value"))
        failed = F.col(CORRUPT).isNotNull()
        return part.df.select(failed.alias("failed"), F.when(failed, F.col(CORRUPT)).otherwise(message).alias("value"))

    return _union(rows, of)


def filled(cell: Column) -> Column:
    return non_empty(cell).isNotNull()
