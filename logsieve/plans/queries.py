"""One query per operator. Results hold whole numbers, doubles and text only, so that
any engine can compare them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.functions import cef, coerce
from logsieve.functions.eventtime import CLOCK, DAY, INSTANT, with_event_time
from logsieve.functions.once import with_once
from logsieve.functions.records import map_to_json
from logsieve.functions.text import normalize_header
from logsieve.operators import maintain, metrics
from logsieve.operators.cef import cef_json, cef_records, cef_rejects, parse_cef, reject_json
from logsieve.operators.enrich import classify, drop_audit, enrich, with_lookup_key
from logsieve.operators.events import parse_events, parse_json_map
from logsieve.operators.lookup import normalise_tools, tools_by_key
from logsieve.operators.projection import log_projection, violations
from logsieve.plans import inputs
from logsieve.schema import LOG_COLUMNS
from logsieve.session import configure, scratch
from logsieve.sources.files import csv_options, read_csv, read_parquet, records, route_column

Query = Callable[[SparkSession, str], DataFrame]

# The retention query's fixed day.
AS_OF = dt.date(2001, 8, 1)

_REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register under the function's name; a `_query` ending tells it from its operator."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(configure(spark), sf_dir)

    _REGISTRY[build.__name__.removesuffix("_query")] = run
    return run


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def _long(column: str) -> Column:
    return F.col(column).cast("bigint").alias(column)


def _portable(logs: DataFrame) -> DataFrame:
    """The log table's columns as whole numbers, doubles and text; those of 64 bits without a sign as text."""

    def plain(name: str, kind: str) -> str:
        if kind == "instant":
            return f"date_format({name}, 'yyyy-MM-dd HH:mm:ss.SSS')"
        if kind == "float":
            return f"CAST({name} AS DOUBLE)"
        narrow = kind.startswith("uint") and kind != "uint64"
        return f"CAST(`{name}` AS {'BIGINT' if narrow else 'STRING'})"

    return logs.selectExpr(*[f"{plain(c.name, c.kind)} AS `{c.name}`" for c in LOG_COLUMNS])


def _enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = parse_events(inputs.log_messages(spark, sf_dir))
    return enrich(events, inputs.tools(spark, sf_dir))


@query
def enrich_ai_tools(spark, sf_dir):
    logs = _portable(log_projection(_enriched(spark, sf_dir)))
    return logs.select(
        "log_id", "eventtime", "tool_id", "tool_name", "tool_url", "tool_ai_category",
        "tool_score", "sentbyte",
    )


@query
def log_projection_query(spark, sf_dir):
    return _portable(log_projection(_enriched(spark, sf_dir)))


@query
def json_parse(spark, sf_dir):
    parsed = parse_json_map(inputs.log_messages(spark, sf_dir, broken_every=9))
    return parsed.select(
        F.col("event_id").alias("log_id"),
        F.col("event").isNotNull().cast("bigint").alias("ok"),
        F.coalesce(F.col("event")["action"], F.lit("")).alias("action"),
    )


@query
def json_text(spark, sf_dir):
    parsed = parse_json_map(inputs.turn_messages(spark, sf_dir))
    return parsed.select("conv_id", "turn", F.explode("event").alias("k", "v"))


@query
def url_coalesce(spark, sf_dir):
    keyed = with_lookup_key(parse_events(inputs.keyed_messages(spark, sf_dir)))
    return keyed.select(F.col("event_id").alias("log_id"), "tool_url")


@query
def url_key(spark, sf_dir):
    keyed = with_lookup_key(parse_events(inputs.keyed_messages(spark, sf_dir)))
    return keyed.filter(F.col("key") != "").groupBy("key").agg(F.count(F.lit(1)).alias("n"))


@query
def has_ai_filter(spark, sf_dir):
    tools = normalise_tools(inputs.tools_with_duplicates(spark, sf_dir))
    return tools.select("id", _long("has_ai"))


@query
def tools_lookup(spark, sf_dir):
    return tools_by_key(inputs.tools_with_duplicates(spark, sf_dir)).select("key", "id", "name")


@query
def tools_latest(spark, sf_dir):
    latest = maintain.latest_tools(inputs.tool_versions(spark, sf_dir))
    return latest.select("tool_id", "url", "score", _stamp(F.col("updated_at")).alias("updated"))


def _classified(spark, sf_dir):
    events = parse_events(inputs.log_messages(spark, sf_dir, broken_every=9))
    return classify(events, inputs.tools(spark, sf_dir))


@query
def drop_audit_query(spark, sf_dir):
    return drop_audit(_classified(spark, sf_dir))


@query
def reconcile(spark, sf_dir):
    return metrics.reconcile(_classified(spark, sf_dir))


@query
def violations_query(spark, sf_dir):
    events = parse_events(inputs.dirty_messages(spark, sf_dir))
    return violations(enrich(events, inputs.tools(spark, sf_dir)))


@query
def to_uint(spark, sf_dir):
    numbers = inputs.table(spark, sf_dir, "events").select("event_id", inputs.number_text().alias("raw"))
    widths = ("uint8", "uint16", "uint32", "uint64")
    return numbers.select(
        "event_id",
        *[F.expr(coerce.to_uint("raw", w)).cast("string" if w == "uint64" else "bigint").alias(f"as_{w}") for w in widths],
    )


@query
def to_float(spark, sf_dir):
    numbers = inputs.table(spark, sf_dir, "events").select("event_id", inputs.number_text().alias("raw"))
    return numbers.select("event_id", F.expr(coerce.to_float("raw", "double")).alias("value"))


@query
def to_ipv4(spark, sf_dir):
    addresses = inputs.table(spark, sf_dir, "events").select("event_id", inputs.ip_text().alias("raw"))
    return addresses.select("event_id", F.expr(coerce.to_ipv4("raw")).alias("value"))


def _timed(spark, sf_dir):
    events = inputs.table(spark, sf_dir, "events").select("event_id", inputs.time_text().alias("raw"))
    return with_event_time(events, "raw")


@query
def event_time(spark, sf_dir):
    return _timed(spark, sf_dir).select(
        "event_id", F.coalesce(_stamp(F.col(INSTANT)), F.lit("")).alias("eventtime")
    )


@query
def event_date_time(spark, sf_dir):
    return _timed(spark, sf_dir).select(
        "event_id",
        F.coalesce(F.col(DAY).cast("string"), F.lit("")).alias("date"),
        F.coalesce(F.col(CLOCK), F.lit("")).alias("time"),
    )


def _cef(spark, sf_dir):
    return parse_cef(inputs.cef_lines(spark, sf_dir))


@query
def cef_header(spark, sf_dir):
    good = _cef(spark, sf_dir).filter(F.col("error").isNull())
    return good.select("event_id", *[F.col("header")[f].alias(f) for f in cef.HEADER_FIELDS])


@query
def cef_severity(spark, sf_dir):
    return cef_records(_cef(spark, sf_dir), keep=["event_id"]).select("event_id", _long("severity"))


@query
def cef_extensions(spark, sf_dir):
    good = _cef(spark, sf_dir).filter(F.col("error").isNull())
    maps = cef.with_extension_map(good, F.col("header.extensions"), "extensions")
    return maps.select("event_id", F.explode("extensions").alias("k", "v"))


@query
def cef_extension_text(spark, sf_dir):
    pages = cef_records(parse_cef(inputs.page_lines(spark, sf_dir)), ["page_id"], extensions=("msg",))
    return pages.select("page_id", "msg", "dst")


@query
def cef_json_query(spark, sf_dir):
    found = cef_records(_cef(spark, sf_dir), keep=["event_id"])
    return found.select(
        "event_id", cef_json(found).alias("payload"), cef_json(found, legacy=True).alias("legacy")
    )


@query
def cef_dlq(spark, sf_dir):
    rejects = cef_rejects(_cef(spark, sf_dir))
    letter = reject_json(F.col("error"), F.col("event_id"), F.col("value"))
    return rejects.select("event_id", letter.alias("letter"))


@query
def row_to_map(spark, sf_dir):
    maps = records(inputs.customer_rows(spark, sf_dir))
    return maps.select(
        F.col("event")["c_custkey"].cast("bigint").alias("c_custkey"),
        F.explode("event").alias("k", "v"),
    )


@query
def map_to_json_query(spark, sf_dir):
    maps = records(inputs.customer_rows(spark, sf_dir))
    return maps.select(
        F.col("event")["c_custkey"].cast("bigint").alias("c_custkey"),
        map_to_json(F.col("event")).alias("payload"),
    )


@query
def parquet_to_map(spark, sf_dir):
    maps = records(read_parquet(spark, f"{sf_dir}/part.parquet"))
    return maps.select(
        F.col("event")["p_partkey"].cast("bigint").alias("p_partkey"),
        F.explode("event").alias("k", "v"),
    )


@query
def normalize_header_query(spark, sf_dir):
    header = F.concat_ws(" ", "p_name", "p_brand", "p_type")
    return inputs.table(spark, sf_dir, "part").select(
        "p_partkey", normalize_header(header).alias("normalized")
    )


@query
def header_report(spark, sf_dir):
    return metrics.header_report(inputs.customer_rows(spark, sf_dir))


@query
def route_by_extension(spark, sf_dir):
    return inputs.page_paths(spark, sf_dir).select(
        "page_id", route_column(F.col("path")).alias("route")
    )


@query
def row_count(spark, sf_dir):
    return metrics.row_count(inputs.table(spark, sf_dir, "lineitem"))


@query
def window_counts(spark, sf_dir):
    counts = metrics.window_counts(inputs.table(spark, sf_dir, "events"), "ts")
    return counts.select(_stamp(F.col("window_start")).alias("window_start"), "n")


@query
def enriched_window_counts(spark, sf_dir):
    logs = log_projection(_enriched(spark, sf_dir))
    counts = metrics.window_counts(logs, "eventtime")
    return counts.select(_stamp(F.col("window_start")).alias("window_start"), "n")


@query
def csv_dialect(spark, sf_dir):
    """Texts as CSV records and back."""
    texts = inputs.table(spark, sf_dir, "documents").select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"), "text")
    pages = inputs.table(spark, sf_dir, "pages").select(F.lit("pages"), "page_id", "html")
    lines = with_once(texts.union(pages), "line", F.to_csv(F.struct("source", "id", "text"), csv_options()))
    read = F.from_csv("line", "source string, id string, text string", {**csv_options(), "mode": "FAILFAST"})
    back = with_once(lines.select("line"), "row", read)
    return back.select(
        F.col("row.source").alias("source"), F.col("row.id").cast("bigint").alias("id"), F.col("row.text").alias("text")
    )


@query
def csv_scan(spark, sf_dir):
    """Texts with quotes, commas and line breaks, written as CSV files with headers and read by the reader."""
    path = scratch(spark, "csv")
    texts = inputs.table(spark, sf_dir, "documents").select(F.lit("documents").alias("source"), F.col("doc_id").alias("id"), "text")
    pages = inputs.table(spark, sf_dir, "pages").select(F.lit("pages"), "page_id", "html")
    texts.union(pages).write.options(header=True, **csv_options()).csv(path)
    return records(read_csv(spark, path)).select(
        F.col("event")["source"].alias("source"), F.col("event")["id"].cast("bigint").alias("id"), F.col("event")["text"].alias("text")
    )


@query
def parse_metrics(spark, sf_dir):
    return metrics.parse_metrics(_cef(spark, sf_dir), F.col("error").isNotNull())


def _dated_logs(spark, sf_dir, undated=None):
    inserted = F.col("o_orderdate").cast("date")
    date = inserted if undated is None else F.when(~undated, inserted)
    return inputs.table(spark, sf_dir, "orders").select(
        date.alias("date"),
        maintain.month_of(date).alias("yyyymm"),
        inserted.cast("timestamp").alias("_inserted_at"),
    )


@query
def logs_by_month(spark, sf_dir):
    return maintain.rows_by_month(_dated_logs(spark, sf_dir)).select(_long("yyyymm"), "n")


@query
def retention(spark, sf_dir):
    """Every tenth row has no date and is as old as its insertion."""
    dated = _dated_logs(spark, sf_dir, F.col("o_orderkey") % 10 == 0)
    kept = maintain.retained(dated, AS_OF)
    return maintain.rows_by_month(kept).select(_long("yyyymm"), "n")
