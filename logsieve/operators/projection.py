"""Enriched events to the 43 columns of the log table, and the values that broke a rule."""

from __future__ import annotations

from pyspark.sql import DataFrame

from logsieve.functions import coerce
from logsieve.functions.eventtime import BREACH, CLOCK, DAY, INSTANT, with_event_time
from logsieve.operators.events import event_sql
from logsieve.schema import LOG_COLUMNS, TIME_KEYS, UINT_TYPES, LogColumn


class _Sources:
    """SQL text of each log column's raw text in an enriched frame."""

    def __init__(self, enriched: DataFrame):
        self._get = event_sql(enriched)

    def raw(self, column: LogColumn) -> str:
        if column.from_tool:
            return column.source if column.kind == "text" else f"CAST({column.source} AS STRING)"
        return self._get(column.source)

    def whole(self, column: LogColumn, wide: str = coerce.WIDE) -> str:
        if column.from_tool:
            return f"CAST({column.source} AS BIGINT)"
        return coerce.whole(self.raw(column), column.kind, wide)

    def finite(self, column: LogColumn) -> str:
        """Only the tool columns hold a fraction, and they are numbers already."""
        return coerce.only_finite(f"CAST({column.source} AS FLOAT)")

    def time_text(self) -> str:
        return "coalesce({}, '')".format(", ".join(f"nullif({self._get(k)}, '')" for k in TIME_KEYS))


def _unsigned(kind: str) -> list[LogColumn]:
    return [c for c in LOG_COLUMNS if c.kind == kind and not c.from_tool]


def _numbers(sources: _Sources, wide: str) -> list[str]:
    """An array per width with the sink values of its columns. Worked out as arrays, they
    stay out of the loop that Spark fuses the projection into, which with them would be
    too large for the JVM to compile."""
    return [
        f"""transform(transform(array({', '.join(sources.raw(c) for c in _unsigned(kind))}),
            x -> {coerce.whole('x', kind, wide)}), n -> {coerce.stored_uint('n', kind, wide)})
            AS _{kind}"""
        for kind in UINT_TYPES
    ]


def log_projection(
    enriched: DataFrame, fallback: str | None = None, wide: str = coerce.WIDE
) -> DataFrame:
    """The log table's columns, every value coerced or defaulted.

    fallback: ``now`` gives events without a readable time the current one; by default
    their date, time and instant stay NULL (the violations report names them).
    wide: type of the 64-bit columns.
    """
    if fallback not in (None, "now"):
        raise ValueError(f"fallback must be None or 'now', not {fallback!r}")
    sources = _Sources(enriched)
    instant, day, clock = INSTANT, DAY, CLOCK
    if fallback:
        instant = f"coalesce({INSTANT}, date_trunc('MILLISECOND', current_timestamp()))"
        day = f"coalesce({DAY}, current_date())"
        clock = f"coalesce({CLOCK}, date_format(current_timestamp(), 'HH:mm:ss'))"

    def value(column: LogColumn) -> str:
        raw = sources.raw(column)
        if column.kind == "instant":
            return instant
        if column.kind == "date":
            return day
        if column.kind == "clock":
            return f"coalesce({raw}, {clock})"
        if column.kind == "text":
            return f"coalesce({raw}, '')"
        if column.kind == "ipv4":
            return coerce.to_ipv4(raw)
        if column.kind == "float":
            return coerce.or_zero(sources.finite(column))
        if column.from_tool:
            return coerce.stored_uint(sources.whole(column), column.kind, wide)
        return f"get(_{column.kind}, {_unsigned(column.kind).index(column)})"

    parsed = with_event_time(enriched, sources.time_text())
    return parsed.selectExpr("*", *_numbers(sources, wide)).selectExpr(
        *[f"{value(c)} AS `{c.name}`" for c in LOG_COLUMNS]
    )


def violations(
    enriched: DataFrame, log_id: str | None = None, wide: str = coerce.WIDE
) -> DataFrame:
    """`(log_id, column, raw, rule)` for every value the projection had to replace."""
    sources = _Sources(enriched)

    def breach(column: LogColumn) -> str | None:
        raw = sources.raw(column)
        if column.kind == "instant":
            return BREACH
        if column.kind == "ipv4":
            return coerce.ipv4_breach(raw)
        if column.kind == "float":
            return coerce.float_breach(raw, sources.finite(column))
        if column.kind.startswith("uint"):
            return coerce.uint_breach(raw, sources.whole(column, wide), column.kind, wide)
        return None

    checked = [c for c in LOG_COLUMNS if breach(c)]
    def raw(column: LogColumn) -> str:
        return sources.time_text() if column.kind == "instant" else sources.raw(column)

    rows = ", ".join(
        f"named_struct('column', '{c.name}', 'raw', {raw(c)}, 'rule', {breach(c)})"
        for c in LOG_COLUMNS
        if breach(c)
    )
    # The outer generator keeps the test for an empty report above the report itself;
    # as a filter below, it would work out every rule twice.
    return (
        with_event_time(enriched, sources.time_text())
        .selectExpr(
            f"{log_id or sources.raw(LOG_COLUMNS[0])} AS log_id",
            f"filter(array({rows}), v -> v.rule IS NOT NULL) AS _found",
        )
        .selectExpr("log_id", "inline_outer(_found)")
        .filter("rule IS NOT NULL")
    )
