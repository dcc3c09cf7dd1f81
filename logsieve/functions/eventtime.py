"""Event time from text: the instant, and the wall-clock date and time as written.

Both are needed because the date and time columns follow the offset the text was
written with, while the instant is absolute: ``2024-01-02T23:30:00-05:00`` is
January 2nd, 23:30, and 04:30 UTC on the 3rd.

Nothing depends on the session's time zone; text without an offset means UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

_COMPACT_DATE = r"^[0-9]{8}$"
_EPOCH = r"^(?:[0-9]{10}(?:[.][0-9]+)?|[0-9]{13}|[0-9]{16}|[0-9]{19})$"
_ZONE = r"(?:Z|[+-][0-9]{2}(?::?[0-9]{2}(?::?[0-9]{2})?)?)"
_OFFSET = rf"({_ZONE})(?: [A-Z]{{1,5}})?$"
_ISO = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"(?:[T ][0-9]{2}(?::[0-9]{2}(?::[0-9]{2}(?:[.,][0-9]+)?)?)?"
    rf"(?: ?{_ZONE}(?: [A-Z]{{1,5}})?)?)?$"
)
# The other spellings of ISO 8601: compact or week dates, compact times, any separator.
_WIDE = (
    r"^([0-9]{4})(?:-?([0-9]{2})-?([0-9]{2})|-?W([0-9]{2})(?:-?([1-7]))?)"
    r"(?:[^0-9]([0-9]{2})(?::?([0-9]{2})(?::?([0-9]{2})(?:[.,]([0-9]+))?)?)?"
    rf"({_ZONE})?)?$"
)

# Columns `with_event_time` adds.
INSTANT, DAY, CLOCK, BREACH = "_instant", "_day", "_clock", "_time_breach"

def _wide(group: int) -> str:
    return f"regexp_extract(_text, r'{_WIDE}', {group})"


# The Monday of a year's first week is that of the week of January 4th.
_FIRST_DAY = "make_date(try_cast({0} AS INT), 1, 4)".format(_wide(1))
_WEEK_DATE = f"""CAST(date_add(date_sub({_FIRST_DAY}, weekday({_FIRST_DAY})),
    7 * try_cast({_wide(4)} AS INT) - 8 + coalesce(try_cast({_wide(5)} AS INT), 1)) AS STRING)"""
_WIDE_ZONE = f"""CASE WHEN length({_wide(10)}) = 7 AND NOT contains({_wide(10)}, ':') THEN
    concat_ws(':', substr({_wide(10)}, 1, 3), substr({_wide(10)}, 4, 2), substr({_wide(10)}, 6, 2))
    ELSE {_wide(10)} END"""

# Every spelling in the extended form; other text stays as it is.
_DASHED = f"""CASE WHEN _text RLIKE r'{_COMPACT_DATE}'
    THEN concat_ws('-', substr(_text, 1, 4), substr(_text, 5, 2), substr(_text, 7, 2))
    WHEN _text RLIKE r'{_ISO}' OR NOT _text RLIKE r'{_WIDE}' THEN _text
    ELSE concat(
        CASE WHEN {_wide(4)} <> '' THEN {_WEEK_DATE}
            ELSE concat_ws('-', {_wide(1)}, {_wide(2)}, {_wide(3)}) END,
        CASE WHEN {_wide(6)} = '' THEN '' ELSE concat('T', {_wide(6)}, ':',
            coalesce(nullif({_wide(7)}, ''), '00'), ':', coalesce(nullif({_wide(8)}, ''), '00'),
            CASE WHEN {_wide(9)} <> '' THEN concat('.', {_wide(9)}) ELSE '' END, {_WIDE_ZONE}) END) END"""

# Seconds (a fraction is fine), milliseconds, microseconds or nanoseconds since 1970,
# told apart by their number of digits.
_MICROS = f"""CASE WHEN _text RLIKE r'{_EPOCH}' THEN
    CASE length(substring_index(_text, '.', 1))
        WHEN 10 THEN try_cast(try_cast(_text AS DECIMAL(20,6)) * 1000000 AS BIGINT)
        WHEN 13 THEN try_cast(_text AS BIGINT) * 1000
        WHEN 16 THEN try_cast(_text AS BIGINT)
        ELSE try_cast(_text AS BIGINT) DIV 1000 END END"""

_ISO_CLOCK = """CASE WHEN _iso IS NOT NULL THEN concat_ws(':',
    CASE WHEN substr(_iso, 11, 1) IN ('T', ' ') THEN substr(_iso, 12, 2) ELSE '00' END,
    CASE WHEN substr(_iso, 14, 1) = ':' THEN substr(_iso, 15, 2) ELSE '00' END,
    CASE WHEN substr(_iso, 14, 1) = ':' AND substr(_iso, 17, 1) = ':'
        THEN substr(_iso, 18, 2) ELSE '00' END) END"""

_INSTANT = """CASE WHEN _micros IS NOT NULL THEN timestamp_micros(_micros) ELSE
    try_cast(concat(substr(_iso, 1, 10), 'T', _iso_clock,
        CASE WHEN _fraction <> '' THEN concat('.', _fraction) ELSE '' END,
        CASE WHEN _offset <> '' THEN _offset ELSE 'Z' END) AS TIMESTAMP) END"""

_EPOCH_DAY = "date_add(DATE'1970-01-01', CAST(_micros DIV 86400000000 AS INT))"
_EPOCH_CLOCK = """concat_ws(':',
    lpad(CAST(_micros DIV 3600000000 % 24 AS STRING), 2, '0'),
    lpad(CAST(_micros DIV 60000000 % 60 AS STRING), 2, '0'),
    lpad(CAST(_micros DIV 1000000 % 60 AS STRING), 2, '0'))"""


def with_event_time(df: DataFrame, text: str) -> DataFrame:
    """Add the instant (to the millisecond), the date and clock as written, and the
    broken rule of a time that is missing or cannot be read. `text` is SQL text.

    Accepts ISO 8601 dates and date-times (extended form, or a compact date), the
    same with a zone name after the offset, and epoch numbers, which are written in
    UTC by nature. The steps are separate projections so that each pattern runs once
    per row, and end in a generator so that a filter on the date does not repeat them.
    """
    return (
        df.selectExpr("*", f"{text} AS _text")
        .selectExpr("*", f"{_DASHED} AS _dashed", f"{_MICROS} AS _micros")
        .selectExpr("*", f"CASE WHEN _dashed RLIKE r'{_ISO}' THEN _dashed END AS _iso")
        .selectExpr(
            "*",
            f"{_ISO_CLOCK} AS _iso_clock",
            r"regexp_extract(substr(_iso, 20), r'^[.,]([0-9]{1,6})', 1) AS _fraction",
            f"regexp_extract(substr(_iso, 11), r'{_OFFSET}', 1) AS _offset",
        )
        .selectExpr("*", f"{_INSTANT} AS _at")
        .selectExpr(
            *[f"`{c}`" for c in df.columns],
            f"""inline(array(named_struct(
                '{INSTANT}', date_trunc('MILLISECOND', _at),
                '{DAY}', CASE WHEN _micros IS NOT NULL THEN {_EPOCH_DAY}
                    WHEN _at IS NOT NULL THEN try_cast(substr(_iso, 1, 10) AS DATE) END,
                '{CLOCK}', CASE WHEN _micros IS NOT NULL THEN {_EPOCH_CLOCK}
                    WHEN _at IS NOT NULL THEN _iso_clock END,
                '{BREACH}', CASE WHEN _text IS NULL OR _text = '' THEN 'no_time'
                    WHEN _at IS NULL THEN 'bad_time' END)))""",
        )
    )
