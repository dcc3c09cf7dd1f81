"""CEF lines: ``CEF:version|vendor|product|device version|signature id|name|severity|
extensions``, where extensions are ``key=value`` pairs separated by white space.

All patterns are linear in the line's length: no group repeats without a possessive
quantifier, so a line of any length neither backtracks nor overflows the stack.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.functions.once import quoted, with_once
from logsieve.functions.records import with_map

HEADER_FIELDS = ("vendor", "product", "version", "signature_id", "name", "severity")

# Each match is a bar and the text up to the next one that is not escaped; the first
# follows the version, the others follow one another.
_FIELD = r"(?s)(?:^CEF:[0-9]+|\G(?!^))\|([^|\\]*+(?:\\.[^|\\]*+)*+)"
_KEY = r"(?:^|\s)([A-Za-z0-9_.\[\]]++)="
_SPACES = " \t\n\x0b\x0c\r"


def _replaced(text: Column, *pairs: tuple[str, str]) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def _unescape_header(field: Column) -> Column:
    """Every bar inside a field is an escaped one, so bars go first and what is left in
    pairs is escaped backslashes."""
    return _replaced(field, ("\\|", "|"), ("\\\\", "\\"))


def _unescape_value(value: Column) -> Column:
    """``\\n`` and ``\\r`` become line breaks unless their backslash is itself escaped;
    an escaped ``=``, ``|`` or backslash loses its backslash. Other backslashes stay.

    Whether the backslashes before ``=`` or ``|`` are odd or even in number, dropping
    one and then halving the rest leaves the right number; before a letter that must
    become a line break it does not, hence the pattern."""
    broken = value
    for letter, mark in (("n", "\n"), ("r", "\r")):
        broken = F.regexp_replace(broken, rf"(?<!\\)((?:\\\\)*+)\\{letter}", f"$1{mark}")
    breaks = F.contains(value, F.lit("\\n")) | F.contains(value, F.lit("\\r"))
    broken = F.when(breaks, broken).otherwise(value)
    return _replaced(broken, ("\\=", "="), ("\\|", "|"), ("\\\\", "\\"))


def with_header(df: DataFrame, line: str) -> DataFrame:
    """Add `header`, a struct of the six header fields and the raw `extensions`; NULL
    where the line is not CEF or has too few header fields.

    One pattern pass cuts the line; what follows the six fields is taken by its position.
    """
    fields, n = F.col("_fields"), len(HEADER_FIELDS)
    before = F.expr(
        f"length(substring_index(`{line}`, '|', 1)) + length(concat_ws('|', slice(_fields, 1, {n})))"
    )
    header = F.struct(
        *[_unescape_header(F.get(fields, F.lit(i))).alias(f) for i, f in enumerate(HEADER_FIELDS)],
        F.col(line).substr(before + 3, F.length(line)).alias("extensions"),
    )
    cut = df.withColumn("_fields", F.regexp_extract_all(line, F.lit(_FIELD), F.lit(1)))
    return with_once(cut, "header", F.when(F.size(fields) > n, header)).drop("_fields")


def with_extensions(df: DataFrame, extensions: Column) -> DataFrame:
    """Add `_keys` and `_values`, the extensions in order. A value runs up to the next
    key, so it may hold bare equals signs and spaces; the values are still escaped and
    carry the white space behind them, and one more than the keys comes first."""
    cut = df.withColumn("_extensions", extensions)
    return cut.select(
        *[quoted(c) for c in df.columns],
        F.regexp_extract_all("_extensions", F.lit(_KEY), F.lit(1)).alias("_keys"),
        F.split("_extensions", _KEY, -1).alias("_values"),
    )


def _clean(value: Column) -> Column:
    return _unescape_value(F.rtrim(value, F.lit(_SPACES)))


def extension_values(keys: tuple[str, ...]) -> Column:
    """After `with_extensions`, the last value of each of the keys, as an array; the
    empty string for a key the record lacks."""

    def escaped(key: str) -> Column:
        behind = F.array_position(F.reverse("_keys"), key)
        return F.when(behind > 0, F.get("_values", (F.size("_keys") - behind + 1).cast("int")))

    # Cleaning the few values as an array keeps its code out of the fused loop, which
    # would otherwise grow too large to be compiled.
    return F.transform(
        F.array(*[escaped(k) for k in keys]), lambda v: F.coalesce(_clean(v), F.lit(""))
    )


def with_extension_map(df: DataFrame, extensions: Column, name: str) -> DataFrame:
    """Add all extensions as a map; the last one of a repeated key wins."""
    found = with_extensions(df, extensions)
    cleaned = F.transform(F.slice("_values", F.lit(2), F.size("_keys")), _clean)
    return with_map(found.withColumn("_cleaned", cleaned), "_keys", "_cleaned", name).drop(
        "_keys", "_values", "_cleaned"
    )


def severity(text: Column) -> Column:
    """Whole number as written, 0 for a word such as ``High``."""
    return F.coalesce(F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint")), F.lit(0).cast("bigint"))
