"""CEF lines to records, JSON messages and rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.functions import cef

PARSE_FAILED = "parse_failed"


def parse_cef(lines: DataFrame, line: str = "value") -> DataFrame:
    """Add `header` (NULL for a reject) and `error` (NULL for a record)."""
    error = F.when(F.col("header").isNull(), PARSE_FAILED)
    return cef.with_header(lines, line).withColumn("error", error)


def cef_records(
    parsed: DataFrame, keep: list[str] = (), line: str = "value", extensions: tuple[str, ...] = ()
) -> DataFrame:
    """Records of the parsed lines: vendor, product, signature id, severity as a number,
    src, dst, name and the line itself; `keep` names columns to carry along and
    `extensions` further extension keys to take out."""
    return _shaped(parsed.filter(F.col("error").isNull()), keep, line, extensions)


def cef_outcomes(
    parsed: DataFrame, keep: list[str] = (), line: str = "value", extensions: tuple[str, ...] = ()
) -> DataFrame:
    """Every parsed line once: `keep`, `error`, and as `value` the JSON of a record or the line of a reject."""
    shaped = _shaped(parsed, [*keep, "error"], line, extensions)
    value = F.when(F.col("error").isNull(), cef_json(shaped)).otherwise(F.col("raw_log"))
    return shaped.select(*keep, "error", value.alias("value"))


def _shaped(parsed: DataFrame, keep: list[str], line: str, extensions: tuple[str, ...]) -> DataFrame:
    header = F.col("header")
    # A key that is asked for twice, or named like a fixed one, comes once.
    fixed = ("device_vendor", "device_product", "signature_id", "severity", "name", "raw_log", *keep)
    wanted = tuple(dict.fromkeys(("src", "dst", *(k for k in extensions if k not in fixed))))
    found = cef.with_extensions(parsed, header["extensions"]).withColumn("_wanted", cef.extension_values(wanted))
    return found.select(
        *keep,
        header["vendor"].alias("device_vendor"),
        header["product"].alias("device_product"),
        header["signature_id"].alias("signature_id"),
        cef.severity(header["severity"]).alias("severity"),
        *[F.get("_wanted", F.lit(i)).alias(k) for i, k in enumerate(wanted)],
        header["name"].alias("name"),
        F.col(line).alias("raw_log"),
    )


def cef_json(records: DataFrame, legacy: bool = False) -> Column:
    """A record as JSON. Further extensions follow the fixed keys.

    legacy: the shape older consumers know, with a capital ``Severity``, a zero
    timestamp and no raw line."""
    fixed = ["device_vendor", "device_product", "signature_id", "severity", "src", "dst", "name"]
    if legacy:
        named = [F.col(c).alias("Severity" if c == "severity" else c) for c in fixed]
        # What these two keys always hold in that shape.
        tail = [F.lit("0001-01-01T00:00:00Z").alias("timestamp"), F.lit("").alias("raw_log")]
        return F.to_json(F.struct(*named, *tail))
    extra = [c for c in records.columns if c not in {*fixed, "raw_log"} and c in _extensions(records)]
    return F.to_json(F.struct(*fixed, "raw_log", *extra))


def _extensions(records: DataFrame) -> set[str]:
    """Columns that `cef_records` took from extensions: those between dst and name."""
    columns = records.columns
    return set(columns[columns.index("dst") + 1 : columns.index("name")])


def cef_rejects(parsed: DataFrame, line: str = "value") -> DataFrame:
    return parsed.filter(F.col("error").isNotNull())


def reject_json(error: Column, line: Column, raw: Column) -> Column:
    """The dead-letter record of a line."""
    return F.to_json(F.struct(error.alias("error"), line.alias("line"), raw.alias("raw")))
