"""Records with no fixed schema: map entries, rows to maps, maps to JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.functions.once import with_once
from logsieve.functions.text import non_empty


def with_map(df: DataFrame, keys: str, values: str, name: str) -> DataFrame:
    """Add a map of two array columns of equal length; the last of a repeated key wins.

    Only records that repeat a key pay for more than building the map. In those, sorting
    on (key, position) brings the repeats together and each entry followed by its own
    key is dropped, so a record with very many keys costs n log n and not n squared.
    """
    ordered = F.sort_array(
        F.arrays_zip(
            F.col(keys).alias("k"),
            F.sequence(F.lit(1), F.size(keys)).alias("i"),
            F.col(values).alias("v"),
        )
    )
    repeats = F.size(F.array_distinct(keys)) < F.size(keys)
    following = F.concat(
        F.slice("_ordered", F.lit(2), F.size("_ordered") - 1),
        F.slice("_ordered", F.lit(1), F.lit(1)),
    )
    # The entry wrapped round to the end has the first key, the last entry the last one:
    # they are the same only if there is just one key, whose last entry has to stay.
    last = F.zip_with(
        "_ordered",
        following,
        lambda e, n: F.when((e["k"] != n["k"]) | (e["i"] >= n["i"]), F.struct(e["k"], e["v"])),
    )
    unique = F.when(
        F.col("_ordered").isNotNull(),
        F.map_from_entries(F.filter(last, lambda e: e.isNotNull())),
    ).otherwise(F.map_from_arrays(keys, values))
    return with_once(df.withColumn("_ordered", F.when(repeats, ordered)), name, unique).drop(
        "_ordered"
    )


def _cells(headers: list[str], columns: list[Column]) -> list[tuple[str, Column]]:
    """(header, cell) per distinct header, in key order. A repeated header takes its
    last non-empty cell; that is settled here, before any row is read."""
    by_header: dict[str, list[Column]] = {}
    for header, column in zip(headers, columns):
        by_header.setdefault(header, []).append(non_empty(column))
    return [
        (h, cells[0] if len(cells) == 1 else F.coalesce(*reversed(cells)))
        for h, cells in sorted(by_header.items())
    ]


def row_to_map(headers: list[str], columns: list[Column]) -> Column:
    """Map of verbatim header to text; an empty or NULL cell leaves its key out."""
    cells = _cells(headers, columns)
    if not cells:
        return F.expr("map()").cast("map<string,string>")
    entries = F.array(*[F.struct(F.lit(h).alias("k"), c.alias("v")) for h, c in cells])
    return F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull()))


def row_to_json(headers: list[str], columns: list[Column]) -> Column:
    """The JSON text of `row_to_map` without building the map: struct fields are
    written in order and NULL ones are left out."""
    cells = _cells(headers, columns)
    if not cells:
        return F.lit("{}")
    return F.to_json(
        F.struct(*[c.alias(h) for h, c in cells]), {"ignoreNullFields": "true"}
    )


def map_to_json(record: Column) -> Column:
    """JSON object with sorted keys and no empty values; ``{}`` for an empty map."""
    filled = F.map_filter(record, lambda k, v: v.isNotNull() & (v != ""))
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(filled))))
