"""JSON messages to events, and one way to read event keys whatever holds them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsieve.functions.once import quoted
from logsieve.functions.records import with_map
from logsieve.schema import event_field, event_keys

# Only double quotes make a JSON string; the reader's default is more lenient.
_STRICT = {"allowSingleQuotes": "false"}


def _closed(value: Column) -> Column:
    """Whether the text ends where its first JSON value ends. Parsing inside brackets
    settles that except for text holding a bracket of its own, which has to hold
    inside an object as well."""
    wrapped = F.concat(F.lit('{"r":'), value, F.lit("}"))
    again = F.from_json(wrapped, "map<string,string>", _STRICT)
    return F.when(F.contains(value, F.lit("]")), F.size(again) == 1).otherwise(F.lit(True))


def _parse(messages: DataFrame, value: str, element: str, named: str | None = None) -> DataFrame:
    """Add `event`: the message's object, NULL where the text is no single object.

    The text is read as a one-element array, so that trailing text is an error and an
    empty object differs from a broken one. The generator keeps later filters above
    the parse; pushed below it they would parse every message again.
    """
    text = F.col(value)
    array = F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<{element}>", _STRICT)
    if named:
        array = array.cast(f"array<{named}>")
    parsed = messages.withColumn("_parsed", array)
    whole = F.when((F.size("_parsed") == 1) & _closed(text), F.col("_parsed"))
    return parsed.select(
        *[quoted(c) for c in messages.columns], F.explode_outer(whole).alias("event")
    )


def parse_json_map(messages: DataFrame, value: str = "value") -> DataFrame:
    """Every key of the message as ``map<string,string>``; nested values stay JSON
    text; the last of a repeated key wins."""
    parsed = _parse(messages, value, "map<string,string>")
    arrays = parsed.withColumns({"_keys": F.map_keys("event"), "_values": F.map_values("event")})
    return with_map(arrays, "_keys", "_values", "event").drop("_keys", "_values")


def parse_events(
    messages: DataFrame, value: str = "value", extra_keys: tuple[str, ...] = ()
) -> DataFrame:
    """The keys the enrichment reads, as a struct of strings. Keys nobody reads are
    skipped while parsing, so this is the path for volume."""
    keys = event_keys(extra_keys)
    element = T.StructType([T.StructField(k, T.StringType()) for k in keys])
    named = T.StructType([T.StructField(event_field(k), T.StringType()) for k in keys])
    # The cast to `named` goes by position: it renames twins such as url and URL.
    return _parse(messages, value, element.simpleString(), named.simpleString())


def event_sql(df: DataFrame, column: str = "event"):
    """Reader of event keys for a map or struct column, as SQL text; NULL for a key the
    struct lacks."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.MapType):
        return lambda key: f"{column}['{key}']"
    fields = set(dtype.fieldNames())
    return lambda key: (
        f"{column}.`{event_field(key)}`"
        if event_field(key) in fields
        else "CAST(NULL AS STRING)"
    )
