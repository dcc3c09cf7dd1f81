"""The tools dimension from files or a database table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logsieve.operators.lookup import TOOL_COLUMNS

# Without these the lookup would match nothing and every event would be dropped.
_REQUIRED = {"id", "url", "has_ai"}


def checked_tools(tools: DataFrame) -> DataFrame:
    """Only the columns the lookup uses; an error when an essential one is missing."""
    missing = _REQUIRED - set(tools.columns)
    if missing:
        raise ValueError(f"the tools source lacks {', '.join(sorted(missing))}")
    return tools.select(*[c for c in TOOL_COLUMNS if c in tools.columns])


def tools_loader(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> Callable[[], DataFrame]:
    """A function that reads the dimension afresh, for streams that refresh it with
    every micro-batch. A source that cannot be read is an error, not an empty lookup."""

    def load() -> DataFrame:
        reader = spark.read.format(fmt)
        if fmt == "csv":
            reader = reader.option("header", True)
        return checked_tools(reader.options(**options).load(path))

    return load


def jdbc_tools(spark: SparkSession, url: str, table: str, **properties) -> Callable[[], DataFrame]:
    """The same from a database table; only the needed columns are asked for."""

    def load() -> DataFrame:
        reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
        return checked_tools(reader.load())

    return load
