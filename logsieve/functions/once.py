"""Costly expressions evaluated once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add (or replace) a column whose expression later filters cannot be pushed into.

    Filters, and the ones the optimizer infers from joins and generators, move below a
    projection by repeating its expressions. They do not move below a generator, so the
    value goes through one that yields exactly one row.
    """
    others = [quoted(c) for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(value)).alias(name))


def quoted(name: str) -> str:
    """A column name as it has to be written where dots would mean fields."""
    return "`" + name.replace("`", "``") + "`"
