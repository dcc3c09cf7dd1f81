"""Upkeep of the written tables: months, retention, latest versions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.operators.lookup import latest_per

RETENTION_DAYS = 90


def month_of(date: Column) -> Column:
    """The partition value of a date, such as 202401."""
    return (F.year(date) * 100 + F.month(date)).cast("int")


def retained(logs: DataFrame, as_of: dt.date, days: int = RETENTION_DAYS) -> DataFrame:
    """Rows no older than `days` before `as_of`, the boundary day included. Rows without
    a date are as old as their insertion, where the table has its time (`_inserted_at`), else
    they stay. Where the table is partitioned by month, older months are not even listed."""
    horizon = as_of - dt.timedelta(days=days)
    age = F.col("date")
    if "_inserted_at" in logs.columns:
        age = F.coalesce(age, F.to_date("_inserted_at"))
    kept = logs.filter(age.isNull() | (age >= F.lit(horizon)))
    if "yyyymm" in logs.columns:
        first = horizon.year * 100 + horizon.month
        kept = kept.filter(F.col("yyyymm").isNull() | (F.col("yyyymm") >= first))
    return kept


def expired_months(logs: DataFrame, as_of: dt.date, days: int = RETENTION_DAYS) -> DataFrame:
    """Months that lie wholly before the horizon: their partitions can be dropped
    without reading them."""
    horizon = as_of - dt.timedelta(days=days)
    return (
        logs.select("yyyymm").distinct().filter(F.col("yyyymm") < horizon.year * 100 + horizon.month)
    )


def rows_by_month(logs: DataFrame) -> DataFrame:
    return logs.groupBy("yyyymm").agg(F.count(F.lit(1)).alias("n"))


def latest_tools(versions: DataFrame) -> DataFrame:
    """Of each (tool_id, url) the row with the latest `updated_at`."""
    return latest_per(versions, ["tool_id", "url"], ["updated_at"])
