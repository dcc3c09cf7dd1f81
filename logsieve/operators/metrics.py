"""Counts: processed and failed, windows, header profiles, and the books that balance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from logsieve.functions.text import normalize_header
from logsieve.sources.files import Rows, filled


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def _counters(failed: Column) -> list[Column]:
    return [
        F.count(F.lit(1)).alias("processed"),
        F.count_if(failed).alias("failed"),
    ]


def parse_metrics(parsed: DataFrame, failed: Column) -> DataFrame:
    """Lines processed and lines failed, as a one-row frame."""
    return parsed.agg(*_counters(failed))


def observe_parse(parsed: DataFrame, failed: Column) -> tuple[DataFrame, Observation]:
    """The same counters as a by-product of whatever action runs on the returned frame.
    Run one action only: each one would count again."""
    observation = Observation()
    return parsed.observe(observation, *_counters(failed)), observation


def window_counts(events: DataFrame, ts: str, seconds: int = 30) -> DataFrame:
    """Events per tumbling window; windows without events do not appear."""
    return (
        events.groupBy(F.window(ts, f"{seconds} seconds").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")
    )


def header_report(rows: Rows) -> DataFrame:
    """Per column: 1-based position, header, its normalised form, and how many rows
    fill it. One aggregate pass, turned from one wide row into one row per column."""
    counts = rows.df.agg(*[F.count_if(filled(c)).alias(f"c{i}") for i, c in enumerate(rows.cells())])
    lines = F.array(
        *[
            F.struct(
                F.lit(i + 1).cast("bigint").alias("pos"),
                F.lit(h).alias("header"),
                F.col(f"c{i}").alias("non_empty_rows"),
            )
            for i, h in enumerate(rows.headers)
        ]
    )
    return counts.select(F.inline(lines)).select(
        "pos", "header", normalize_header(F.col("header")).alias("normalized"), "non_empty_rows"
    )


def reconcile(classified: DataFrame) -> DataFrame:
    """What was read against what became of it: kept, rejected as unreadable, dropped.
    `read` is counted on its own, so the books balance or show the difference."""
    return classified.agg(*_books())


def observe_books(classified: DataFrame) -> tuple[DataFrame, Observation]:
    """`reconcile` as a by-product of the one action that runs on the returned frame."""
    observation = Observation()
    return classified.observe(observation, *_books()), observation


def _books() -> list[Column]:
    reason = F.col("reason")
    return [
        F.count(F.lit(1)).alias("read"),
        F.count_if(reason == "kept").alias("kept"),
        F.count_if(reason == "bad_json").alias("rejected"),
        F.count_if(reason.isin("no_url", "no_match", "not_ai")).alias("dropped"),
    ]
