"""Use of the whole cluster for sources that cannot be split."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(source: DataFrame, parts: int | None = None) -> DataFrame:
    """The rows dealt out to `parts` tasks (default: one per core), by the caller's choice.

    This is a shuffle of what the source reads. A topic is better read with its
    `min_partitions` option and files in smaller splits; only a few unsplittable files
    before costly work are worth it.
    """
    return source.repartition(parts or source.sparkSession.sparkContext.defaultParallelism)
