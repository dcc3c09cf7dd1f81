"""Text lines that remember where they came from, so that any of them can be numbered."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from logsieve.operators.lookup import fits_broadcast


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line: `value`, its `file`, the split of the file it was read in
    (`block`) and an id that counts up within the split (`seq`).

    Lines end at a line feed; a carriage return before it is dropped.
    """
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.regexp_replace("value", "\r$", "").alias("value"),
    )


def block_offsets(lines: DataFrame) -> DataFrame:
    """Per split of a file: its number of lines, the first `seq` in it and the number of
    lines before it. One row per split (some 100 MB of text), from a pass that only
    counts. Persist it when it is used more than once."""
    blocks = lines.groupBy("file", "block").agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq")
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return blocks.withColumn("lines_before", F.coalesce(F.sum("n").over(before), F.lit(0)))


def with_line_numbers(some_lines: DataFrame, offsets: DataFrame) -> DataFrame:
    """Add `line`, the 1-based number of each line in its file, to a selection of lines;
    `offsets` are the `block_offsets` of all of them.

    Nothing is sorted: a line's number is the count of lines before its split plus its
    place in the split. The splits are broadcast while they are few; beyond that they
    are joined by a shuffle, in which a group is one split's lines and so no larger
    than a split. Both passes must see the same splits; should the files or the split
    settings change in between, the job fails instead of numbering wrongly.
    """
    if fits_broadcast(offsets):
        offsets = F.broadcast(offsets)
    place = F.col("seq") - F.col("first_seq")
    moved = F.raise_error(F.lit("the input's splits changed between two passes over it"))
    number = F.when((place >= 0) & (place < F.col("n")), F.col("lines_before") + place + 1)
    return (
        some_lines.join(offsets, ["file", "block"], "left")
        .withColumn("line", F.coalesce(number, moved.cast("bigint")))
        .drop("n", "first_seq", "lines_before")
    )
