"""CSV records whose quoted cells may hold line breaks, read in as many tasks as the file has splits.

Whether a line break ends a record depends on all the text before it. A line turns a state, inside a quoted cell or
not, into another one, and so does a split. One pass reads every split under both assumptions and returns a
row for it: how it ends, and where the records that cross its borders begin and end. These functions of two states are
composed over the splits of a file by window sums, which gives every split its real first state. With that, the
lines of records that cross a border are gathered by record, and all other lines are joined to records where they are.

If no record of any split spans lines, lines are records and the second pass has no Python in it. Otherwise whole lines
pass through Arrow batches; only lines with a quote are looked at one by one. The text is never shuffled but
for records that cross a border.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logsieve.operators.lookup import fits_broadcast
from logsieve.sources.lines import read_lines

# A row per split: its lines, the first one's id, and for both first states (0 outside, 1 inside a quoted
# cell) the last state, the line up to which a record from before reaches (only for 1), the line from which one
# reaches beyond, and how many records in between span lines. `start` and `first` are the file's first line with text.
SPLITS = (
    "file string, block long, n long, first_seq long, out0 int, out1 int, head long, tail0 long, tail1 long, "
    "breaks0 long, breaks1 long, start long, first string"
)


class Cells:
    """How a line ends, inside a quoted cell or not, given how it begins.

    A cell is quoted if it begins with a quote (in a lenient file after white space); its quotes are doubled. What
    follows its closing quote belongs to it up to the next comma. Quotes elsewhere are text."""

    def __init__(self, lenient: bool = False):
        space = r"[\x00-\x20]*+" if lenient else ""
        rest = r'[^"]*+(?:""[^"]*+)*+"[^,]*+'
        cell = rf'(?:{space}"{rest}|(?!{space}")[^,]*+)'
        self._from_outside = re.compile(rf"{cell}(?:,{cell})*+")
        self._from_inside = re.compile(rf"{rest}(?:,{cell})*+")

    def ends_inside(self, line: str, inside: bool) -> bool:
        found = (self._from_inside if inside else self._from_outside).match(line)
        return found is None or found.end() < len(line)


def csv_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """`read_lines` without the mark that some files begin with."""
    unmarked = F.when(F.col("block") == 0, F.regexp_replace("value", "^﻿", "")).otherwise(F.col("value"))
    return read_lines(spark, path).withColumn("value", unmarked)


@dataclass
class _Split:
    """What is known of a split so far."""

    file: str
    block: int
    first_seq: int
    n: int = 0
    head: int | None = None
    start: int | None = None
    first: str | None = None

    def __post_init__(self) -> None:
        self.state, self.tail, self.breaks = [0, 1], [None, None], [0, 0]

    def line(self, cells: Cells, text: str, seq: int) -> None:
        """Take a line that holds a quote."""
        for begun in (0, 1):
            before = self.state[begun]
            after = int(cells.ends_inside(text, bool(before)))
            if after and not before:
                self.tail[begun] = seq
            if before and not after:
                if begun and self.head is None:
                    self.head = seq
                else:
                    self.breaks[begun] += 1
                self.tail[begun] = None
            self.state[begun] = after

    def row(self) -> tuple:
        return (
            self.file, self.block, self.n, self.first_seq, *self.state, self.head, *self.tail, *self.breaks,
            self.start, self.first,
        )


def split_rows(lines: DataFrame, lenient: bool = False) -> DataFrame:
    """A row (SPLITS) for every split of the `csv_lines`."""
    names = [f.split()[0] for f in SPLITS.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    types = [kinds[f.split()[1]] for f in SPLITS.split(", ")]

    def batch_of(splits: list[_Split]) -> pa.RecordBatch:
        columns = zip(*(s.row() for s in splits))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, split = Cells(lenient), None
        for batch in batches:
            done = []
            seqs, values = batch.column(2).to_numpy(), batch.column(3)
            for at, end in _runs(batch):
                file, block = batch.column(0)[at].as_py(), batch.column(1)[at].as_py()
                if split is None or (split.file, split.block) != (file, block):
                    done += [split] if split else []
                    split = _Split(file, block, int(seqs[at]))
                split.n += end - at
                own = values.slice(at, end - at)
                if block == 0 and split.start is None:
                    filled = np.flatnonzero(pc.binary_length(own).to_numpy(zero_copy_only=False))
                    if len(filled):
                        split.start, split.first = int(seqs[at + filled[0]]), own[int(filled[0])].as_py()
                for i in np.flatnonzero(pc.match_substring(own, '"').to_numpy(zero_copy_only=False)).tolist():
                    split.line(cells, own[i].as_py(), int(seqs[at + i]))
            if done:
                yield batch_of(done)
        if split:
            yield batch_of([split])

    return lines.select("file", "block", "seq", "value").mapInArrow(run, SPLITS)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """From and to which row of a batch each split reaches."""
    seqs = batch.column(1).to_numpy()
    files = batch.column(0).dictionary_encode().indices.to_numpy()
    starts = np.flatnonzero(np.r_[True, (seqs[1:] != seqs[:-1]) | (files[1:] != files[:-1])]) if len(seqs) else []
    yield from zip(map(int, starts), map(int, [*starts[1:], len(seqs)]))


def split_states(splits: DataFrame) -> DataFrame:
    """Per split (file, block): `n`, `first_seq` and `start` as before, `inside` (its first state), `head` and
    `tail` for that state, `breaks`, and `opened`, the block in which the record that goes on in it began.

    What a split does with a state is to set, to keep or to turn it, so the state before a split is what the last
    setting split set, turned as often as splits have turned it since."""
    before = "OVER (PARTITION BY file ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    upto = "OVER (PARTITION BY file ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    turned = splits.selectExpr("*", f"sum(CASE WHEN out0 = 1 AND out1 = 0 THEN 1 ELSE 0 END) {upto} AS turns")
    states = turned.selectExpr(
        "*",
        f"""pmod(coalesce(last(CASE WHEN out0 = out1 THEN out0 + turns END, true) {before}, 0)
            + coalesce(last(turns) {before}, 0), 2) = 1 AS inside""",
    )
    known = states.selectExpr(
        "file", "block", "n", "first_seq", "start", "inside",
        "CASE WHEN inside THEN head END AS head",
        "CASE WHEN inside THEN tail1 ELSE tail0 END AS tail",
        "CASE WHEN inside THEN breaks1 ELSE breaks0 END AS breaks",
    )
    return known.selectExpr("*", f"last(CASE WHEN tail IS NOT NULL THEN block END, true) {before} AS opened")


def csv_records(lines: DataFrame, states: DataFrame, lenient: bool = False) -> DataFrame:
    """`value`: the text of every record of the `csv_lines` but the first of each file and empty ones. Line
    breaks in cells are line feeds. `states` are the `split_states` of the lines."""
    few = fits_broadcast(states)
    found = lines.join(F.broadcast(states) if few else states, ["file", "block"], "left")
    if not few:
        found = found.sortWithinPartitions("file", "block", "seq")
    place = F.col("seq") - F.col("first_seq")
    moved = F.raise_error(F.lit("the input's splits changed between two passes over it")).cast("boolean")
    here = F.when((place >= 0) & (place < F.col("n")), F.lit(True)).otherwise(moved)
    found = found.filter(here).withColumn("starts", F.coalesce(F.col("seq") == F.col("start"), F.lit(False)))
    at_head = F.expr("inside AND (head IS NULL OR seq <= head)")
    at_tail = F.expr("tail IS NOT NULL AND seq >= tail")
    within = found.filter(~at_head & ~at_tail).select("value", "starts")
    # One row per split: whether any record spans lines, and whether any crosses a border.
    spans, crosses = states.selectExpr("coalesce(max(breaks), 0) > 0", "coalesce(bool_or(inside OR tail IS NOT NULL), false)").first()
    whole = within.mapInArrow(_joiner(lenient), "value string, starts boolean") if spans else within
    if crosses:
        record = F.when(at_tail, F.col("block")).otherwise(F.col("opened"))
        parts = found.filter(at_head | at_tail).groupBy("file", record.alias("record"))
        part = F.sort_array(F.collect_list(F.struct("block", "seq", "value", "starts")))
        glued = parts.agg(part.alias("parts")).select(
            F.array_join("parts.value", "\n").alias("value"), F.get("parts.starts", F.lit(0)).alias("starts")
        )
        whole = whole.unionByName(glued)
    return whole.filter(~F.col("starts") & (F.col("value") != "")).select("value")


def _joiner(lenient: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, inside, begun = Cells(lenient), False, None
        for batch in batches:
            values, starts = batch.column(0), batch.column(1)
            quoted = np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False))
            before, after, at = np.zeros(len(values), dtype=bool), inside, 0
            for i in quoted.tolist():
                before[at : i + 1] = after
                after, at = cells.ends_inside(values[i].as_py(), after), i + 1
            before[at:] = after
            first = np.flatnonzero(~before)  # the lines that begin a record
            if begun is None and not after and len(first) == len(values):
                yield batch
                continue
            text, flags = values.to_pylist(), starts.to_pylist()
            ends = [*first[1:].tolist(), len(text)]
            records, marks = [], []
            if begun is not None:
                goes_on = int(first[0]) if len(first) else len(text)
                begun = (begun[0] + text[:goes_on], begun[1])
                if len(first) or not after:
                    records.append("\n".join(begun[0]))
                    marks.append(begun[1])
                    begun = None
            for a, b in zip(first.tolist(), ends):
                if b == len(text) and after:
                    begun = (text[a:b], flags[a])
                else:
                    records.append("\n".join(text[a:b]))
                    marks.append(flags[a])
            inside = after
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.string()), pa.array(marks, pa.bool_())], names=["value", "starts"])

    return run
