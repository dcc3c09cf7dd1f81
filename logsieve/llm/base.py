"""What the operators share: reading tables, cutting lineage, adding columns by Arrow batches."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsieve.session import shared_folder

# Arrow batches are handled in slices of about this many bytes of text (one row at least).
SLICE_BYTES = 2 << 20
# Bytes of an Arrow batch while a table is written: the JVM and the worker both hold one for each task.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: a later loss of executors
    recomputes nothing before it. The table is deleted when the session's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/logsieve-{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(BATCH_BYTES))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH, before)
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a written table that nothing reads any more."""
    files = df.inputFiles()
    if files:
        spark = df.sparkSession
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def without(df: DataFrame, names: list[str]) -> list[str]:
    """The columns of ``df`` but for those named like one of ``names`` (in any case)."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def columns(df: DataFrame, names: list[str]) -> list:
    return [F.col(quoted(n)) for n in names]


def slices(batch: pa.RecordBatch, sizes: list[int] | None, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most ``most`` summed sizes, one row at least."""
    start, total = 0, 0
    for i, n in enumerate(sizes or ()):
        if total and total + n > most:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def text_sizes(array: pa.Array) -> list[int]:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(array), 0).to_pylist()


Batches = Iterator[pa.RecordBatch]


def released(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """A function of Arrow batches that in the end gives memory that is free back to the system: workers live
    on, and stages of other kinds share an executor with them."""

    def wrapped(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass

    return wrapped


def with_arrow_columns(
    df: DataFrame,
    text: str,
    added: T.StructType,
    make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
    most: int = SLICE_BYTES,
    after: Callable[[], None] = lambda: None,
) -> DataFrame:
    """``df`` with columns that a function of the text column gives, slice by slice.

    ``make`` runs once per task and gives the function, which takes the texts of a slice and
    returns one array for each field of ``added``. Columns of ``df`` that are named like an added
    one are replaced. Nothing is shuffled and no more than a slice is held beside its batch. ``after`` is
    called when a task is done."""
    kept = without(df, added.fieldNames())
    hidden = "__arrow_text"
    source = df.select(*columns(df, kept), F.col(quoted(text)).alias(hidden))
    schema = T.StructType([*(df.schema[c] for c in kept), *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = make()
        for batch in batches:
            for part in slices(batch, text_sizes(batch.column(len(kept))), most):
                arrays = function(part.column(len(kept)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(kept)], *arrays], names=[f.name for f in schema.fields]
                )
        after()

    return source.mapInArrow(released(run), schema)


def binary(array: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text, null as empty."""
    kind = pa.large_binary() if pa.types.is_large_string(array.type) else pa.binary()
    return [x or b"" for x in array.cast(kind).to_pylist()]


def lists(values, lengths, kind: pa.DataType) -> pa.Array:
    """A list array of ``kind`` from all values in a row and the lengths of the lists."""
    import numpy as np

    ends = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, type=kind))
