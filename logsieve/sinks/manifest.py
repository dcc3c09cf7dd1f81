"""Which folders of the log table are live, so that compaction switches at once.

Writers add folders (month / run / batch) and need no manifest: a folder is live unless a manifest says otherwise.
Compaction writes the rows of many folders anew into one of a run of its own, `compact-...`, which nobody reads yet.
Then it puts a new version of the manifest in place, one small file that appears whole by a rename that does
not overwrite: it names the folders that are replaced and the compacted ones that count. Readers take the highest
version. So they see the old folders or the new one, never both and never neither, wherever a job dies; what it
leaves behind is deleted by `vacuum`.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

FOLDER = "_manifest"
COMPACTED = "compact-"


class Conflict(RuntimeError):
    """Another job has replaced one of the folders, or put its version in place first."""


@dataclass(frozen=True)
class Manifest:
    """version: 0 if there is none yet. replaced: folders that no longer count. compacted: those of compaction
    that do. Folders are written relative to the table."""

    version: int = 0
    replaced: frozenset[str] = field(default_factory=frozenset)
    compacted: frozenset[str] = field(default_factory=frozenset)

    def is_live(self, folder: str) -> bool:
        if folder in self.replaced:
            return False
        return f"/run={COMPACTED}" not in f"/{folder}" or folder in self.compacted


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def last_version(spark: SparkSession, folder: str) -> dict | None:
    """What the highest version in a folder says."""
    place, system = _place(spark, folder)
    if not system.exists(place):
        return None
    names = [s.getPath().getName() for s in system.listStatus(place)]
    versions = sorted(n for n in names if n.endswith(".json") and not n.startswith("."))
    if not versions:
        return None
    stream = system.open(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place, versions[-1]))
    try:
        return json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def put_version(spark: SparkSession, folder: str, version: int, held: dict) -> None:
    """Put a version in place, whole or not at all; `Conflict` if another job was first."""
    jvm = spark.sparkContext._jvm
    place, system = _place(spark, folder)
    system.mkdirs(place)
    aside = jvm.org.apache.hadoop.fs.Path(place, f".{uuid.uuid4().hex}")
    final = jvm.org.apache.hadoop.fs.Path(place, f"{version:012d}.json")
    stream = system.create(aside, False)
    try:
        stream.write(bytearray(json.dumps(held).encode()))
    finally:
        stream.close()
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    keep = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        files.rename(aside, final, keep)
    except Exception as failure:
        system.delete(aside, False)
        if system.exists(final):
            raise Conflict(f"version {version} is taken") from failure
        raise


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    held = last_version(spark, f"{path.rstrip('/')}/{FOLDER}")
    if held is None:
        return Manifest()
    return Manifest(held["version"], frozenset(held["replaced"]), frozenset(held["compacted"]))


def commit(spark: SparkSession, path: str, new: Manifest) -> None:
    """Put the next version in place; `Conflict` if another job was first."""
    held = {"version": new.version, "replaced": sorted(new.replaced), "compacted": sorted(new.compacted)}
    put_version(spark, f"{path.rstrip('/')}/{FOLDER}", new.version, held)


def folders(spark: SparkSession, path: str, month: str = "*") -> list[str]:
    """The folders of batches that lie in the table, live or not, relative to it."""
    root, system = _place(spark, path.rstrip("/"))
    found = system.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, f"yyyymm={month}/run=*/batch_id=*"))
    return sorted("/".join(str(s.getPath()).split("/")[-3:]) for s in found or [])


def live_folders(spark: SparkSession, path: str, month: str = "*") -> list[str]:
    manifest = read_manifest(spark, path)
    return [f for f in folders(spark, path, month) if manifest.is_live(f)]


def read_folders(spark: SparkSession, path: str, chosen: list[str]) -> DataFrame:
    root = path.rstrip("/")
    return spark.read.option("basePath", root).parquet(*(f"{root}/{f}" for f in chosen))


def read_log_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the live folders. A table that was never compacted is simply read."""
    manifest = read_manifest(spark, path)
    if not manifest.version:
        return spark.read.parquet(path)
    return read_folders(spark, path, [f for f in folders(spark, path) if manifest.is_live(f)])
