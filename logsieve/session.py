"""What the package asks of a session that somebody else owns."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Render timestamps in UTC. No other session setting is relied upon."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_location(spark: SparkSession, name: str, explicit: str | None = None) -> str:
    """Folder for a streaming query's progress: the caller's, else one under the
    shared folder the cluster names in ``spark.checkpoint.dir``."""
    if explicit:
        return explicit
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise ValueError(
            "pass a checkpoint folder or set spark.checkpoint.dir to a shared one; "
            "a machine-local folder would be lost with its machine"
        )
    return f"{shared.rstrip('/')}/{name}"


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share. Where it is unset, a local
    session gets one of its own; on a cluster a machine-local folder would miss what other machines write."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="logsieve-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, deleted at the latest when the session's JVM ends."""
    path = f"{shared_folder(spark)}/logsieve-{label}-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def kept(df: DataFrame, label: str) -> DataFrame:
    """A small frame as a table in the shared folder: worked out once, and as it is now."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
