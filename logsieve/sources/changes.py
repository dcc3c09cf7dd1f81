"""The tools dimension as keyed state that a feed of changes keeps up to date.

The state holds the latest change of every tool, deletions as marks, dealt to buckets by the tool's id. A batch of
changes rewrites only the buckets that it touches, beside the old ones, and then puts a new version in place: one
small file that names the folder of every bucket. A version is seen whole or not at all, a batch that is applied again
changes nothing, and a change that is older than what the state holds has no effect.

Readers keep the lookup of the version they have. As long as the version stays, nothing is read or measured again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logsieve.operators.lookup import TOOL_COLUMNS, PreparedTools, fits_broadcast, latest_per, tools_by_key
from logsieve.session import checkpoint_location
from logsieve.sinks.manifest import last_version, put_version
from logsieve.sources.tools import checked_tools

BUCKETS = 16
_VERSIONS = "_versions"
# A change of a tool, and the state: the last change of each, by what names the tool.
CHANGES = (
    "id bigint, name string, url string, has_ai string, ai_category string, score double, risk string, "
    "updated_at timestamp, deleted boolean"
)
_STATE = f"tool string, {CHANGES}, bucket int"
_KINDS = {"id": "bigint", "score": "double", "updated_at": "timestamp"}


class ToolDimension:
    """The state in the folder `path`."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._held: tuple[int, PreparedTools] | None = None

    def _version(self) -> dict:
        return last_version(self.spark, f"{self.path}/{_VERSIONS}") or {"version": 0, "buckets": {}, "applied": {}}

    def version(self) -> int:
        return self._version()["version"]

    def apply(self, changes: DataFrame, batch_id: int | None = None, feed: str = "changes") -> int:
        """Take changes of tools (columns as the dimension's, and `deleted` if it is a deletion) into the
        state; returns its version. A batch that its feed has applied before is left out, and a
        change without a time counts from now on. Of one tool the latest change holds."""
        known = self._version()
        if batch_id is not None and known["applied"].get(feed, -1) >= batch_id:
            return known["version"]
        rows = _normal(changes).persist()
        try:
            touched = [r.bucket for r in rows.select("bucket").distinct().collect()]  # BUCKETS at most
            applied = {**known["applied"], **({} if batch_id is None else {feed: batch_id})}
            if not touched and applied == known["applied"]:
                return known["version"]
            folder, buckets = f"v{known['version'] + 1}-{uuid.uuid4().hex}", dict(known["buckets"])
            if touched:
                old = [buckets[str(b)] for b in touched if str(b) in buckets]
                state = self._read(old).withColumn("later", F.lit(0)).unionByName(rows.withColumn("later", F.lit(1)))
                latest = latest_per(state, ["tool"], ["updated_at", "later"]).drop("later")
                latest.write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
                buckets.update({str(b): f"{folder}/bucket={b}" for b in touched})
            # A batch without changes is only noted; readers keep what they have.
            version = known["version"] + 1
            same = known.get("data", known["version"]) if not touched else version
            put_version(self.spark, f"{self.path}/{_VERSIONS}", version, {"version": version, "data": same, "buckets": buckets, "applied": applied})
            return version
        finally:
            rows.unpersist()

    def _read(self, chosen: list[str]) -> DataFrame:
        if not chosen:
            return self.spark.createDataFrame([], _STATE)
        reader = self.spark.read.schema(_STATE)
        parts = [reader.parquet(f"{self.path}/{f}").withColumn("bucket", F.lit(int(f.rsplit("=", 1)[1]))) for f in chosen]
        whole = parts[0]
        for part in parts[1:]:
            whole = whole.unionByName(part)
        return whole

    def tools(self) -> DataFrame:
        """The tools that are not deleted, as they are now."""
        state = self._read(sorted(self._version()["buckets"].values()))
        return state.filter("NOT deleted").select(*TOOL_COLUMNS)

    def current(self) -> PreparedTools:
        """The lookup of the current version, for `start_enrichment`: built and measured once per version."""
        known = self._version()
        data = known.get("data", known["version"])
        if self._held is None or self._held[0] != data:
            state = self._read(sorted(known["buckets"].values())).filter("NOT deleted").select(*TOOL_COLUMNS)
            lookup = tools_by_key(state).persist()
            prepared = PreparedTools(lookup, fits_broadcast(lookup))
            if self._held:
                self._held[1].by_key.unpersist()
            self._held = (data, prepared)
        return self._held[1]

    def follow(
        self, changes: DataFrame, checkpoint: str | None = None, seconds: int = 30, drain: bool = False, feed: str = "changes"
    ) -> StreamingQuery:
        """Apply a stream of changes, batch by batch."""

        def run(batch: DataFrame, batch_id: int) -> None:
            self.apply(batch, batch_id, feed)

        writer = changes.writeStream.foreachBatch(run).option(
            "checkpointLocation", checkpoint_location(self.spark, f"tool-changes-{feed}", checkpoint)
        )
        return writer.trigger(**({"availableNow": True} if drain else {"processingTime": f"{seconds} seconds"})).start()


def _normal(changes: DataFrame) -> DataFrame:
    """The latest change of each tool in a batch, in the columns of the state."""
    given = checked_tools(changes)
    columns = [F.col(c).cast(_KINDS.get(c, "string")) if c in given.columns else F.lit(None).cast(_KINDS.get(c, "string")) for c in TOOL_COLUMNS]
    deleted = F.coalesce(F.col("deleted").cast("boolean"), F.lit(False)) if "deleted" in changes.columns else F.lit(False)
    rows = changes.select(*(c.alias(n) for c, n in zip(columns, TOOL_COLUMNS)), deleted.alias("deleted"))
    rows = rows.withColumns(
        {
            "updated_at": F.coalesce("updated_at", F.current_timestamp()),
            # A tool without an id is known by its url.
            "tool": F.coalesce(F.col("id").cast("string"), F.concat(F.lit("url:"), F.lower("url"))),
        }
    ).filter("tool IS NOT NULL")
    latest = latest_per(rows, ["tool"], ["updated_at"])
    return latest.withColumn("bucket", F.pmod(F.xxhash64("tool"), F.lit(BUCKETS)).cast("int"))
