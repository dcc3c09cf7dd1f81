"""Message topics. Reading needs Spark's Kafka connector on the class path; everything
downstream takes any DataFrame with a `value` column."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TopicOptions:
    brokers: str = "localhost:9092"
    topic: str = "log-processing"
    group_id: str | None = None
    starting_offsets: str = "latest"
    # Rate limits: at most this many messages per micro-batch, in this many tasks or more.
    max_per_batch: int | None = 5_000_000
    min_partitions: int | None = None

    def reader_options(self) -> dict[str, str]:
        options = {
            "kafka.bootstrap.servers": self.brokers,
            "subscribe": self.topic,
            "startingOffsets": self.starting_offsets,
        }
        if self.group_id:
            options["kafka.group.id"] = self.group_id
        if self.max_per_batch:
            options["maxOffsetsPerTrigger"] = str(self.max_per_batch)
        if self.min_partitions:
            options["minPartitions"] = str(self.min_partitions)
        return options

    def writer_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.brokers, "topic": self.topic}


def read_topic(spark: SparkSession, options: TopicOptions) -> DataFrame:
    """Stream of message values as text."""
    source = spark.readStream.format("kafka").options(**options.reader_options()).load()
    return source.select(F.col("value").cast("string").alias("value"))


def topic_writer(options: TopicOptions):
    """Writer of `value` rows to a topic, for `sinks.messages.publish`."""

    def write(values: DataFrame) -> None:
        values.write.format("kafka").options(**options.writer_options()).save()

    return write
