"""Streaming ingest of LMS events into Bronze.

Stateless and append-only: the file sink and its checkpoint make every message land exactly once, also
after a restart or a lost executor.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from learnlake.sources.events import parse_events
from learnlake.sources.tables import stamp_provenance

BATCH_SECONDS = 30


def kafka_source(spark: SparkSession, bootstrap_servers: str, topic: str, **options: str) -> DataFrame:
    """Raw messages of a topic, its backlog first; needs the Kafka connector of the Spark distribution.

    ``startingOffsets`` only counts for the first start; later ones go on from the checkpoint.
    """
    options = {"startingOffsets": "earliest"} | options
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap_servers)
    return reader.option("subscribe", topic).options(**options).load()


def file_source(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Messages as lines of text files that appear in a folder."""
    return spark.readStream.format("text").option("maxFilesPerTrigger", files_per_trigger).load(path)


def bronze_events(messages: DataFrame, topic: str, source_system: str = "lms_events") -> DataFrame:
    """Parsed and stamped events; the topic stands in for the file name."""
    return stamp_provenance(parse_events(messages), source_system, topic, from_files=False)


def land(
    events: DataFrame, path: str, checkpoint: str, available_now: bool = False, seconds: int = BATCH_SECONDS
) -> StreamingQuery:
    """Append micro-batches to a parquet folder; ``available_now`` drains the source and stops."""
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{seconds} seconds"}
    return (
        events.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(**trigger).start(path)
    )
