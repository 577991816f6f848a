"""LMS events: the message schema and its parsing, the same for batch and stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fields of an event message and of its JSON payload.
EVENT_SCHEMA = (
    "id_student long, event_type string, code_module string, code_presentation string, id_site long, "
    "ts string, payload string"
)
PAYLOAD_SCHEMA = "duration long"
_CORRUPT = "_corrupt_record"


def parse_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """One row per message: its fields, ``ts`` as timestamp, ``payload`` as struct.

    A message that is not valid JSON keeps its text in ``_bad_message`` and has null fields.
    """
    text = F.col(value).cast("string")
    schema = f"{EVENT_SCHEMA}, {_CORRUPT} string"
    parsed = messages.select(
        F.from_json(text, schema, {"columnNameOfCorruptRecord": _CORRUPT, "mode": "PERMISSIVE"}).alias("e"),
        text.alias("_text"),
    )
    return parsed.select(
        "e.id_student", "e.event_type", "e.code_module", "e.code_presentation", "e.id_site",
        F.col("e.ts").try_cast("timestamp").alias("ts"),
        F.from_json("e.payload", PAYLOAD_SCHEMA).alias("payload"),
        F.coalesce(f"e.{_CORRUPT}", F.when(F.col("e").isNull(), F.col("_text"))).alias("_bad_message"),
    )
