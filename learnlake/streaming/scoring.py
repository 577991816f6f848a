"""Streaming scoring of student records: the batch transformation on a streaming frame."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.operators.score import RECORD_SCHEMA, REQUIRED, complete_record, score
from learnlake.operators.train import Manifest


QUARANTINE = "quarantined"


def parse_records(messages: DataFrame, value: str = "value") -> DataFrame:
    """Student records from JSON messages, defaults filled in; no message is dropped.

    ``quarantined`` holds the message itself where a required field is missing or it is no JSON, else null.
    """
    raw = F.col(value).cast("string")
    parsed = messages.select(raw.alias("_message"), F.from_json(raw, RECORD_SCHEMA).alias("r")).select("_message", "r.*")
    bad = reduce(Column.__or__, [F.col(c).isNull() for c in REQUIRED])
    return complete_record(parsed, keep={QUARANTINE: F.when(bad, F.coalesce("_message", F.lit("")))})


def score_stream(messages: DataFrame, model: PipelineModel, manifest: Manifest) -> DataFrame:
    """Scored records; stateless, so it can be written with ``bronze.land`` in append mode.

    A quarantined message keeps its place with null scores, so that it can be sent again.
    """
    keys = ["id_student", "code_module", "code_presentation", QUARANTINE]
    scored = score(parse_records(messages), model, manifest, keys)
    good = F.col(QUARANTINE).isNull()
    return scored.withColumns({c: F.when(good, F.col(c)) for c in ("risk_score", "risk_label")})
