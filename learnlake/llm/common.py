"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from learnlake.session import shared_path

# Words are runs of characters other than space and the ASCII controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names based on ``names`` that ``df`` does not use in any letter case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        candidate = name
        while candidate.lower() in taken:
            candidate += "_"
        taken.add(candidate.lower())
        out.append(candidate)
    return out


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df`` as a table in the shared folder: later reads depend on no executor."""
    path = shared_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8(text: Column) -> Column:
    """The text as bytes, null as empty: what tasks in Python get without decoding it twice."""
    return F.coalesce(text, F.lit("")).cast("binary")


def in_slices(batches: Iterable[pa.RecordBatch], column: str, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` holds about ``most_bytes`` in each; a longer text is a slice of its own.

    A row counts 256 bytes besides its text, so slices of short texts have a bounded number of rows.
    """
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if held and held + n + 256 > most_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n + 256
        if start < len(sizes):
            yield batch.slice(start)
