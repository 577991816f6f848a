"""Batch sources and sinks: CSV in, parquet tiers in and out, provenance columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from learnlake.operators.features import COURSE
from learnlake.sources import quoted_csv

# Order of the rows within a Bronze table, as in the files they came from: a table is usually a folder of parts.
FILE_ORDER = ["_source_path", "_source_block", "_ingest_seq"]
# Texts that mean a missing value, as the usual CSV readers take them.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)
# What the text of a typed column looks like, narrowest type first; whole numbers also have to fit a long.
WHOLE = r"^[+-]?[0-9]+$"
PATTERNS = {
    "bigint": WHOLE,
    "double": r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$",
    "boolean": r"^([Tt]rue|TRUE|[Ff]alse|FALSE)$",
}
PROVENANCE = ["_ingest_ts", "_source_file", "_source_system", "_source_path", "_source_block", "_ingest_seq"]


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, infer: bool = True,
    multi_line: bool | str = False, na_tokens: Sequence[str] = NA_TOKENS,
) -> DataFrame:
    """CSV with a header row; fields may be quoted, a quote inside is doubled, and ``na_tokens`` are null.

    With a schema, the header has to match it. Otherwise all columns are text, or with ``infer`` get the
    narrowest of long, double, boolean and text that holds every value, at the price of one more pass. Whole numbers
    too long for a long stay text, so that no two ids become one. ``multi_line`` allows line breaks in quoted
    fields, one task per file; "split" does so in any number of tasks, without file metadata.
    """
    if multi_line == "split":
        return _read_split(spark, path, schema, infer, na_tokens)
    reader = spark.read.options(header=True, nullValue="", enforceSchema=False, quote='"', escape='"', multiLine=multi_line)
    if schema is not None:
        wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        text = StructType([StructField(f.name, StringType(), True, f.metadata) for f in wanted.fields])
        return _typed(_without_na(reader.schema(text).csv(path), na_tokens), wanted)
    raw = _without_na(reader.csv(path), na_tokens)
    return _with_inferred_types(raw) if infer else raw


def _typed(raw: DataFrame, wanted: StructType) -> DataFrame:
    return raw.select(*[
        F.col(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, StringType)
        else F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted.fields])


def _read_split(
    spark: SparkSession, path: str, schema: StructType | str | None, infer: bool, na_tokens: Sequence[str]
) -> DataFrame:
    """Quoted line breaks in any number of tasks; the header row itself has none."""
    header = spark.read.options(header=True, quote='"', escape='"').csv(path).columns
    raw = _without_na(quoted_csv.parsed(quoted_csv.records(spark, path), header).select(*[f"`{c}`" for c in header]), na_tokens)
    if schema is not None:
        wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        if [f.name for f in wanted.fields] != header:
            raise ValueError(f"header {header} does not match {[f.name for f in wanted.fields]}")
        return _typed(raw, wanted)
    return _with_inferred_types(raw) if infer else raw


def _without_na(raw: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """Missing-value texts as null; file metadata stays reachable."""
    return raw.select(*[F.when(~F.col(f"`{c}`").isin(*tokens), F.col(f"`{c}`")).alias(c) for c in raw.columns])


def _with_inferred_types(raw: DataFrame) -> DataFrame:
    """Spark's own inference would read a presentation code like 2014D as a double, and day texts as dates."""
    candidates = list(PATTERNS)

    def unfit(c: str, kind: str) -> Column:
        text = F.trim(F.col(f"`{c}`"))
        if kind == "bigint":
            return text.isNotNull() & ~(text.rlike(WHOLE) & text.try_cast("bigint").isNotNull())
        # A whole number beyond a long would lose digits as a double.
        return ~text.rlike(PATTERNS[kind]) | (text.rlike(WHOLE) & text.try_cast("bigint").isNull())

    fits = raw.agg(*[
        F.count_if(unfit(c, kind)).alias(f"{i}_{kind}") for i, c in enumerate(raw.columns) for kind in candidates
    ]).first()
    typed = []
    for i, c in enumerate(raw.columns):
        kind = next((k for k in candidates if fits[f"{i}_{k}"] == 0), "string")
        value = F.col(f"`{c}`") if kind == "string" else F.trim(F.col(f"`{c}`")).cast(kind)
        typed.append(value.alias(c))
    return raw.select(*typed)


def stamp_provenance(
    df: DataFrame, source_system: str, source_file: str | None = None, from_files: bool = True
) -> DataFrame:
    """Add ingest time, source and, for rows read from files, their place in the file.

    File order is (path, byte offset of the split, running number); ``source_file`` is only a label. The running
    number alone would follow the order in which Spark packs splits into tasks, which is by size.
    """
    name = F.lit(source_file) if source_file is not None else F.col("_metadata.file_name")
    stamps = {
        "_ingest_ts": F.date_trunc("second", F.current_timestamp()),
        "_source_file": name,
        "_source_system": F.lit(source_system),
    }
    if from_files:
        stamps |= {
            "_source_path": F.col("_metadata.file_path"),
            "_source_block": F.col("_metadata.file_block_start"),
            "_ingest_seq": F.monotonically_increasing_id(),
        }
    return df.select("*", *[c.alias(n) for n, c in stamps.items()])


def dataset_name(path: str) -> str:
    return PurePosixPath(path).stem


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> str:
    """Overwrite a parquet folder; partition columns are spread over tasks by AQE, not by one task per value."""
    columns = list(partition_by)
    writer = (df.hint("rebalance", *columns) if columns else df).write.mode("overwrite")
    (writer.partitionBy(*columns) if columns else writer).parquet(path)
    return path


def write_gold(df: DataFrame, path: str) -> str:
    """Gold is partitioned by course, so that scoring one course prunes the rest."""
    return write_parquet(df, path, COURSE)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """Gold with text partition columns, whatever a presentation code looks like (2014D is no double).

    Stating the schema does that in any session; both reads are lazy.
    """
    schema = spark.read.parquet(path).schema
    stated = StructType([StructField(f.name, StringType()) if f.name in COURSE else f for f in schema.fields])
    return spark.read.schema(stated).parquet(path)


def ingest_csv(
    spark: SparkSession,
    source_dir: str,
    bronze_dir: str,
    filenames: Iterable[str],
    schemas: Mapping[str, StructType | str] | None = None,
    source_system: str = "csv",
    infer: bool = True,
    multi_line: bool = False,
) -> dict[str, str]:
    """Land each CSV file in Bronze; returns dataset name -> path.

    Without inference Bronze holds the text as it came, and contracts type it on the way to Silver. ``multi_line``
    is that of ``read_csv``.
    """
    written = {}
    for filename in filenames:
        name = dataset_name(filename)
        raw = read_csv(spark, f"{source_dir}/{filename}", (schemas or {}).get(name), infer, multi_line)
        written[name] = write_parquet(
            stamp_provenance(raw, source_system, filename), f"{bronze_dir}/{name}.parquet")
    return written
