"""Exploratory profiles and the dataset fingerprint."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distribution(df: DataFrame, column: str) -> DataFrame:
    """Row count and relative frequency of each non-null value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    total = df.agg(F.count(column)).scalar()
    return counts.withColumn("share", F.try_divide("n", total))


def clicks_per_day(student_vle: DataFrame) -> DataFrame:
    """Total clicks of all students per relative day."""
    return (
        student_vle.filter(F.col("date").isNotNull())
        .groupBy("date").agg(F.coalesce(F.sum("sum_click"), F.lit(0)).alias("clicks"))
    )


def table_shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table; all counts in one job."""
    parts = [
        df.agg(F.count("*").alias("n_rows")).select(
            F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def head(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """The first rows in a stated order."""
    return df.orderBy(*order_by).limit(n)


def fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(n_rows, digest): the same for the same rows in any order or partitioning.

    A row is hashed as JSON that keeps names, nulls and the bounds of texts. The digest adds up both halves of the
    rows' MD5, 128 bits in two sums, so it combines on the map side.
    """
    columns = list(columns or df.columns)
    text = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in columns]), {"ignoreNullFields": "false"})
    halves = [F.conv(F.substring(F.md5(text), at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17)]
    sums = [F.coalesce(F.sum(half), F.lit(0)).cast("decimal(38,0)").cast("string") for half in halves]
    return df.agg(F.count("*").alias("n_rows"), F.concat_ws("-", *sums).alias("digest"))
