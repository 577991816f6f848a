"""Categorical encoders. Fitted encoders are small plain values: the sorted categories per column."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.functions.columns import present
from learnlake.functions.ordering import positions, settled
from learnlake.operators.registry import CATEGORICAL

# Fixed value: the category that stands for a missing one.
UNKNOWN = "UNK"
# Categories that may become columns.
MOST_COLUMNS = 5_000


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(UNKNOWN))


def _distinct_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value) of all distinct categories, combined on the map side."""
    pairs = [F.struct(F.lit(c).alias("column"), _text(c).alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs))).distinct()


def fit_one_hot(df: DataFrame, columns: Sequence[str] | None = None, most: int = MOST_COLUMNS) -> dict[str, list[str]]:
    """Sorted categories per column; they name the output columns, hence they come to the driver.

    More than ``most`` of them are no schema: then ``fit_ordinal`` and ``one_hot_vectors`` do the same in one column.
    """
    columns = list(columns or present(df, CATEGORICAL))
    rows = _distinct_categories(df, columns).take(most + 1)
    if len(rows) > most:
        raise ValueError(f"over {most} categories in {columns}: use fit_ordinal and one_hot_vectors")
    return {c: sorted(r.value for r in rows if r["column"] == c) for c in columns}


def one_hot_vectors(df: DataFrame, fitted: DataFrame, columns: Sequence[str], name: str = "one_hot") -> DataFrame:
    """Add a sparse vector with a 1 per column at its category's position, for dictionaries of any size.

    ``fitted`` is that of ``fit_ordinal``. The columns' positions follow one another; unknown values are all 0.
    """
    columns = list(columns)
    sizes = {r["column"]: r["n"] for r in fitted.groupBy("column").agg(F.count("*").alias("n")).collect()}
    places = [f"{c}_place" for c in columns]
    coded = apply_ordinal(df, fitted, columns, "_place").withColumns({
        p: F.when(F.col(p) < 0, sizes.get(c, 0)).otherwise(F.col(p)).cast("double") for c, p in zip(columns, places, strict=True)})
    # The encoder learns the sizes from one row with the place after the last, which stands for unknown and is dropped.
    beyond = df.sparkSession.createDataFrame(
        [tuple(float(sizes.get(c, 0)) for c in columns)], ", ".join(f"`{p}` double" for p in places))
    vectors = [f"{c}_vector" for c in columns]
    encoder = OneHotEncoder(inputCols=places, outputCols=vectors, dropLast=True).fit(beyond)
    assembled = VectorAssembler(inputCols=vectors, outputCol=name).transform(encoder.transform(coded))
    return assembled.select(*df.columns, name)


def apply_one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace each column by 0/1 columns ``<column>_<category>``, appended last; unknown values are all 0."""
    rest = [c for c in df.columns if c not in categories]
    encoded = [
        (_text(c) == v).cast("double").alias(f"{c}_{v}") for c, values in categories.items() for v in values
    ]
    return df.select(*[F.col(f"`{c}`") for c in rest], *encoded)


def fit_ordinal(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Dimension (column, value, position): the index of each category in sorted order, for any number of them."""
    ranked = positions(_distinct_categories(df, columns), "column", "value")
    return ranked.select("column", "value", F.col("position").cast("int").alias("position"))


def apply_ordinal(df: DataFrame, fitted: DataFrame, columns: Sequence[str], suffix: str = "_ord") -> DataFrame:
    """Add ``<column><suffix>`` with the fitted position; -1 for values not seen in fitting."""
    fitted = settled(fitted)
    for c in columns:
        codes = fitted.filter(F.col("column") == c).select(
            F.col("value").alias("_value"), F.col("position").alias(c + suffix))
        df = df.join(codes, _text(c) == F.col("_value"), "left").drop("_value")
        df = df.withColumn(c + suffix, F.coalesce(c + suffix, F.lit(-1)))
    return df
