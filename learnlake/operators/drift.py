"""Population stability between a training and a serving frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.functions.columns import numeric_columns
from learnlake.functions.ordering import cuts_passed, exact_quantiles

# Added to every bin share so that an empty bin has a finite logarithm; drift threshold.
EPSILON = 1e-9
THRESHOLD = 0.2


def _inner_edges(expected: DataFrame, features: Sequence[str], bins: int) -> dict[str, list[float]]:
    """The quantiles between the outermost ones, which stand for minus and plus infinity."""
    return exact_quantiles(expected, features, [i / bins for i in range(1, bins)])


def _bin_counts(expected: DataFrame, actual: DataFrame, features: list[str], bins: int) -> DataFrame:
    """(feature, e, a): arrays of row counts per bin. The data are shuffled as one row per bin and map task."""
    edges = _inner_edges(expected, features, bins)
    both = _binned(expected, features, edges, True).unionByName(_binned(actual, features, edges, False))
    cells = both.groupBy("feature", "bin", "is_expected").agg(F.count("*").alias("n"))

    def counts(side: Column) -> Column:
        return F.array(*[
            F.coalesce(F.sum(F.when(side & (F.col("bin") == b), F.col("n"))), F.lit(0)) for b in range(bins)])

    counted = cells.groupBy("feature").agg(
        counts(F.col("is_expected")).alias("e"), counts(~F.col("is_expected")).alias("a"))
    # A feature without any value still gets its line.
    every = expected.sparkSession.createDataFrame([(f,) for f in features], "feature string")
    none = F.array_repeat(F.lit(0).cast("bigint"), bins)
    return every.join(counted, "feature", "left").select(
        "feature", F.coalesce("e", none).alias("e"), F.coalesce("a", none).alias("a"))


def psi_bins(
    expected: DataFrame, actual: DataFrame, features: Sequence[str], bins: int = 10
) -> DataFrame:
    """(feature, bin, n_expected, n_actual): rows per quantile bin of the expected side.

    A value belongs to the bin after the last edge not above it; between equal edges no value fits, and
    that bin stays at 0.
    """
    return (
        _bin_counts(expected, actual, list(features), bins)
        .select("feature", F.posexplode(F.arrays_zip("e", "a")).alias("bin", "counts"))
        .select("feature", "bin", F.col("counts.e").alias("n_expected"), F.col("counts.a").alias("n_actual"))
    )


def _binned(df: DataFrame, features: list[str], edges: dict[str, list[float | None]], is_expected: bool) -> DataFrame:
    """(feature, bin, is_expected) for the values that are neither null nor NaN."""
    def bin_of(c: str) -> Column:
        known = F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
        return F.when(known, cuts_passed(c, [e for e in edges[c] if e is not None]))

    pairs = [F.struct(F.lit(c).alias("feature"), bin_of(c).alias("bin")) for c in features]
    return (
        df.select(F.inline(F.array(*pairs))).filter("bin IS NOT NULL")
        .withColumn("is_expected", F.lit(is_expected))
    )


def psi(expected: DataFrame, actual: DataFrame, features: Sequence[str], bins: int = 10) -> DataFrame:
    """(feature, psi); null when a side has no values."""
    def add(acc: Column, x: Column) -> Column:
        return acc + x

    def share(count: Column, total: str) -> Column:
        return F.try_divide(count, F.col(total)) + F.lit(EPSILON)

    zero = F.lit(0).cast("bigint")
    counted = _bin_counts(expected, actual, list(features), bins).withColumns(
        {"n_e": F.aggregate("e", zero, add), "n_a": F.aggregate("a", zero, add)})
    terms = F.zip_with("e", "a", lambda e, a: (
        (share(a, "n_a") - share(e, "n_e")) * F.ln(share(a, "n_a") / share(e, "n_e"))))
    # An empty side makes its shares, and with them the sum, null.
    return counted.select("feature", F.aggregate(terms, F.lit(0.0), add).alias("psi"))


def drift_report(
    train: DataFrame, serve: DataFrame, threshold: float = THRESHOLD, bins: int = 10
) -> DataFrame:
    """PSI of every numeric column both frames share, largest first, with a drift flag."""
    shared = [c for c in numeric_columns(train) if c in serve.columns]
    if not shared:
        raise ValueError("no shared numeric columns")
    flagged = psi(train, serve, shared, bins).withColumn(
        "drifted", F.coalesce(F.col("psi") >= threshold, F.lit(False)))
    return flagged.orderBy(F.col("psi").desc_nulls_last(), "feature")
