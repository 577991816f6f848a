"""Classification metrics, overall and per slice, exact and without a global sort.

Everything derives from one table: positives and negatives per distinct score (and group). Counting
collapses tied scores on the map side; ranking metrics then need running totals along the score, which
``running_totals`` computes bucket by bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlake.functions.ordering import add_buckets, cut_points, default_buckets, exact_quantiles, running_totals

METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc", "brier"]


def _score_table(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """(by, s, pos, neg) per distinct score. Unlabelled or unscored rows and null groups are left out."""
    for c in (label, score, *by):
        df = df.filter(F.col(c).isNotNull())
    y = F.col(label).cast("int")
    return (
        df.filter(~F.isnan(F.col(score).cast("double"))).groupBy(*by, F.col(score).cast("double").alias("s"))
        .agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    )


def _score_cuts(df: DataFrame, score: str) -> list[float]:
    n = default_buckets(df)
    return cut_points(df, [score], [i / n for i in range(1, n)])[score]


def classification_metrics(
    df: DataFrame, label: str, score: str, threshold: float = 0.5, by: Sequence[str] = ()
) -> DataFrame:
    """One row of metrics per group (one row in all without ``by``).

    Zero divisions give 0; ROC-AUC is null for a single-class group, average precision 0 without positives.
    """
    by = list(by)
    ranked = running_totals(
        _score_table(df, label, score, by), by, "s", ["pos", "neg"], cuts=_score_cuts(df, score))
    hit = F.col("s") >= threshold
    sums = ranked.groupBy(*by).agg(
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(0)).alias("fp"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("p"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("q"),
        # Each negative is beaten by the positives above it and half-beaten by those tied with it.
        F.sum(F.col("neg") * (F.col("cum_pos") - F.col("pos") * 0.5)).alias("wins"),
        F.sum(F.col("pos") * F.try_divide(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))).alias("precisions"),
        F.sum(F.col("pos") * F.pow(1 - F.col("s"), 2) + F.col("neg") * F.pow("s", 2)).alias("squares"),
    )
    tp, fp, p, q = (F.col(c) for c in ("tp", "fp", "p", "q"))
    zero = F.lit(0.0)
    return sums.select(
        *by, (p + q).alias("n"),
        F.try_divide(tp + q - fp, p + q).alias("accuracy"),
        F.coalesce(F.try_divide(tp, tp + fp), zero).alias("precision"),
        F.coalesce(F.try_divide(tp, p), zero).alias("recall"),
        F.coalesce(F.try_divide(tp * 2, p + tp + fp), zero).alias("f1"),
        F.try_divide("wins", p.cast("double") * q).alias("roc_auc"),
        F.coalesce(F.try_divide("precisions", p), zero).alias("pr_auc"),
        F.try_divide("squares", p + q).alias("brier"),
    )


def fairness_metrics(
    df: DataFrame, label: str, score: str, slices: Sequence[str], threshold: float = 0.5
) -> DataFrame:
    """The metrics for every value of every slice column, all columns in one job, sorted by slice."""
    pairs = [F.struct(F.lit(c).alias("slice_col"), F.col(c).cast("string").alias("slice_value")) for c in slices]
    long = df.select(label, score, F.inline(F.array(*pairs)))
    by = ["slice_col", "slice_value"]
    return classification_metrics(long, label, score, threshold, by).orderBy(*by)


def cv_summary(per_fold: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """(metric, mean, std) over folds, from one aggregate."""
    row = per_fold.agg(*[
        F.struct(F.lit(m).alias("metric"), F.avg(m).alias("mean"), F.stddev_samp(m).alias("std")).alias(m)
        for m in metrics
    ])
    return row.select(F.inline(F.array(*metrics)))


def calibration_table(
    df: DataFrame, label: str, score: str, bins: int = 10, strategy: str = "quantile"
) -> DataFrame:
    """Reliability table: per score bin, row count, mean score and observed positive share.

    Bins hold equal shares of the scores (``quantile``) or have equal width on [0, 1] (``uniform``).
    """
    shares = [i / bins for i in range(1, bins)]
    if strategy == "quantile":
        edges = sorted({e for e in exact_quantiles(df, [score], shares)[score] if e is not None})
    elif strategy == "uniform":
        edges = shares
    else:
        raise ValueError("strategy must be 'quantile' or 'uniform'")
    kept = df.select(F.col(label).cast("double").alias("y"), F.col(score).cast("double").alias("s")).na.drop()
    binned = add_buckets(kept, {"s": edges})
    return binned.groupBy((F.col("s_bucket") + 1).alias("bin")).agg(
        F.count("*").alias("n"), F.avg("s").alias("mean_score"), F.avg("y").alias("positive_share"),
    )
