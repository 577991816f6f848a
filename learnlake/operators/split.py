"""Seeded sampling, splitting and folding by hash order, without shuffling the data.

Rows are ordered by an MD5 of seed and key, a random but reproducible order. A split or fold is a range
of that order, so it is enough to find the few hashes at the wanted ranks (exactly, per class) and then
compare every row with them. The key columns have to identify a row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake import KEYS
from learnlake.functions.ordering import hash_order, hash_thresholds, settled


def _against_thresholds(
    df: DataFrame, label: str, keys: Sequence[str], seed: int | str, ranks: Callable[[Column], Column]
) -> DataFrame:
    hashed = df.withColumn("_h", hash_order(keys, seed))
    cuts = hash_thresholds(hashed.filter(F.col(label).isNotNull()), [label], "_h", ranks)
    return hashed.join(settled(cuts), [label], "left")


def stratified_split(
    df: DataFrame, label: str, test_share: float = 0.2, seed: int | str = 42, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Add ``is_test``: of each class, exactly ``round(n * test_share)`` rows are true."""
    marked = _against_thresholds(df, label, keys, seed, lambda n: F.array(F.round(n * F.lit(test_share)).cast("long")))
    chosen = F.coalesce(F.col("_h") <= F.get("thresholds", F.lit(0)), F.lit(False))
    return marked.select(*df.columns, chosen.alias("is_test"))


def stratified_folds(
    df: DataFrame, label: str, folds: int = 5, seed: int | str = 42, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Add ``fold`` 1..folds; the fold sizes within a class differ by at most one row."""
    def last_ranks(n: Column) -> Column:
        base, extra = F.floor(n / folds), n % folds
        return F.array(*[(base * j + F.least(F.lit(j), extra)).cast("long") for j in range(1, folds)])

    marked = _against_thresholds(df, label, keys, seed, last_ranks)
    passed = F.size(F.filter(F.coalesce("thresholds", F.array().cast("array<string>")), lambda t: t < F.col("_h")))
    return marked.select(*df.columns, (passed + 1).alias("fold"))


def seeded_sample(df: DataFrame, n: int, seed: int | str = 0, keys: Sequence[str] = KEYS) -> DataFrame:
    """The ``n`` rows first in hash order; all rows when there are fewer.

    Rows with equal keys follow by a hash of all columns; of identical rows as many stay as there is room for. Only
    the rows up to the last hash, at most ``n`` and its ties, are ordered.
    """
    hashed = df.withColumn("_h", hash_order(keys, seed))
    row = hash_thresholds(hashed, [], "_h", lambda total: F.array(F.least(total, F.lit(n)).cast("long"))).first()
    last = row.thresholds[0] if row and row.thresholds else ""
    return hashed.filter(F.col("_h") <= last).orderBy("_h", F.xxhash64(*df.columns)).limit(n).drop("_h")
