"""Silver cleaning: trim, critical nulls, fills, outliers, categories, label, duplicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlake.functions.columns import known, present, strip
from learnlake.functions.ordering import exact_quantiles
from learnlake.operators.registry import LABEL

# The outcomes that count as at risk.
AT_RISK = ("Fail", "Withdrawn")


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip white space from every string column."""
    return df.withColumns({c: strip(F.col(c)) for c, kind in df.dtypes if kind == "string"})


def drop_critical_nulls(df: DataFrame, critical: Sequence[str]) -> DataFrame:
    """Drop rows that are null in any critical column the frame has."""
    existing = present(df, critical)
    return df.na.drop(subset=existing) if existing else df


def _modes(df: DataFrame, columns: list[str]) -> dict[str, object]:
    """Most frequent value per column, the smallest on ties: one scan for any number of columns.

    (column, value) pairs are counted, combined per task, so no task holds all values of a column; the winner per column
    is a minimum, and only the winners come to the driver. Values travel as text next to what orders them.
    """
    if not columns:
        return {}
    kinds = dict(df.dtypes)

    def pair(i: int, c: str) -> Column:
        value, kind = known(F.col(f"`{c}`"), kinds[c]), kinds[c]
        exact = kind in ("tinyint", "smallint", "int", "bigint") or kind.startswith("decimal")
        return F.struct(
            F.lit(i).alias("column"), (value if exact else F.lit(None)).cast("decimal(38,10)").alias("exact"),
            (value if kind in ("float", "double") else F.lit(None)).cast("double").alias("number"),
            value.cast("string").alias("text"))

    pairs = df.select(F.inline(F.array(*[pair(i, c) for i, c in enumerate(columns)]))).where("text IS NOT NULL")
    counted = pairs.groupBy("column", "exact", "number", "text").agg(F.count("*").alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("n"), "exact", "number", "text")).alias("best")
    best = {r["column"]: r["best"]["text"] for r in counted.groupBy("column").agg(first).collect()}
    return {c: best.get(i) for i, c in enumerate(columns)}


def fill_missing(df: DataFrame, strategies: Mapping[str, str]) -> DataFrame:
    """Fill nulls, and NaN in floating-point columns, by column: ``median``, ``mode``, ``zero``, or any other text as the literal itself."""
    kinds = dict(df.dtypes)
    wanted = {c: s for c, s in strategies.items() if c in kinds}
    medians = [c for c, s in wanted.items() if s == "median"]
    values: dict[str, object] = {c: 0 for c, s in wanted.items() if s == "zero"}
    if medians:
        values |= {c: v[0] for c, v in exact_quantiles(df, medians, [0.5]).items()}
    values |= _modes(df, [c for c, s in wanted.items() if s == "mode"])
    values |= {c: s for c, s in wanted.items() if s not in ("median", "mode", "zero")}
    filled = {}
    for c, value in values.items():
        if value is None:
            continue
        # A median may fall between two whole numbers, so that column becomes double.
        kind = "double" if c in medians else kinds[c]
        filled[c] = F.coalesce(known(F.col(c), kinds[c]).cast(kind), F.lit(value).cast(kind))
    return df.withColumns(filled)


def remove_outliers_iqr(
    df: DataFrame, column: str, multiplier: float = 3.0, approx: bool = False
) -> DataFrame:
    """Keep rows within ``multiplier`` interquartile ranges of the quartiles; null values are dropped."""
    if column not in df.columns:
        return df
    if approx:
        q1, q3 = df.agg(F.percentile_approx(F.col(column).cast("double"), [0.25, 0.75])).first()[0] or (None, None)
    else:
        q1, q3 = exact_quantiles(df, [column], [0.25, 0.75])[column]
    if q1 is None:
        return df.filter(F.lit(False))
    margin = multiplier * (q3 - q1)
    return df.filter(F.col(column).between(F.lit(q1 - margin), F.lit(q3 + margin)))


def standardise_categories(df: DataFrame, mapping: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Replace category values per column; others stay, and replacements do not chain."""
    for column, values in mapping.items():
        if column in df.columns and values:
            df = df.replace(dict(values), subset=[column])
    return df


def clean(
    df: DataFrame, critical: Sequence[str] = (), strategies: Mapping[str, str] | None = None
) -> DataFrame:
    """The Silver chain: trim, drop critical nulls, fill."""
    return fill_missing(drop_critical_nulls(trim_strings(df), critical), strategies or {})


def encode_label(df: DataFrame, column: str = "final_result") -> DataFrame:
    """Add the 0/1 at-risk label; an unknown or missing outcome is 0."""
    if column not in df.columns:
        return df
    return df.withColumn(LABEL, F.coalesce(F.col(column).isin(*AT_RISK), F.lit(False)).cast("int"))


def deduplicate(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str], keep: str = "last"
) -> DataFrame:
    """One row per key, the last or first by ``order_by``; null keys equal each other.

    An aggregate rather than a window: every map task sends at most one row per key, so many copies of
    one key do not meet in one task. Equal ``order_by`` values are decided by the remaining columns.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    keys = present(df, keys)
    if not keys:
        return df
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    row = F.struct(*[c for c in order_by if c not in keys], *rest)
    picked = (F.max if keep == "last" else F.min)(row).alias("picked")
    out = df.groupBy(*keys).agg(picked)
    return out.select(*[F.col(c) if c in keys else F.col(f"picked.{c}").alias(c) for c in df.columns])
