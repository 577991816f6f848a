"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters Unicode calls white space, plus the four ASCII separators.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Contract type name -> Spark type. Both integer names widen to 64 bits.
TYPES = {
    "integer": "bigint",
    "long": "bigint",
    "double": "double",
    "float": "double",
    "string": "string",
    "boolean": "boolean",
}


def strip(column: Column) -> Column:
    """Remove leading and trailing white space of any kind; nulls stay null."""
    return F.btrim(column, F.lit(WHITESPACE))


def _integral(value: Column) -> Column:
    """Double to long, null unless the double is a whole number in range."""
    return F.when(value == F.floor(value), value.try_cast("bigint"))


def known(column: Column, kind: str) -> Column:
    """The value, or null where a floating-point column holds NaN: both mean missing."""
    return F.when(~F.isnan(column), column) if kind in ("double", "float") else column


def cast_or_null(column: Column, source: str, target: str) -> Column:
    """Cast to a contract type; values that do not fit become null.

    ``source`` is the Spark type name of the column. ``"3.0"`` is a valid long, ``"3.7"`` is not.
    """
    if target not in TYPES:
        raise ValueError(f"unknown contract type {target!r}; known: {sorted(TYPES)}")
    spark_type = TYPES[target]
    column = known(column, source)
    if source == spark_type:
        return column
    if spark_type == "bigint" and source == "string":
        return F.coalesce(column.try_cast("bigint"), _integral(column.try_cast("double")))
    if spark_type == "bigint" and (source in ("double", "float") or source.startswith("decimal")):
        return _integral(column.cast("double"))
    return known(column.try_cast(spark_type), spark_type)


def dense_week(day: Column) -> Column:
    """Presentation week of a day offset: days 0-6 are week 1."""
    return F.floor(day / 7).cast("int") + 1


def mean_of_present(terms: Iterable[Column]) -> Column:
    """Mean over the terms that are not null; null when all are."""
    terms = list(terms)
    if not terms:
        return F.lit(None).cast("double")
    total, present = F.lit(0.0), F.lit(0)
    for term in terms:
        total = total + F.coalesce(term, F.lit(0.0))
        present = present + term.isNotNull().cast("int")
    return F.try_divide(total, present)


def non_negative(column: Column) -> Column:
    """Clip at zero, keeping nulls (``greatest`` alone would turn them into 0)."""
    return F.when(column.isNotNull(), F.greatest(column, F.lit(0)))


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """Those of ``columns`` that the frame has, in the given order."""
    return [c for c in columns if c in df.columns]


def numeric_columns(df: DataFrame) -> list[str]:
    prefixes = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")
    return [name for name, kind in df.dtypes if kind.startswith(prefixes) and not kind.startswith("interval")]
