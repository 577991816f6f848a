"""Table contracts: cast, check all rules in one pass, report, enforce or quarantine."""

from __future__ import annotations

from dataclasses import dataclass, field
from importlib import resources
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from learnlake.functions.columns import TYPES, cast_or_null, known, present


class ContractViolation(ValueError):
    """Raised once per table, naming every broken rule."""


@dataclass(frozen=True)
class ColumnRule:
    name: str
    type: str
    nullable: bool = True
    allowed: tuple[Any, ...] | None = None
    min: float | None = None
    max: float | None = None

    def broken(self, raw: Column, cast: Column) -> dict[str, Column]:
        """Rule name -> condition that is true for a bad row. Nulls only break ``not_null``."""
        rules = {"cast": raw.isNotNull() & cast.isNull()}
        if not self.nullable:
            rules["not_null"] = cast.isNull()
        if self.allowed is not None:
            rules["allowed"] = ~cast.isin(*self.allowed)
        if self.min is not None:
            rules["min"] = cast < self.min
        if self.max is not None:
            rules["max"] = cast > self.max
        return {rule: F.coalesce(bad, F.lit(False)) for rule, bad in rules.items()}


@dataclass(frozen=True)
class TableContract:
    """``unique_key`` makes the primary key a rule: rows that share one, nulls being a value, break it."""

    name: str
    primary_key: tuple[str, ...] = ()
    columns: tuple[ColumnRule, ...] = field(default_factory=tuple)
    unique_key: bool = False

    def __post_init__(self) -> None:
        unknown = sorted({c.type for c in self.columns} - set(TYPES))
        if unknown:
            raise ValueError(f"contract {self.name}: unknown types {unknown}")

    def missing(self, df: DataFrame) -> list[str]:
        """Required columns the frame lacks; optional ones may be absent."""
        return [c.name for c in self.columns if not c.nullable and c.name not in df.columns]

    def _present(self, df: DataFrame) -> list[ColumnRule]:
        return [c for c in self.columns if c.name in df.columns]

    def _casts(self, df: DataFrame) -> dict[str, Column]:
        kinds = dict(df.dtypes)
        return {c.name: cast_or_null(F.col(c.name), kinds[c.name], c.type) for c in self._present(df)}

    def _broken(self, df: DataFrame) -> dict[tuple[str, str], Column]:
        casts, kinds = self._casts(df), dict(df.dtypes)
        return {
            (c.name, rule): bad
            for c in self._present(df)
            for rule, bad in c.broken(known(F.col(c.name), kinds[c.name]), casts[c.name]).items()
        }

    def cast(self, df: DataFrame) -> DataFrame:
        """Contract types for the known columns; the others pass through."""
        return df.withColumns(self._casts(df))

    def _key_columns(self, df: DataFrame) -> list[str]:
        """The key's columns where the key is a rule and the table has all of them."""
        held = self.unique_key and self.primary_key and set(self.primary_key) <= set(df.columns)
        return list(self.primary_key) if held else []

    def _shared_keys(self, df: DataFrame) -> DataFrame:
        """(key in contract types, n_rows) of keys that several rows have: counted per task before they meet."""
        return duplicate_keys(self.cast(df), self._key_columns(df))

    def report(self, df: DataFrame) -> DataFrame:
        """(column, rule, bad): bad rows per rule, from a single aggregate over the table, and one more for the key."""
        rules = self._rule_report(df)
        if not (keys := self._key_columns(df)):
            return rules
        bad = self._shared_keys(df).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("bad"))
        return rules.unionByName(bad.select(F.lit(",".join(keys)).alias("column"), F.lit("key").alias("rule"), "bad"))

    def _rule_report(self, df: DataFrame) -> DataFrame:
        broken = self._broken(df)
        if not broken:
            return df.sparkSession.createDataFrame([], "column string, rule string, bad long")
        counts = df.agg(*[F.count_if(bad).alias(f"r{i}") for i, bad in enumerate(broken.values())])
        lines = [
            F.struct(F.lit(column).alias("column"), F.lit(rule).alias("rule"), F.col(f"r{i}").alias("bad"))
            for i, (column, rule) in enumerate(broken)
        ]
        return counts.select(F.inline(F.array(*lines)))

    def enforce(self, df: DataFrame, strict_cast: bool = False) -> DataFrame:
        """The cast frame, or one ``ContractViolation`` listing everything that is wrong.

        Values that do not cast become null; on a non-nullable column that is a violation anyway, on a
        nullable one only with ``strict_cast``.
        """
        problems = [f"missing required column '{c}'" for c in self.missing(df)]
        for row in self.report(df).filter("bad > 0").collect() if self._present(df) else []:
            if strict_cast or row.rule != "cast":
                problems.append(f"column '{row['column']}': {row.bad} rows break {self._text(row['column'], row.rule)}")
        if problems:
            raise ContractViolation(f"contract {self.name}: " + "; ".join(problems))
        return self.cast(df)

    def _text(self, column: str, rule: str) -> str:
        if rule == "key":
            return "the unique key"
        spec = next(c for c in self.columns if c.name == column)
        limit = {"allowed": spec.allowed, "min": spec.min, "max": spec.max, "cast": spec.type}.get(rule)
        return rule if limit is None else f"{rule} {limit}"

    def quarantine(self, df: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(good rows in contract types, bad rows as they came plus ``_violations``).

        Where the key is a rule, all rows that share a key are bad: nothing tells which of them is right.
        """
        names = F.array_compact(F.array(*[
            F.when(bad, F.lit(f"{column}:{rule}")) for (column, rule), bad in self._broken(df).items()
        ]).cast("array<string>"))
        marked = df.withColumn("_violations", names)
        if keys := self._key_columns(df):
            shared = self._shared_keys(df).select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.lit(True).alias("_shared"))
            casts = self._casts(df)
            same = [casts.get(k, F.col(k)).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
            flag = F.when(F.col("_shared"), F.array(F.lit(f"{','.join(keys)}:key"))).otherwise(F.array().cast("array<string>"))
            marked = marked.join(shared, same, "left").withColumn("_violations", F.concat("_violations", flag)).select(
                *df.columns, "_violations")
        good = self.cast(marked.filter(F.size("_violations") == 0).drop("_violations"))
        return good, marked.filter(F.size("_violations") > 0)

    def duplicate_keys(self, df: DataFrame) -> DataFrame:
        """Primary-key values that occur more than once, with their row count."""
        return duplicate_keys(df, self.primary_key)


def duplicate_keys(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    return df.groupBy(*present(df, keys)).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def parse_contract(text: str) -> TableContract:
    raw = yaml.safe_load(text)
    columns = tuple(
        ColumnRule(**(c | {"allowed": tuple(c["allowed"])} if c.get("allowed") is not None else c))
        for c in raw.get("columns", [])
    )
    return TableContract(raw["name"], tuple(raw.get("primary_key", ())), columns, raw.get("unique_key", False))


def load_contract(path: str | Path) -> TableContract:
    """Contract from a YAML file, or by the name of one that comes with the package."""
    if str(path).endswith((".yaml", ".yml")):
        return parse_contract(Path(path).read_text(encoding="utf-8"))
    return parse_contract(resources.files("learnlake.contracts").joinpath(f"{path}.yaml").read_text(encoding="utf-8"))


def missingness_profile(df: DataFrame) -> DataFrame:
    """(column, n_null, null_share), NaN counting as null, for every column, from one aggregate."""
    counts = df.agg(F.count("*").alias("n"), *[
        F.count(known(F.col(c), kind)).alias(f"c{i}") for i, (c, kind) in enumerate(df.dtypes)])
    lines = [
        F.struct(F.lit(c).alias("column"), (F.col("n") - F.col(f"c{i}")).alias("n_null"))
        for i, c in enumerate(df.columns)
    ]
    return (
        counts.select("n", F.inline(F.array(*lines)))
        .select("column", "n_null", F.try_divide("n_null", "n").alias("null_share"))
    )
