"""The staged job: ingest, clean, features, train.

    spark-submit -m learnlake.plans.jobs --config my.yaml --stages ingest clean features train

A stage reads what the earlier one wrote, so any stage can be run on its own and a lost job resumes at
the last written tier.
"""

from __future__ import annotations

import argparse
from importlib import resources
from pathlib import Path
from typing import Any

import yaml
from pyspark.sql import DataFrame, SparkSession

from learnlake.operators import clean, contracts, drift, features, metrics, train
from learnlake.operators.registry import LABEL
from learnlake.session import build_session
from learnlake.sources import tables

STAGES = ["ingest", "clean", "features", "train"]


def load_config(path: str | None = None, **overrides: Any) -> dict[str, Any]:
    """The default settings, with those of a YAML file and then ``overrides`` on top."""
    text = resources.files("learnlake.plans").joinpath("default.yaml").read_text(encoding="utf-8")
    config = yaml.safe_load(text)
    if path:
        config |= yaml.safe_load(Path(path).read_text(encoding="utf-8"))
    return config | overrides


def _names(config: dict[str, Any]) -> list[str]:
    return [tables.dataset_name(f) for f in config["files"]]


def ingest(spark: SparkSession, config: dict[str, Any]) -> dict[str, str]:
    paths = config["paths"]
    return tables.ingest_csv(spark, paths["raw"], paths["bronze"], config["files"], infer=False,
                             multi_line=config["multi_line"])


def clean_table(df: DataFrame, name: str, config: dict[str, Any]) -> DataFrame:
    """Bronze to Silver for one table: trim, contract, critical nulls, fills, outliers, duplicates."""
    df = clean.trim_strings(df)
    if name in config["contracts"]:
        df = contracts.load_contract(config["contracts"][name]).enforce(df)
    df = clean.drop_critical_nulls(df, config["critical"])
    df = clean.fill_missing(df, config["fill"].get(name, {}))
    for column, multiplier in config["drop_outliers"].get(name, {}).items():
        df = clean.remove_outliers_iqr(df, column, multiplier)
    return clean.deduplicate(df, config["dedup_keys"].get(name, []), tables.FILE_ORDER)


def clean_all(spark: SparkSession, config: dict[str, Any]) -> dict[str, str]:
    paths, written = config["paths"], {}
    for name in _names(config):
        bronze = tables.read_parquet(spark, f"{paths['bronze']}/{name}.parquet")
        written[name] = tables.write_parquet(clean_table(bronze, name, config), f"{paths['silver']}/{name}.parquet")
    return written


def build_features(spark: SparkSession, config: dict[str, Any]) -> str:
    silver = {n: tables.read_parquet(spark, f"{config['paths']['silver']}/{n}.parquet") for n in _names(config)}
    gold = features.build_gold(
        clean.encode_label(silver["studentInfo"]), silver["studentRegistration"], silver["assessments"],
        silver["studentAssessment"], silver["vle"], silver["studentVle"],
        horizon=config["horizon_weeks"], registration_order=tables.FILE_ORDER,
    )
    return tables.write_gold(gold, f"{config['paths']['gold']}/features.parquet")


def train_model(spark: SparkSession, config: dict[str, Any]) -> str:
    """Fit, evaluate, save with drift and fairness reports, promote; returns the run folder."""
    gold = tables.read_gold(spark, f"{config['paths']['gold']}/features.parquet")
    model, manifest, rows, scored = train.train_and_report(
        gold, config["model"], config["model_settings"], test_share=config["test_share"], seed=config["seed"],
        threshold=config["threshold"])
    artifacts = config["paths"]["artifacts"]
    run = train.save_model(spark, model, manifest, f"{artifacts}/run_{manifest.run_id}")
    slices = [c for c in config["fairness_slices"] if c in scored.columns]
    fairness = metrics.fairness_metrics(scored, LABEL, train.SCORE, slices, config["threshold"])
    fairness.write.mode("overwrite").option("header", True).csv(f"{run}/fairness_report")
    report = drift.drift_report(rows, scored.select(rows.columns), config["drift_threshold"])
    report.write.mode("overwrite").option("header", True).csv(f"{run}/drift_report")
    train.promote(spark, run, artifacts)
    return run


def run(spark: SparkSession, config: dict[str, Any], stages: list[str]) -> dict[str, Any]:
    """Run the named stages in their fixed order."""
    unknown = [s for s in stages if s not in STAGES]
    if unknown:
        raise ValueError(f"unknown stages {unknown}; known: {STAGES}")
    steps = {"ingest": ingest, "clean": clean_all, "features": build_features, "train": train_model}
    return {stage: steps[stage](spark, config) for stage in STAGES if stage in stages}


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--config")
    parser.add_argument("--stages", nargs="+", default=STAGES, choices=STAGES)
    parser.add_argument("--input-tb", type=float, help="raw input size, to size scan and shuffle tasks")
    args = parser.parse_args()
    spark = build_session("learnlake", input_bytes=args.input_tb * 2**40 if args.input_tb else None)
    run(spark, load_config(args.config), args.stages)
    spark.stop()


if __name__ == "__main__":
    main()
