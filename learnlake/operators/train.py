"""Risk models: presets, fitting, evaluation by folds, saving and promotion.

Encoders and null handling are stages of the fitted model, so that scoring sees raw columns exactly as
training did.
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import reduce
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from learnlake import KEYS
from learnlake.functions.columns import numeric_columns, present
from learnlake.operators import boosting, recurrent
from learnlake.operators.boosting import Boosting
from learnlake.operators.encode import UNKNOWN
from learnlake.operators.features import weekly_sequence
from learnlake.operators.metrics import METRICS, classification_metrics
from learnlake.operators.profile import fingerprint
from learnlake.operators.recurrent import Recurrent
from learnlake.operators.registry import CATEGORICAL, LABEL
from learnlake.operators.split import stratified_folds, stratified_split
from learnlake.session import shared_path

# The published settings of the two boosted-tree models and the sequence model. What the second does not
# set are its published defaults.
BOOSTED_A = {"rounds": 800, "step": 0.05, "max_depth": 7, "row_share": 0.85, "feature_share": 0.85, "l1": 0.1, "l2": 1.0}
BOOSTED_B = {
    "rounds": 800, "step": 0.05, "max_leaves": 63, "max_depth": 62, "row_share": 0.85, "bag_every": 5,
    "feature_share": 0.85, "l1": 0.0, "l2": 0.0, "min_rows": 20, "min_hessian": 0.001,
}
SEQUENCE = {
    "length": 30, "hidden": 64, "dense": 32, "dropout": 0.3, "recurrent_dropout": 0.1, "batch": 128, "epochs": 25,
    "step": 0.001, "patience": 5,
}
PATIENCE = 50
PRESETS = {"boosted_a": BOOSTED_A, "boosted_b": BOOSTED_B, "sequence": SEQUENCE}

VALIDATION = "_is_validation"
SCORE = "risk_score"


@dataclass
class Manifest:
    model_name: str
    feature_columns: list[str]
    hyperparameters: dict[str, Any]
    input_columns: dict[str, str] = field(default_factory=dict)
    run_id: str = field(default_factory=lambda: datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S"))
    metrics: dict[str, float | None] = field(default_factory=dict)
    threshold: float = 0.5
    training_seconds: float = 0.0
    dataset_hash: str = ""
    rounds: int = 0


# ------------------------------------------------------------------ preparation


def input_columns(df: DataFrame, label: str = LABEL, exclude: Sequence[str] = ("id_student",)) -> dict[str, str]:
    """Raw columns a model is trained on, with their types: the categorical and the numeric ones."""
    left_out = {label, VALIDATION, "fold", "is_test", *exclude}
    wanted = {*present(df, CATEGORICAL), *numeric_columns(df)} - left_out
    return {name: kind for name, kind in df.dtypes if name in wanted}


def with_inputs(df: DataFrame, inputs: Mapping[str, str]) -> DataFrame:
    """Add the model inputs ``df`` lacks as nulls, which the model treats as 0 or unknown."""
    return df.withColumns({c: F.lit(None).cast(kind) for c, kind in inputs.items() if c not in df.columns})


def feature_stages(df: DataFrame, label: str = LABEL, exclude: Sequence[str] = ("id_student",)) -> list:
    """Null handling, one-hot encoding and assembly for the categorical and numeric columns of ``df``."""
    inputs = input_columns(df, label, exclude)
    categorical = [c for c in inputs if c in CATEGORICAL]
    numeric = [c for c in inputs if c not in CATEGORICAL]
    filled = [f"coalesce(`{c}`, '{UNKNOWN}') AS in_{c}" for c in categorical]
    filled += [f"coalesce(CAST(`{c}` AS DOUBLE), 0D) AS in_{c}" for c in numeric]
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__")]
    if categorical:
        # "keep" appends a category for unseen values; dropping that last one leaves them all zero.
        stages += [
            StringIndexer(inputCols=[f"in_{c}" for c in categorical], outputCols=[f"ix_{c}" for c in categorical],
                          stringOrderType="alphabetAsc", handleInvalid="keep"),
            OneHotEncoder(inputCols=[f"ix_{c}" for c in categorical], outputCols=[f"oh_{c}" for c in categorical],
                          dropLast=True),
        ]
    assembled = [f"in_{c}" for c in numeric] + [f"oh_{c}" for c in categorical]
    return [*stages, VectorAssembler(inputCols=assembled, outputCol="features", handleInvalid="keep")]


def feature_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """Names of the feature vector's positions, such as ``total_clicks`` or ``gender_F``."""
    attributes = model.transform(df.limit(0)).schema["features"].metadata["ml_attr"]["attrs"]
    entries = sorted((a for group in attributes.values() for a in group), key=lambda a: a["idx"])
    return [a["name"].removeprefix("in_").removeprefix("oh_") for a in entries]


def with_validation(df: DataFrame, label: str = LABEL, share: float = 0.1, seed: int = 42,
                    keys: Sequence[str] = KEYS) -> DataFrame:
    """Mark a stratified share of the training rows for early stopping; test rows are never used for that."""
    marked = stratified_split(df, label, share, f"validation-{seed}", keys)
    return marked.withColumnRenamed("is_test", VALIDATION)


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write to the shared folder and read back: an iterative fit then re-reads files, not the whole plan."""
    path = shared_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ------------------------------------------------------------------ fitting


def boosting_settings(settings: dict[str, Any] | None, seed: int = 42, patience: int = PATIENCE) -> Boosting:
    """The first preset with changes, or all of another one."""
    chosen = settings or {}
    return Boosting(**{"seed": seed, "patience": patience} | (chosen if "max_leaves" in chosen else BOOSTED_A | chosen))


def _vectors(features: PipelineModel, rows: DataFrame, label: str, roles: Mapping[str, Column]) -> tuple[DataFrame, int]:
    """Label, feature array and roles in the shared folder, and the array's width."""
    encoded = features.transform(rows)
    width = encoded.schema["features"].metadata["ml_attr"]["num_attrs"]
    table = encoded.select(
        F.col(label).cast("int").alias(label), vector_to_array("features").alias("x"), *[c.alias(n) for n, c in roles.items()])
    return materialise(table, "boosting"), width


def fit_boosted(
    train: DataFrame, settings: dict[str, Any] | None = None, label: str = LABEL, seed: int = 42,
    patience: int = PATIENCE,
) -> PipelineModel:
    """Gradient-boosted trees; rows marked by ``with_validation`` only decide how many rounds are kept.

    A fit stops ``patience`` rounds after the smallest validation loss and keeps the rounds up to it.
    """
    features = Pipeline(stages=feature_stages(train, label)).fit(train)
    role = F.when(F.col(VALIDATION), boosting.VALIDATE).otherwise(boosting.TRAIN) if VALIDATION in train.columns else F.lit(boosting.TRAIN)
    rows, width = _vectors(features, train, label, {"role": role})
    forest, edges, _ = boosting.fit(rows, "x", label, "role", width, boosting_settings(settings, seed, patience))
    return PipelineModel([*features.stages, boosting.spark_model(train.sparkSession, forest, edges, width)])


def fit_boosted_folds(
    folded: DataFrame, folds: int, settings: dict[str, Any] | None = None, label: str = LABEL, seed: int = 42,
    patience: int = PATIENCE,
) -> list[PipelineModel]:
    """One model per fold (column ``fold``, from 1), each on the rows of the others, all grown side by side.

    Rows marked by ``with_validation`` take part in early stopping only. Encoders and bins, which see no label, are
    those of all rows.
    """
    features = Pipeline(stages=feature_stages(folded, label)).fit(folded)
    held = F.col(VALIDATION) if VALIDATION in folded.columns else F.lit(False)
    role = F.when(held, boosting.VALIDATE).otherwise(boosting.TRAIN)
    roles = {f"role_{k}": F.when(F.col("fold") == k, 0).otherwise(role) for k in range(1, folds + 1)}
    rows, width = _vectors(features, folded, label, roles)
    forests, edges, _ = boosting.fit_many(rows, "x", label, list(roles), width, boosting_settings(settings, seed, patience))
    spark = folded.sparkSession
    return [PipelineModel([*features.stages, boosting.spark_model(spark, f, edges, width)]) for f in forests]


def sequence_frame(student_vle: DataFrame, labels: DataFrame, length: int = 30) -> DataFrame:
    """Label joined with the student's weekly clicks on a log scale, as a vector; inactive students are zeros."""
    zeros = F.array_repeat(F.lit(0.0), length)
    clicks = F.transform(F.coalesce("clicks", zeros), lambda x: F.log1p(F.greatest(x, F.lit(0.0))))
    return (
        labels.join(weekly_sequence(student_vle, length), KEYS, "left")
        .withColumn("features", array_to_vector(clicks)).drop("clicks")
    )


def fit_sequence(
    train: DataFrame, settings: dict[str, Any] | None = None, label: str = LABEL, seed: int = 42
) -> tuple[PipelineModel, int]:
    """Recurrent network over the sequences of ``sequence_frame``, and the number of epochs kept.

    Rows marked by ``with_validation`` decide when to stop, by their AUC; without them the training rows do.
    """
    held = F.col(VALIDATION) if VALIDATION in train.columns else F.lit(False)
    rows = materialise(train.select(
        vector_to_array("features").alias("x"), F.col(label).cast("int").alias(label),
        F.when(held, boosting.VALIDATE).otherwise(boosting.TRAIN).alias("role")), "sequences")
    model, history = recurrent.fit(rows, "x", label, "role", Recurrent(**{"seed": seed} | SEQUENCE | (settings or {})))
    return PipelineModel([model]), 1 + max(range(len(history)), key=history.__getitem__)


def predict_proba(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` plus ``risk_score``, the probability of class 1."""
    scored = model.transform(df)
    return scored.select(*df.columns, vector_to_array("probability")[1].alias(SCORE))


def predict(model: PipelineModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``predict_proba`` plus the 0/1 ``prediction`` at the threshold."""
    return predict_proba(model, df).withColumn("prediction", (F.col(SCORE) >= threshold).cast("int"))


def kfold_eval(
    df: DataFrame,
    settings: dict[str, Any] | None = None,
    label: str = LABEL,
    folds: int = 5,
    seed: int = 42,
    keys: Sequence[str] = KEYS,
    validation_share: float = 0.1,
) -> DataFrame:
    """Metrics per fold: one fit for the models of all folds, then a single metric job over all out-of-fold scores."""
    marked = with_validation(df, label, validation_share, seed, keys) if validation_share else df
    folded = materialise(stratified_folds(marked, label, folds, seed, keys), "folds")
    models = fit_boosted_folds(folded, folds, settings, label, seed)
    scored = [
        predict_proba(model, folded.filter(F.col("fold") == k)).select("fold", label, SCORE)
        for k, model in enumerate(models, 1)]
    return classification_metrics(reduce(DataFrame.unionByName, scored), label, SCORE, by=["fold"])


# ------------------------------------------------------------------ artifacts


def train_and_report(
    gold: DataFrame,
    model_name: str = "boosted_a",
    settings: dict[str, Any] | None = None,
    label: str = LABEL,
    test_share: float = 0.2,
    seed: int = 42,
    keys: Sequence[str] = KEYS,
    threshold: float = 0.5,
) -> tuple[PipelineModel, Manifest, DataFrame, DataFrame]:
    """Split, fit and evaluate; returns (model, manifest, training rows, scored test rows).

    The model "sequence" trains on a ``sequence_frame``, the others on Gold.
    """
    settings = PRESETS[model_name] | (settings or {})
    marked = materialise(stratified_split(gold, label, test_share, seed, keys), "split")
    train, test = marked.filter("NOT is_test").drop("is_test"), marked.filter("is_test").drop("is_test")
    start = time.monotonic()
    rows = materialise(with_validation(train, label, seed=seed, keys=keys), "train")
    if model_name == "sequence":
        model, rounds = fit_sequence(rows, settings, label, seed)
        names, inputs = [f"week_{i}" for i in range(settings["length"])], {"features": "vector"}
    else:
        model = fit_boosted(rows, settings, label, seed)
        names, inputs, rounds = feature_names(model, train), input_columns(train, label), model.stages[-1].getNumTrees
    seconds = time.monotonic() - start
    scored = predict_proba(model, test)
    row = classification_metrics(scored, label, SCORE, threshold).first()
    manifest = Manifest(
        model_name, names, settings, inputs, threshold=threshold, training_seconds=seconds,
        metrics={m: row[m] for m in METRICS} if row else {}, dataset_hash=dataset_hash(train), rounds=rounds)
    return model, manifest, train, scored


def dataset_hash(df: DataFrame) -> str:
    row = fingerprint(df).first()
    return hashlib.md5(f"{row.n_rows}:{row.digest}".encode()).hexdigest()[:12]


def save_model(spark: SparkSession, model: PipelineModel, manifest: Manifest, directory: str) -> str:
    """Model under ``directory/model`` and its manifest as one JSON row under ``directory/manifest``."""
    model.write().overwrite().save(f"{directory}/model")
    text = json.dumps(manifest.__dict__, sort_keys=True)
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{directory}/manifest")
    return directory


def load_manifest(spark: SparkSession, directory: str) -> Manifest:
    return Manifest(**json.loads(spark.read.text(f"{directory}/manifest").first().value))


def load_model(spark: SparkSession, directory: str) -> tuple[PipelineModel, Manifest]:
    return PipelineModel.load(f"{directory}/model"), load_manifest(spark, directory)


def promote(spark: SparkSession, directory: str, artifacts_dir: str) -> int:
    """Point ``latest`` at a run and return the promotion's number.

    A promotion appends one row to a log; nothing is replaced, so a reader sees the pointer before or the new one, never
    none. Rows of an unfinished promotion do not count: the file sink shows them when they are committed. Promotions
    made at the same time get the same number; of these the last in time counts, then the greater path.
    """
    log = f"{artifacts_dir}/promotions"
    entries = _promotions(spark, artifacts_dir)
    number = 1 + (entries.agg(F.max("number")).first()[0] or 0 if entries is not None else 0)
    row = spark.createDataFrame([(number, directory)], "number bigint, directory string")
    row.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").json(log)
    return number


def _promotions(spark: SparkSession, artifacts_dir: str) -> DataFrame | None:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{artifacts_dir}/promotions")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema("number bigint, directory string, at timestamp").json(path.toString())


def latest(spark: SparkSession, artifacts_dir: str) -> str:
    """The run that was promoted last."""
    entries = _promotions(spark, artifacts_dir)
    row = entries.orderBy(F.desc("number"), F.desc("at"), F.desc("directory")).first() if entries is not None else None
    if row is None:
        raise FileNotFoundError(f"nothing was promoted in {artifacts_dir}")
    return row.directory


def manifest_frame(spark: SparkSession, manifest: Manifest) -> DataFrame:
    """The manifest as a one-row table: scalars as columns, the nested parts as JSON."""
    row = {k: json.dumps(v, sort_keys=True) if isinstance(v, (dict, list)) else v for k, v in manifest.__dict__.items()}
    return spark.createDataFrame([row], ", ".join(
        f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in row.items()))
