"""Versioned saved state: preprocessor, feature configuration and model.

Fitted state is a handful of numbers per feature and model column; it is held
as three small Parquet tables and one JSON row per version folder.
"""

from __future__ import annotations

import json
from dataclasses import dataclass
from numbers import Real

from pyspark.sql import SparkSession

from deliverylens.errors import BundleError
from deliverylens.operators.model import LinearModel
from deliverylens.operators.prep import CategoryState, IndicatorState, NumericState, Preprocessor

MODEL_TYPES = ("LogisticRegression",)


@dataclass(frozen=True)
class Bundle:
    """All that scoring needs."""

    preprocessor: Preprocessor
    model: LinearModel
    threshold: float
    version: str
    primary_metric: str = "average_precision"

    def feature_config(self) -> dict:
        return described(self.preprocessor)

    def model_metadata(self) -> dict:
        return {
            "model_type": self.model.model_type,
            "classification_threshold": self.threshold,
            "best_C": self.model.c,
            "best_class_weight": self.model.class_weight,
            "primary_metric": self.primary_metric,
            "feature_count": len(self.model.coefficients),
            "classes": list(self.model.classes),
            "intercept": self.model.intercept,
            "version": self.version,
        }


def is_threshold(value: object) -> bool:
    """True for a number in [0, 1]; a bool is no number here."""
    return isinstance(value, Real) and not isinstance(value, bool) and 0 <= value <= 1


def described(prep: Preprocessor) -> dict:
    """What a fitted preprocessor takes and how much it gives, as stored beside it."""
    return {
        "numeric_features": list(prep.numeric_features),
        "categorical_features": list(prep.categorical_features),
        "raw_feature_count": len(prep.raw_features),
        "transformed_feature_count": prep.width,
    }


def check_bundle(feature_names: list[str], config: dict, metadata: dict, prep: Preprocessor, coefficients: int) -> None:
    """Raise unless what is stated about a model is what follows from its preprocessor.

    All statements are derived anew and compared at once; the error names those
    that differ.
    """
    derived = {**described(prep), "output names": prep.feature_names, "coefficients": prep.width, "feature_count": prep.width}
    stated = {**{k: config.get(k) for k in described(prep)}, "output names": feature_names, "coefficients": coefficients, "feature_count": metadata.get("feature_count")}
    wrong = [k for k in derived if stated[k] != derived[k]]
    if metadata.get("model_type") not in MODEL_TYPES:
        wrong.append("model_type")
    if not is_threshold(metadata.get("classification_threshold")):
        wrong.append("classification_threshold")
    if wrong:
        raise BundleError(f"the saved model does not fit its preprocessor in: {', '.join(wrong)}")


def save_bundle(spark: SparkSession, bundle: Bundle, path: str) -> str:
    """Write the version folder ``path/version=<v>``, read it back and compare."""
    prep = bundle.preprocessor
    check_bundle(prep.feature_names, bundle.feature_config(), bundle.model_metadata(), prep, len(bundle.model.coefficients))
    folder = f"{path}/version={bundle.version}"
    states = [("numeric", i, s.feature, s.median, s.mean, s.scale, None, None) for i, s in enumerate(prep.numeric)]
    states += [("indicator", i, s.feature, None, s.mean, s.scale, None, None) for i, s in enumerate(prep.indicators)]
    states += [
        ("category", i, s.feature, None, None, None, list(s.categories), s.has_infrequent)
        for i, s in enumerate(prep.categories)
    ]
    schema = (
        "kind STRING, position INT, feature STRING, median DOUBLE, mean DOUBLE, scale DOUBLE, "
        "categories ARRAY<STRING>, has_infrequent BOOLEAN"
    )
    spark.createDataFrame(states, schema).coalesce(1).write.mode("overwrite").parquet(f"{folder}/preprocessor")
    names = [(i, n, w) for i, (n, w) in enumerate(zip(prep.feature_names, bundle.model.coefficients))]
    spark.createDataFrame(names, "position INT, feature STRING, coefficient DOUBLE").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{folder}/coefficients")
    texts = [(json.dumps(bundle.feature_config()), json.dumps(bundle.model_metadata()))]
    spark.createDataFrame(texts, "feature_config STRING, model STRING").coalesce(1).write.mode("overwrite").json(
        f"{folder}/metadata"
    )
    if load_bundle(spark, path, bundle.version) != bundle:
        raise BundleError(f"saved state differs from the fitted state: {folder}")
    return folder


def load_bundle(spark: SparkSession, path: str, version: str) -> Bundle:
    """Read and check one version."""
    folder = f"{path}/version={version}"
    meta = spark.read.schema("feature_config STRING, model STRING").json(f"{folder}/metadata").first()
    if meta is None or meta["feature_config"] is None or meta["model"] is None:
        raise BundleError(f"metadata cannot be read: {folder}")
    config, metadata = json.loads(meta["feature_config"]), json.loads(meta["model"])
    if not isinstance(config, dict) or not isinstance(metadata, dict):
        raise BundleError("feature configuration and model metadata must be objects")
    rows = spark.read.parquet(f"{folder}/preprocessor").orderBy("kind", "position").collect()
    prep = Preprocessor(
        tuple(config.get("numeric_features", ())),
        tuple(config.get("categorical_features", ())),
        tuple(NumericState(r["feature"], r["median"], r["mean"], r["scale"]) for r in rows if r["kind"] == "numeric"),
        tuple(IndicatorState(r["feature"], r["mean"], r["scale"]) for r in rows if r["kind"] == "indicator"),
        tuple(
            CategoryState(r["feature"], tuple(r["categories"]), r["has_infrequent"]) for r in rows if r["kind"] == "category"
        ),
    )
    table = spark.read.parquet(f"{folder}/coefficients").orderBy("position").collect()
    check_bundle([r["feature"] for r in table], config, metadata, prep, len(table))
    if [c.feature for c in prep.categories] != list(prep.categorical_features):
        raise BundleError("category dictionaries do not match the categorical features")
    model = LinearModel(
        tuple(r["coefficient"] for r in table),
        metadata["intercept"],
        metadata["best_C"],
        metadata["best_class_weight"],
        tuple(metadata["classes"]),
        metadata["model_type"],
    )
    return Bundle(prep, model, metadata["classification_threshold"], metadata["version"], metadata["primary_metric"])
