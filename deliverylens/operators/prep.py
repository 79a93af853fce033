"""Fitted preprocessing: impute, scale, group rare categories, one-hot encode.

Fit collects only the fitted state (a few numbers per feature and the kept
categories, which are the columns of the model). Apply is row-wise: column
arithmetic plus one dictionary join per categorical feature.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.errors import ScoringError
from deliverylens.operators.features import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from deliverylens.operators.profile import aggregate_each, long_values, value_counts
from deliverylens.operators.quantiles import column_quantiles

MISSING_CATEGORY = "__MISSING__"
INFREQUENT = "infrequent_sklearn"
MIN_FREQUENCY = 50
# Above this many kept categories a dictionary is joined without a broadcast hint.
BROADCAST_CATEGORIES = 200_000


@dataclass(frozen=True)
class NumericState:
    """Median, and mean and population deviation after imputation."""

    feature: str
    median: float
    mean: float
    scale: float


@dataclass(frozen=True)
class IndicatorState:
    """Scaling of one missing-value indicator."""

    feature: str
    mean: float
    scale: float


@dataclass(frozen=True)
class CategoryState:
    """Kept categories in sorted order, and whether rare ones were folded."""

    feature: str
    categories: tuple[str, ...]
    has_infrequent: bool

    @property
    def width(self) -> int:
        return len(self.categories) + int(self.has_infrequent)


@dataclass(frozen=True)
class Preprocessor:
    """Fitted state; input lists are kept for the checks at load."""

    numeric_features: tuple[str, ...]
    categorical_features: tuple[str, ...]
    numeric: tuple[NumericState, ...]
    indicators: tuple[IndicatorState, ...]
    categories: tuple[CategoryState, ...]

    @property
    def raw_features(self) -> list[str]:
        return [*self.numeric_features, *self.categorical_features]

    @property
    def feature_names(self) -> list[str]:
        """Output columns in order: numeric, indicators, then categories."""
        names = [f"numeric__{n.feature}" for n in self.numeric]
        names += [f"numeric__missingindicator_{i.feature}" for i in self.indicators]
        for c in self.categories:
            names += [f"categorical__{c.feature}_{v}" for v in c.categories]
            if c.has_infrequent:
                names.append(f"categorical__{c.feature}_{INFREQUENT}")
        return names

    @property
    def width(self) -> int:
        return len(self.numeric) + len(self.indicators) + sum(c.width for c in self.categories)


def _number(name: str) -> Column:
    x = F.col(name).cast("double")
    return F.when(~F.isnan(x), x)


def _scale(variance: float | None, mean: float, rows: int) -> float:
    """Population deviation, or 1 for a column that is constant up to rounding."""
    eps = sys.float_info.epsilon
    if variance is None or variance <= rows * eps * variance + (rows * mean * eps) ** 2:
        return 1.0
    return variance**0.5


def fit_imputer(train: DataFrame, features: Sequence[str] = NUMERIC_FEATURES) -> DataFrame:
    """Exact median and number of missing values per feature."""
    numbers = train.select(*[_number(c).alias(c) for c in features])
    missing = aggregate_each(numbers, features, lambda c: {"missing_count": F.count_if(F.col(c).isNull())})
    medians = column_quantiles(numbers, features, {"median": 0.5})
    return missing.join(medians, "feature", "left").select("feature", "median", "missing_count")


def imputed(feature: str, median: float) -> Column:
    return F.coalesce(_number(feature), F.lit(median))


def indicator(feature: str) -> Column:
    """1 where the feature is missing."""
    return F.when(_number(feature).isNull(), 1.0).otherwise(0.0)


def fit_scaler(train: DataFrame, medians: dict[str, float], indicators: Sequence[str]) -> DataFrame:
    """Mean and population variance of imputed features and of indicators."""
    columns = {f: imputed(f, m) for f, m in medians.items()}
    columns |= {f"missingindicator_{f}": indicator(f) for f in indicators}
    ready = train.select(*[expr.alias(name) for name, expr in columns.items()])
    return aggregate_each(
        ready,
        list(columns),
        lambda c: {"mean": F.avg(c), "variance": F.var_pop(c), "rows": F.count(F.lit(1))},
    )


def fill_missing_category(df: DataFrame, features: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CATEGORY)) for c in features})


def fit_categories(
    train: DataFrame,
    features: Sequence[str] = CATEGORICAL_FEATURES,
    min_frequency: int = MIN_FREQUENCY,
) -> DataFrame:
    """Rows per category of each feature and whether it is kept."""
    counts = value_counts(fill_missing_category(train.select(*features), features), features, "feature")
    return counts.select("feature", F.col("value").alias("category"), "n", (F.col("n") >= min_frequency).alias("kept"))


def fit(
    train: DataFrame,
    numeric: Sequence[str] = NUMERIC_FEATURES,
    categorical: Sequence[str] = CATEGORICAL_FEATURES,
    min_frequency: int = MIN_FREQUENCY,
) -> Preprocessor:
    """Fit on the training rows only."""
    imputer = {r["feature"]: r for r in fit_imputer(train, numeric).collect()}
    # A feature without any value cannot be imputed and is left out.
    medians = {f: imputer[f]["median"] for f in numeric if imputer[f]["median"] is not None}
    marked = [f for f in numeric if imputer[f]["missing_count"] > 0]
    scaler = {r["feature"]: r for r in fit_scaler(train, medians, marked).collect()}

    def scale(name: str) -> tuple[float, float]:
        r = scaler[name]
        return r["mean"], _scale(r["variance"], r["mean"], r["rows"])

    # The kept categories, and one row without a category for each feature that folds some.
    categories = fit_categories(train, categorical, min_frequency)
    state = categories.select("feature", F.when(F.col("kept"), F.col("category")).alias("category")).distinct()
    kept: dict[str, list[str]] = {c: [] for c in categorical}
    folded = set()
    for r in state.collect():
        if r["category"] is None:
            folded.add(r["feature"])
        else:
            kept[r["feature"]].append(r["category"])
    return Preprocessor(
        tuple(numeric),
        tuple(categorical),
        tuple(NumericState(f, m, *scale(f)) for f, m in medians.items()),
        tuple(IndicatorState(f, *scale(f"missingindicator_{f}")) for f in marked),
        tuple(CategoryState(c, tuple(sorted(kept[c])), c in folded) for c in categorical),
    )


def numeric_columns(prep: Preprocessor) -> dict[str, Column]:
    """Scaled numeric columns and indicators by output name."""
    out = {
        f"numeric__{n.feature}": (imputed(n.feature, n.median) - F.lit(n.mean)) / F.lit(n.scale) for n in prep.numeric
    }
    out |= {
        f"numeric__missingindicator_{i.feature}": (indicator(i.feature) - F.lit(i.mean)) / F.lit(i.scale)
        for i in prep.indicators
    }
    return out


def _dictionary(spark: SparkSession, state: CategoryState) -> DataFrame:
    values = F.array(*[F.lit(v) for v in state.categories]).cast("array<string>")
    table = spark.range(1).select(F.posexplode(values).alias("_slot", "_category"))
    return F.broadcast(table) if len(state.categories) <= BROADCAST_CATEGORIES else table


def category_slots(df: DataFrame, prep: Preprocessor) -> DataFrame:
    """Add ``<feature>__slot``: position of the category within its feature.

    A category not kept at fit time goes to the infrequent slot, or to null
    where the feature has none. One hash lookup per feature.
    """
    for state in prep.categories:
        unseen = F.lit(len(state.categories)) if state.has_infrequent else F.lit(None).cast("int")
        filled = F.coalesce(F.col(state.feature).cast("string"), F.lit(MISSING_CATEGORY))
        dictionary = _dictionary(df.sparkSession, state)
        df = (
            df.join(dictionary, filled == F.col("_category"), "left")
            .withColumn(f"{state.feature}__slot", F.coalesce(F.col("_slot"), unseen))
            .drop("_category", "_slot")
        )
    return df


def encoded_categories(df: DataFrame, prep: Preprocessor, keep: Sequence[str]) -> DataFrame:
    """One row per row and categorical feature: the category it is encoded as.

    The category is null where a row is encoded as all zeros.
    """
    slots = category_slots(df, prep)
    parts = []
    for state in prep.categories:
        names = [*state.categories, *([INFREQUENT] if state.has_infrequent else [])]
        lookup = F.get(F.array(*[F.lit(n) for n in names]).cast("array<string>"), F.col(f"{state.feature}__slot"))
        parts.append(F.struct(F.lit(state.feature).alias("feature"), lookup.alias("category")))
    return slots.select(*keep, F.inline(F.array(*parts)))


def apply_numeric(df: DataFrame, prep: Preprocessor, keep: Sequence[str]) -> DataFrame:
    """The numeric block as plain columns."""
    return df.select(*keep, *[expr.alias(name) for name, expr in numeric_columns(prep).items()])


def _one_hot_encoder(spark: SparkSession, prep: Preprocessor) -> object:
    """Spark ML encoder with the fitted widths; an index past the end gives zeros."""
    deepest = max(c.width for c in prep.categories)
    rows = [tuple(float(min(i, c.width - 1)) for c in prep.categories) for i in range(max(deepest, 1))]
    names = [f"{c.feature}__index" for c in prep.categories]
    sizes = spark.createDataFrame(rows, ", ".join(f"`{n}` DOUBLE" for n in names))
    encoder = OneHotEncoder(
        inputCols=names,
        outputCols=[f"{c.feature}__onehot" for c in prep.categories],
        handleInvalid="keep",
        dropLast=True,
    )
    return encoder.fit(sizes)


def transform(df: DataFrame, prep: Preprocessor, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns plus ``features``: one sparse vector per row, other columns dropped."""
    absent = [c for c in prep.raw_features if c not in df.columns]
    if absent:
        raise ValueError("model feature columns are missing: " + ", ".join(absent))
    slots = category_slots(df.select(*dict.fromkeys([*keep, *prep.raw_features])), prep)
    numeric = numeric_columns(prep)
    indexed = slots.select(
        *keep,
        *[expr.alias(name) for name, expr in numeric.items()],
        *[F.coalesce(F.col(f"{c.feature}__slot"), F.lit(c.width)).cast("double").alias(f"{c.feature}__index") for c in prep.categories],
    )
    encoder = _one_hot_encoder(df.sparkSession, prep)
    assembler = VectorAssembler(
        inputCols=[*numeric, *encoder.getOutputCols()], outputCol="features", handleInvalid="keep"
    )
    return assembler.transform(encoder.transform(indexed)).select(*keep, "features")


def feature_report(features: DataFrame, prep: Preprocessor) -> DataFrame:
    """One row: rows, rows of another width, rows with a value that is not finite."""
    from pyspark.ml.functions import vector_to_array

    values = vector_to_array("features")
    bad = F.exists(values, lambda v: F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return features.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.size(values) != prep.width).alias("wrong_width"),
        F.count_if(bad).alias("not_finite"),
    )


def check_features(features: DataFrame, prep: Preprocessor) -> None:
    """Raise unless every row has the fitted width and finite values."""
    r = feature_report(features, prep).first()
    if r["wrong_width"]:
        raise ScoringError(f"{r['wrong_width']} rows do not have {prep.width} features")
    if r["not_finite"]:
        raise ScoringError(f"{r['not_finite']} rows hold NaN or infinite features")
