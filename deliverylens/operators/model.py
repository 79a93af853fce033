"""Prior baseline and L2 logistic regression."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Interaction, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from deliverylens.errors import FitError
from deliverylens.operators import metrics
from deliverylens.operators.prep import Preprocessor, category_slots, numeric_columns

C_VALUES = (0.01, 0.1, 1.0, 10.0)
CLASS_WEIGHTS = (None, "balanced")
# Widest input for which curvature tables are summed (one number per pair of inputs).
NEWTON_WIDTH = 1000


@dataclass(frozen=True)
class LinearModel:
    """Coefficients in feature order. ``classes`` gives the label values in order."""

    coefficients: tuple[float, ...]
    intercept: float
    c: float
    class_weight: str | None
    classes: tuple[int, ...] = (0, 1)
    model_type: str = "LogisticRegression"


def prior_rate(train: DataFrame, label: str = "is_late") -> float:
    """Share of positive training rows."""
    return train.agg(F.avg(F.col(label).cast("double"))).first()[0]


def prior_score(rate: float) -> Column:
    """The baseline gives every row the training rate."""
    return F.lit(float(rate))


def class_weights(train: DataFrame, label: str, class_weight: str | None) -> tuple[dict[int, float], float]:
    """Weight per class and the sum of the weights over all rows."""
    counts = {int(r[label]): r["n"] for r in train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    n = sum(counts.values())
    if class_weight is None:
        return {k: 1.0 for k in counts}, float(n)
    return {k: n / (len(counts) * v) for k, v in counts.items()}, float(n)


def mirrored(features: DataFrame, key: str, label: str) -> DataFrame:
    """Rows with a constant input added, half of them point-mirrored.

    (x, 1, y) and (-x, -1, 1 - y) have the same logistic loss. Mirroring half
    the rows gives the constant column a spread, so the solver fits it like
    any other input and its coefficient, the intercept, is penalised too.
    """
    odd = F.pmod(F.xxhash64(key), F.lit(2)) == 1
    signed = features.withColumns({"_one": F.lit(1.0), "_sign": F.when(odd, -1.0).otherwise(1.0)})
    with_one = VectorAssembler(inputCols=["features", "_one"], outputCol="_x").transform(signed)
    flipped = Interaction(inputCols=["_sign", "_x"], outputCol="_signed").transform(with_one)
    y = F.col(label).cast("double")
    return flipped.select(
        F.col("_signed").alias("features"),
        F.when(odd, 1.0 - y).otherwise(y).alias("_y"),
        F.col(label).cast("int").alias("_class"),
    )


def fit_on(rows: DataFrame, c: float, class_weight: str | None, weights: dict[int, float], weight_sum: float) -> LinearModel:
    """Fit on mirrored rows."""
    weight = F.lit(1.0)
    for value, w in weights.items():
        weight = F.when(F.col("_class") == value, F.lit(w)).otherwise(weight)
    solver = LogisticRegression(
        featuresCol="features",
        labelCol="_y",
        weightCol="_weight",
        fitIntercept=False,
        standardization=False,
        regParam=1.0 / (c * weight_sum),
        elasticNetParam=0.0,
        maxIter=2000,
        tol=1e-10,
    )
    found = solver.fit(rows.withColumn("_weight", weight)).coefficients.toArray().tolist()
    return LinearModel(tuple(found[:-1]), found[-1], c, class_weight)


def _newton_sums(rows: DataFrame, points: dict[int, np.ndarray], weights: dict[int, dict[int, float]]) -> dict[int, np.ndarray]:
    """Loss, gradient and curvature of each candidate at its current point, from one pass.

    Every task adds up its own rows and emits one vector per candidate; Spark
    adds the vectors.
    """

    def partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.empty:
                continue
            x = np.vstack(batch["x"].to_numpy())
            x = np.hstack([x, np.ones((len(x), 1))])
            y = batch["y"].to_numpy(dtype=float)
            upper = np.triu_indices(x.shape[1])
            for k, beta in points.items():
                z = x @ beta
                p = 1.0 / (1.0 + np.exp(-np.clip(z, -700, 700)))
                s = np.where(y == 1, weights[k].get(1, 1.0), weights[k].get(0, 1.0))
                loss = (s * (np.logaddexp(0.0, z) - y * z)).sum()
                curvature = (x * (s * p * (1 - p))[:, None]).T @ x
                found = np.concatenate([[loss], x.T @ (s * (p - y)), curvature[upper]])
                totals[k] = totals[k] + found if k in totals else found
        if totals:
            yield pd.DataFrame({"candidate": list(totals), "sums": [v.tolist() for v in totals.values()]})

    parts = rows.mapInPandas(partial_sums, "candidate INT, sums ARRAY<DOUBLE>")
    summed = parts.groupBy("candidate").agg(Summarizer.sum(array_to_vector("sums")).alias("sums"))
    return {r["candidate"]: r["sums"].toArray() for r in summed.collect()}


def fit_grid(
    features: DataFrame,
    grid: Sequence[tuple[float, str | None]],
    label: str = "is_late",
    max_passes: int = 60,
    tolerance: float = 1e-10,
) -> list[LinearModel]:
    """Fit all candidates together by Newton steps; one pass over the rows per step.

    The penalty is half the squared length of all coefficients, the intercept
    included, against ``C`` times the weighted loss. A candidate that is not at its
    optimum after ``max_passes`` is an error, never a result.
    """
    rows = features.select(vector_to_array("features").alias("x"), F.col(label).cast("double").alias("y"))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        width = len(rows.first()["x"]) + 1
        weights = {k: class_weights(features, label, cw)[0] for k, (_, cw) in enumerate(grid)}
        points = {k: np.zeros(width) for k in range(len(grid))}
        accepted: dict[int, tuple[float, np.ndarray, np.ndarray]] = {}
        done: dict[int, np.ndarray] = {}
        upper = np.triu_indices(width)
        for _ in range(max_passes):
            sums = _newton_sums(rows, points, weights)
            for k in list(points):
                c, beta = grid[k][0], points[k]
                loss = 0.5 * beta @ beta + c * sums[k][0]
                if k in accepted and loss > accepted[k][0] * (1 + 1e-12):
                    # The step went too far: halve it.
                    _, base, step = accepted[k]
                    accepted[k] = (accepted[k][0], base, step / 2)
                    points[k] = base - step / 2
                    continue
                curvature = np.zeros((width, width))
                curvature[upper] = sums[k][1 + width :]
                curvature = c * (curvature + np.triu(curvature, 1).T) + np.eye(width)
                step = np.linalg.solve(curvature, beta + c * sums[k][1 : 1 + width])
                accepted[k] = (loss, beta, step)
                points[k] = beta - step
                if np.abs(step).max() <= tolerance * (1 + np.abs(beta).max()):
                    done[k] = points.pop(k)
            if not points:
                break
    finally:
        rows.unpersist()
    if points:
        raise FitError(f"{len(points)} of {len(grid)} candidates are not at their optimum after {max_passes} passes: {[grid[k] for k in points]}")
    return [
        LinearModel(tuple(done[k][:-1].tolist()), float(done[k][-1]), c, class_weight)
        for k, (c, class_weight) in enumerate(grid)
    ]


def fit_candidates(
    features: DataFrame,
    grid: Sequence[tuple[float, str | None]],
    key: str = "order_id",
    label: str = "is_late",
) -> list[LinearModel]:
    """L2 logistic regression for each (C, class weight).

    Up to ``NEWTON_WIDTH`` inputs the candidates share a few passes; beyond
    that the curvature table is too large to pass around and Spark ML's
    gradient solver fits them one by one.
    """
    if len(features.select(vector_to_array("features").alias("x")).first()["x"]) <= NEWTON_WIDTH:
        return fit_grid(features, grid, label)
    rows = mirrored(features, key, label).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return [fit_on(rows, c, cw, *class_weights(features, label, cw)) for c, cw in grid]
    finally:
        rows.unpersist()


def fit_logistic(
    features: DataFrame,
    key: str = "order_id",
    label: str = "is_late",
    c: float = 1.0,
    class_weight: str | None = None,
) -> LinearModel:
    """L2 logistic regression with penalty weight ``c``; the intercept is penalised."""
    return fit_candidates(features, [(c, class_weight)], key, label)[0]


@dataclass(frozen=True)
class TuningResult:
    """The fitted grid, best first."""

    models: tuple[LinearModel, ...]
    table: tuple[dict, ...]

    @property
    def best(self) -> LinearModel:
        return self.models[0]


def tune(
    train_features: DataFrame,
    validation: DataFrame,
    prep: Preprocessor,
    key: str = "order_id",
    label: str = "is_late",
    c_values: Sequence[float] = C_VALUES,
    class_weight_values: Sequence[str | None] = CLASS_WEIGHTS,
) -> TuningResult:
    """Fit the grid on the training rows, rank it by validation average precision.

    Equal scores keep grid order.
    """
    grid = [(c, cw) for c in c_values for cw in class_weight_values]
    models = fit_candidates(train_features, grid, key, label)
    scored = candidate_scores(validation, prep, dict(enumerate(models)), [label])
    rows = {r["candidate"]: r.asDict() for r in metrics.evaluate(scored, "score", label, 0.5, ["candidate"]).collect()}
    order = sorted(range(len(models)), key=lambda k: -rows[k]["average_precision"])
    table = [
        {"c": models[k].c, "class_weight": models[k].class_weight or "None", **{m: v for m, v in rows[k].items() if m != "candidate"}}
        for k in order
    ]
    return TuningResult(tuple(models[k] for k in order), tuple(table))


def linear_terms(df: DataFrame, prep: Preprocessor, models: Sequence[LinearModel]) -> tuple[DataFrame, list[Column]]:
    """``df`` with scaled inputs and category slots, and each model's linear predictor."""
    numeric = numeric_columns(prep)
    scaled = {f"_x{i}": expr for i, expr in enumerate(numeric.values())}
    rows = category_slots(df.withColumns(scaled), prep)
    predictors = []
    for model in models:
        if len(model.coefficients) != prep.width:
            raise ValueError(f"model has {len(model.coefficients)} coefficients, features have {prep.width}")
        z = F.lit(model.intercept)
        for name, weight in zip(scaled, model.coefficients):
            z = z + F.lit(weight) * F.col(name)
        at = len(scaled)
        for state in prep.categories:
            part = model.coefficients[at : at + state.width]
            weights = F.array(*[F.lit(w) for w in part]).cast("array<double>")
            z = z + F.coalesce(F.get(weights, F.col(f"{state.feature}__slot")), F.lit(0.0))
            at += state.width
        predictors.append(z)
    return rows, predictors


def _logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def class_probabilities(df: DataFrame, prep: Preprocessor, model: LinearModel, name: str = "probability") -> DataFrame:
    """Add the class probabilities as an array in the order of ``model.classes``."""
    rows, (z,) = linear_terms(df, prep, [model])
    second = rows.withColumn("_p", _logistic(z))
    return second.select(*df.columns, F.array(1 - F.col("_p"), F.col("_p")).alias(name))


def candidate_scores(df: DataFrame, prep: Preprocessor, models: dict[object, LinearModel], keep: Sequence[str]) -> DataFrame:
    """Long form: one row per row and model, with the model's name and score."""
    rows, predictors = linear_terms(df, prep, list(models.values()))
    scores = [
        F.struct(F.lit(name).alias("candidate"), _logistic(z).alias("score")) for name, z in zip(models, predictors)
    ]
    return rows.select(*keep, F.inline(F.array(*scores)))


def model_scores(df: DataFrame, prep: Preprocessor, model: LinearModel, keep: Sequence[str] = ("is_late",)) -> DataFrame:
    """``keep`` columns and the positive-class score."""
    rows, (z,) = linear_terms(df, prep, [model])
    return rows.select(*keep, _logistic(z).alias("score"))
