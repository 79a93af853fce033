"""Scoring, saved state, order files, logs and monitoring."""

import dataclasses
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from deliverylens.errors import BundleError, FitError, OrderFileError, ScoringError
from deliverylens.operators import model, monitor, prep, score
from deliverylens.plans.queries import fixed_bundle
from deliverylens.sources import bundle as bundles
from deliverylens.sources import logs
from deliverylens.sources.orders_file import ORDER_FIELDS, load_orders
from deliverylens.sources.tables import read_sources


def test_positive_class_by_value(spark):
    df = spark.createDataFrame([([0.8, 0.2],), ([0.1, 0.9],)], "p ARRAY<DOUBLE>")
    pick = lambda classes: [r[0] for r in df.select(score.positive_probability(F.col("p"), classes)).collect()]
    assert pick((0, 1)) == [0.2, 0.9]
    assert pick((1, 0)) == [0.8, 0.1]
    with pytest.raises(ScoringError):
        score.positive_probability(F.col("p"), (0, 2))


def test_bad_probability(spark):
    df = spark.createDataFrame([([-0.2, 1.2],)], "p ARRAY<DOUBLE>")
    with pytest.raises(ScoringError, match="outside"):
        score.check_probabilities(df, "p", (0, 1))


def test_threshold_is_inclusive(spark):
    df = spark.createDataFrame([(0.39,), (0.4,), (0.41,)], "p DOUBLE")
    assert [r[0] for r in df.select(score.apply_threshold(F.col("p"), 0.4)).collect()] == [0, 1, 1]
    for bad in (True, 1.5, -0.1, "0.5"):
        with pytest.raises(ScoringError):
            score.apply_threshold(F.col("p"), bad)


def test_empty_input(stages):
    with pytest.raises(ScoringError, match="no orders"):
        score.score(stages.part("test").filter("false"), fixed_bundle(stages))


def test_trained_scores_are_probabilities(stages):
    rows = stages.scored("test").collect()
    assert len(rows) == stages.part("test").count()
    assert all(0 <= r["late_probability"] <= 1 for r in rows)
    limit = stages.bundle().threshold
    assert all(r["predicted_is_late"] == int(r["late_probability"] >= limit) for r in rows)


def test_coefficients_solve_the_penalised_problem(stages):
    """The gradient of the penalised loss is zero, intercept included."""
    features = stages.train_matrix()
    for c, weight in ((0.01, None), (1.0, "balanced")):
        found = model.fit_logistic(features, c=c, class_weight=weight)
        rows = features.collect()
        x = np.array([np.append(r["features"].toArray(), 1.0) for r in rows])
        y = np.array([r["is_late"] for r in rows], dtype=float)
        s = np.ones(len(y))
        if weight:
            s = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
        beta = np.append(found.coefficients, found.intercept)
        gradient = beta + c * x.T @ (s * (1 / (1 + np.exp(-x @ beta)) - y))
        assert np.abs(gradient).max() < 1e-7


def test_gradient_solver_agrees(stages):
    features = stages.train_matrix()
    newton = model.fit_logistic(features, c=0.01)
    weights, total = model.class_weights(features, "is_late", None)
    other = model.fit_on(model.mirrored(features, "order_id", "is_late"), 0.01, None, weights, total)
    assert np.allclose(newton.coefficients, other.coefficients, atol=1e-4)
    assert newton.intercept == pytest.approx(other.intercept, abs=1e-4)


def test_unseen_category(spark, stages):
    p = stages.preprocessor()
    rows = stages.engineered("test").limit(5).withColumn("customer_state", F.lit("NOWHERE"))
    found = {r["category"] for r in prep.encoded_categories(rows, p, ["order_id"]).filter("feature = 'customer_state'").collect()}
    state = next(c for c in p.categories if c.feature == "customer_state")
    assert found == ({prep.INFREQUENT} if state.has_infrequent else {None})


def test_bundle_is_checked(spark, stages, tmp_path):
    good = fixed_bundle(stages)
    bundles.save_bundle(spark, good, str(tmp_path))
    assert bundles.load_bundle(spark, str(tmp_path), "fixed") == good
    names, config, meta, p = good.preprocessor.feature_names, good.feature_config(), good.model_metadata(), good.preprocessor
    for what, change in (
        ("names", lambda: bundles.check_bundle(names[::-1], config, meta, p, len(names))),
        ("count", lambda: bundles.check_bundle(names, config, {**meta, "feature_count": 1}, p, len(names))),
        ("raw", lambda: bundles.check_bundle(names, {**config, "raw_feature_count": 3}, meta, p, len(names))),
        ("order", lambda: bundles.check_bundle(names, {**config, "numeric_features": config["numeric_features"][::-1]}, meta, p, len(names))),
        ("type", lambda: bundles.check_bundle(names, config, {**meta, "model_type": "Other"}, p, len(names))),
        ("threshold", lambda: bundles.check_bundle(names, config, {**meta, "classification_threshold": True}, p, len(names))),
        ("key", lambda: bundles.check_bundle(names, config, {k: v for k, v in meta.items() if k != "model_type"}, p, len(names))),
    ):
        with pytest.raises(BundleError):
            change()
    with pytest.raises(BundleError):
        bundles.save_bundle(spark, dataclasses.replace(good, threshold=2.0), str(tmp_path))


@pytest.mark.parametrize("text", ["[1, 2]", '"abc"', "[]", '[{"order_id": "1"}, 2]', "nope", '{"order_id":"1"}\n{"order_id":"2"}'])
def test_bad_json_orders(spark, tmp_path, text):
    (tmp_path / "o.json").write_text(text)
    with pytest.raises(OrderFileError):
        load_orders(spark, str(tmp_path / "o.json"))


def test_order_files(spark, tmp_path):
    (tmp_path / "one.json").write_text('{"order_id": "a", "item_count": 1}')
    assert load_orders(spark, str(tmp_path / "one.json")).first().asDict() == {"order_id": "a", "item_count": 1.0}
    (tmp_path / "two.csv").write_text("order_id,item_count\na,1\nb,\n")
    assert [tuple(r) for r in load_orders(spark, str(tmp_path / "two.csv")).collect()] == [("a", 1.0), ("b", None)]
    (tmp_path / "none.csv").write_text("order_id,item_count\n")
    (tmp_path / "x.txt").write_text("a")
    for name in ("none.csv", "x.txt", "absent.json"):
        with pytest.raises(OrderFileError):
            load_orders(spark, str(tmp_path / name))


def test_missing_source_file_is_reported(spark, tmp_path):
    (tmp_path / "sellers.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns,1234,Rio,RJ\n")
    scan = read_sources(spark, str(tmp_path))
    assert list(scan.tables) == ["sellers"] and len(scan.missing) == 8
    assert scan.tables["sellers"].first()["seller_zip_code_prefix"] == 1234


def test_contract_columns():
    assert score.contract_columns(ORDER_FIELDS) == []
    assert score.contract_columns([*ORDER_FIELDS[1:], "delay_days"]) == ["missing field: order_id", "extra field: delay_days"]


def test_prediction_log(spark, tmp_path):
    scored = spark.createDataFrame(
        [("a", None, 0.2, 0), ("b", 2.0, 0.8, 1)], "order_id STRING, x DOUBLE, late_probability DOUBLE, predicted_is_late INT"
    )
    path = str(tmp_path / "log")
    kw = dict(latency_ms=3.0, model_type="LogisticRegression", model_version="v1", threshold=0.5)
    request = logs.log_predictions(scored, path, input_columns=["order_id", "x"], **kw)
    lines = [json.loads(r[0]) for r in spark.read.text(path).collect()]
    head = [l for l in lines if l["event"] == "prediction_request"]
    rows = sorted((l for l in lines if l["event"] == "prediction"), key=lambda l: l["input"]["order_id"])
    assert len(head) == 1 and head[0]["request_size"] == 2 and head[0]["request_id"] == request
    assert rows[0]["input"] == {"order_id": "a", "x": None}
    assert rows[1]["output"] == {"late_probability": 0.8, "predicted_is_late": 1}
    with pytest.raises(ScoringError):
        logs.log_predictions(scored, path, input_columns=["absent"], **kw)
    with pytest.raises(ScoringError):
        logs.log_predictions(scored.drop("late_probability"), path, input_columns=["x"], **kw)


def lines(spark, records):
    texts = [(r if isinstance(r, str) else json.dumps(r),) for r in records]
    return logs.scan_lines(spark.createDataFrame(texts, "value STRING"))


def test_monitoring_summary(spark):
    requests = [
        {"event": "api_request", "path": "/predict", "status_code": c, "latency_ms": l}
        for c, l in ((200, 100.0), (422, 200.0), (200, 300.0))
    ]
    predictions = [
        {"event": "prediction", "output": {"late_probability": p, "predicted_is_late": y}}
        for p, y in ((0.1, 0), (0.2, 1), (0.3, 1), (0.4, 0))
    ]
    limits = monitor.MonitorLimits(2, 10, 0.2, 0.1, 0.1, 0.05, 0.05, 150.0)
    row = monitor.monitoring_summary(lines(spark, requests), lines(spark, predictions), limits).first()
    assert row["status"] == "alert"
    assert row["alerts"] == ["high_error_rate", "high_average_latency", "prediction_drift"]
    assert row["requests"]["error_rate"] == pytest.approx(1 / 3)
    assert row["requests"]["average_latency_ms"] == 200.0 and row["requests"]["max_latency_ms"] == 300.0
    assert row["requests"]["p95_latency_ms"] == pytest.approx(290.0)
    assert row["predictions"]["predicted_late_rate"] == 0.5
    assert row["predictions"]["mean_late_probability"] == pytest.approx(0.25)
    assert row["drift"]["status"] == "drift_detected"


def test_too_few_predictions_and_bad_lines(spark, tmp_path):
    good = {"event": "api_request", "path": "/predict", "status_code": 200, "latency_ms": 5}
    prediction = {"event": "prediction", "output": {"late_probability": 0.9, "predicted_is_late": 1}}
    row = monitor.monitoring_summary(lines(spark, [good, "not-json", " "]), lines(spark, [prediction])).first()
    assert row["status"] == "ok" and row["alerts"] == []
    assert row["drift"]["status"] == "insufficient_data"
    assert row["drift"]["predicted_late_rate_absolute_delta"] is None
    assert row["requests"]["request_count"] == 1 and row["invalid_log_records"]["requests"] == 1
    empty = logs.read_jsonl(spark, str(tmp_path / "absent"))
    none = monitor.monitoring_summary(empty, empty).first()
    assert none["requests"]["request_count"] == 0 and none["requests"]["error_rate"] == 0.0
    assert none["requests"]["p95_latency_ms"] is None and none["predictions"]["predicted_late_rate"] is None


def test_a_fit_that_does_not_reach_its_optimum_is_an_error(stages):
    with pytest.raises(FitError, match="2 of 2 candidates"):
        model.fit_grid(stages.features("validation"), [(1.0, None), (0.01, None)], max_passes=2)


def test_summary_parses_each_log_once(spark):
    mixed = lines(spark, ["not-json", '{"event": "prediction", "output": {"late_probability": 0.5, "predicted_is_late": 2}}', '{"event": "api_request", "path": "/health"}'])
    summary = monitor.monitoring_summary(mixed, mixed)
    found = summary.first()
    assert found.requests.request_count == 0 and found.predictions.prediction_count == 0
    assert (found.invalid_log_records.requests, found.invalid_log_records.predictions) == (1, 1)
    text = summary._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Generate explode") == 1, "the prediction log is parsed once; the request log was, before its figures were written"
