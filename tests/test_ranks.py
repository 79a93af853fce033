"""Distributed order statistics against NumPy, with a hot value and a hot group."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from deliverylens.operators.metrics import average_precision, best_threshold, evaluate, roc_auc
from deliverylens.operators import quantiles
from deliverylens.operators.ranks import exact_quantiles, rows_at, running_sums


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(7)
    n = 6000
    value = np.where(rng.random(n) < 0.34, 5.0, np.round(rng.normal(3, 4, n), 2))
    group = np.where(rng.random(n) < 0.5, "hot", rng.choice(list("abcdef"), n))
    pdf = pd.DataFrame({"id": np.arange(n), "g": group, "x": value})
    pdf.loc[rng.random(n) < 0.1, "x"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("x", F.when(~F.isnan("x"), F.col("x")))
    return pdf, df.repartition(7)


def test_quantiles_per_group(skewed):
    pdf, df = skewed
    wanted = {"p05": 0.05, "q1": 0.25, "median": 0.5, "p95": 0.95, "top": 1.0, "low": 0.0}
    found = exact_quantiles(df, ["g"], "x", wanted).toPandas().set_index("g")
    for g, part in pdf.dropna().groupby("g"):
        for name, p in wanted.items():
            assert found.loc[g, name] == pytest.approx(np.quantile(part["x"], p), abs=1e-12)


def test_quantiles_without_group(skewed):
    pdf, df = skewed
    row = exact_quantiles(df, [], "x", {"median": 0.5}).first()
    assert row["median"] == pytest.approx(pdf["x"].median(), abs=1e-12)


def test_running_sums(skewed):
    pdf, df = skewed
    found = running_sums(df.select("id", "g"), [F.col("id")], ["id"], ["g"]).toPandas().sort_values("id")
    want = pdf.sort_values("id").groupby("g")["id"].cumsum()
    assert (found["cum_id"].to_numpy() == want.to_numpy()).all()


def test_rows_at(skewed):
    pdf, df = skewed
    ordered = pdf.sort_values(["g", "id"]).reset_index(drop=True)
    rows = rows_at(df, ["g", "id"], [0, 17, 5999, 17])
    assert [r["id"] for r in rows] == [ordered.loc[i, "id"] for i in (0, 17, 5999, 17)]


def test_metrics_against_brute_force(spark):
    rng = np.random.default_rng(3)
    score = np.round(rng.random(500), 1)
    label = (rng.random(500) < 0.2 + 0.3 * score).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"s": score, "y": label}))
    pos, neg = score[label == 1], score[label == 0]
    auc = np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))
    assert roc_auc(df, "s", "y").first()[0] == pytest.approx(auc, abs=1e-12)
    ap, before, best = 0.0, 0.0, (-1.0, None)
    for t in sorted(set(score), reverse=True):
        hit = score >= t
        p, r = label[hit].mean(), label[hit].sum() / label.sum()
        ap += (r - before) * p
        before = r
        f1 = 2 * p * r / (p + r + 1e-12)
        if f1 >= best[0]:
            best = (f1, t)
    assert average_precision(df, "s", "y").first()[0] == pytest.approx(ap, abs=1e-12)
    assert best_threshold(df, "s", "y").first()["threshold"] == best[1]
    row = evaluate(df, "s", "y", 0.5).first()
    hit = score >= 0.5
    assert row["accuracy"] == pytest.approx((hit == (label == 1)).mean())
    assert row["recall"] == pytest.approx((hit & (label == 1)).sum() / label.sum())


def test_metrics_without_hits_are_zero(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 0)], "s DOUBLE, y INT")
    row = evaluate(df, "s", "y", 0.9).first()
    assert (row["f1"], row["precision"], row["recall"], row["balanced_accuracy"]) == (0.0, 0.0, 0.0, 0.5)


@pytest.fixture(scope="module")
def wide():
    rng = np.random.default_rng(7)
    n = 20000
    pdf = pd.DataFrame({"g": rng.choice(["hot", "hot", "hot", "a", "b", None], n), "x": np.where(rng.random(n) < 0.34, 5.0, np.round(rng.normal(3, 4, n), 2)), "y": rng.normal(0, 1, n), "same": 1.0, "k": rng.integers(0, 3, n).astype(float), "none": np.nan})
    pdf.loc[rng.random(n) < 0.1, "x"] = np.nan
    return pdf


WANTED = {"p05": 0.05, "q1": 0.25, "median": 0.5, "p95": 0.95, "top": 1.0, "low": 0.0}


@pytest.mark.parametrize("few, accuracy, rows", [(20000, 2000, 20000), (5, 50, 20000), (0, 20, 0)])
@pytest.mark.parametrize("by", [[], ["g"]])
def test_column_quantiles_with_hot_values_and_several_rounds(spark, wide, monkeypatch, few, accuracy, rows, by):
    for name, value in (("FEW", few), ("ACCURACY", accuracy), ("STATE_ROWS", rows)):
        monkeypatch.setattr(quantiles, name, value)
    columns = ["x", "y", "same", "k", "none"]
    df = spark.createDataFrame(wide).withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("x", "none")}).repartition(7)
    got = {(r["feature"], r["g"] if by else 0): r for r in quantiles.column_quantiles(df, columns, WANTED, by).collect()}
    groups = {0: wide} if not by else {g: wide[wide.g == g] if g else wide[wide.g.isna()] for g in ("hot", "a", "b", None)}
    assert set(got) == {(c, g) for c in columns[:4] for g in groups}
    for (c, g), row in got.items():
        for name, p in WANTED.items():
            assert row[name] == pytest.approx(np.quantile(groups[g][c].dropna(), p), abs=1e-12)
    assert quantiles.column_quantiles(df.limit(0), columns, WANTED, by).count() == 0


def test_column_quantiles_shuffle_combined_rows_only(spark, wide, capsys):
    df = spark.createDataFrame(wide).select("x", "y", "k")
    quantiles.column_quantiles(df, df.columns, {"median": 0.5}).explain()
    lines = capsys.readouterr().out.splitlines()
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert below and all("Aggregate(" in line for line in below)
