"""Quality, labels, split and raw-table checks that must raise."""

import datetime as dt

import pytest

from deliverylens.errors import DataQualityError, GrainError, LeakageError, SplitError
from deliverylens.operators import checks, labels, quality, split
from deliverylens.operators.mart import build_order_mart
from deliverylens.sources.tables import available_tables, missing_tables


def target(spark, rows):
    return spark.createDataFrame(rows, "delay_days INT, is_late INT")


def test_consistent_target(spark):
    quality.assert_target_consistency(target(spark, [(-5, 0), (0, 0), (1, 1), (10, 1)]))


def test_inconsistent_target(spark):
    with pytest.raises(DataQualityError, match="1 rows disagree"):
        quality.assert_target_consistency(target(spark, [(-5, 0), (3, 0)]))
    with pytest.raises(DataQualityError, match="delay_days"):
        quality.assert_target_consistency(target(spark, [(1, 1)]).drop("delay_days"))
    with pytest.raises(DataQualityError, match="empty"):
        quality.run_quality(target(spark, []))


def test_quality_run(stages):
    assert len(quality.LABELLED_COLUMNS) == 46
    assert quality.validate(stages.labelled()).count() == 36
    with pytest.raises(DataQualityError, match="customer_state"):
        quality.run_quality(stages.labelled())
    absent = quality.validate(stages.labelled().drop("payment_total"))
    failed = {(r["rule"], r["column_name"]) for r in absent.filter("unexpected_count IS NULL").collect()}
    assert failed == {("mostly_not_null", "payment_total"), ("between", "payment_total")}


def test_grain_and_leakage(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "order_id INT, x STRING")
    with pytest.raises(GrainError, match="2 rows but 1 keys"):
        checks.assert_grain(twice, ["order_id"])
    with pytest.raises(LeakageError, match="delay_days"):
        checks.assert_no_leakage(["item_count", "delay_days"])


def test_mart_rejects_duplicate_customers(stages):
    tables = dict(stages.tables)
    tables["customers"] = tables["customers"].unionByName(tables["customers"].limit(1))
    with pytest.raises(GrainError, match="customers"):
        build_order_mart(tables, check=True)


def test_null_keys_count_as_equal(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (None, "a")], "k INT, v STRING")
    row = checks.key_check(df, ["k", "v"], "t").first()
    assert (row["rows"], row["unique_keys"], row["duplicate_keys"], row["missing_key_rows"]) == (3, 2, 1, 2)


def test_bad_labels(spark):
    rows = [(1, 1), (3, 0), (-1, 0)]
    with pytest.raises(DataQualityError):
        labels.assert_labels(target(spark, rows))
    with pytest.raises(DataQualityError):
        labels.assert_labels(target(spark, [(-1, 0)]))


def test_cut_positions_are_truncated_products(spark):
    day = dt.datetime(2020, 1, 1)
    # Every row has the same time, so the key alone decides.
    df = spark.createDataFrame([(i, day, 0) for i in range(90)], "order_id INT, ts TIMESTAMP_NTZ, is_late INT")
    parts = split.chronological_split(df.repartition(5), "ts", "order_id").collect()
    train = sorted(r["order_id"] for r in parts if r["split"] == "train")
    assert train == list(range(62))
    assert sum(r["split"] == "validation" for r in parts) == int(90 * 0.85) - 62


def test_split_checks_raise(spark):
    with pytest.raises(SplitError, match="without"):
        split.find_cuts(spark.createDataFrame([(1, None)], "order_id INT, ts TIMESTAMP_NTZ"), "ts", "order_id")
    day = dt.datetime(2020, 1, 1)
    rows = [(1, day, 0, "train"), (2, day, 1, "validation"), (1, day, 0, "test")]
    df = spark.createDataFrame(rows, "order_id INT, ts TIMESTAMP_NTZ, is_late INT, split STRING")
    with pytest.raises(SplitError, match="more than one part"):
        split.check_split(df, "ts", "order_id")


def test_missing_tables(spark):
    spark.range(1).createOrReplaceTempView("present_table")
    assert "present_table" in {r[0] for r in available_tables(spark).collect()}
    assert [r[0] for r in missing_tables(spark, ["present_table", "no_such_table"]).collect()] == ["no_such_table"]


@pytest.mark.parametrize("few", [0, 500_000])
def test_whole_rows_are_compared_by_fingerprint_first(spark, monkeypatch, few):
    monkeypatch.setattr(checks, "REPEATED", few)
    rows = [(1, "a", 0.0), (1, "a", -0.0), (1, None, 0.0), (None, "a", 0.0), (1, "a", None)] + [(2, None, 1.0)] * 3 + [(i, "x", float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "`a.b` int, b string, c double")
    assert sorted((r[0], r["_n"]) for r in checks.repeated_rows(df).collect()) == [(1, 2), (2, 3)]
    found = checks.table_overview({"t": df, "none": df.limit(0)}).collect()
    assert {tuple(r) for r in found} == {("t", 58, 3, 3), ("none", 0, 3, 0)}
