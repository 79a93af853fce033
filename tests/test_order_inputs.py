"""Order files and streams lose or swap no values."""

import pytest
from conftest import SF_DIR  # noqa: F401
from pyspark.sql import functions as F

from deliverylens.errors import OrderFileError
from deliverylens.functions.jsonlog import safe_float, text_field
from deliverylens.operators.mart import parse_dates, unparsed_dates
from deliverylens.errors import ScoringError
from deliverylens.operators.score import ORDER_FIELDS, mark_lines, read_rejected, score_and_log
from deliverylens.sources.logs import scan_lines
from deliverylens.sources.orders_file import load_orders, read_order_file
from deliverylens.streaming import scoring as streams
from deliverylens.streaming.scoring import read_order_stream, rejected_stream, scored_stream, start_scoring
from deliverylens.plans.queries import fixed_bundle


def test_csv_files_with_other_column_order_are_refused(spark, tmp_path):
    folder = tmp_path / "orders.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("order_id,item_count,payment_total\na,2,20\n")
    (folder / "b.csv").write_text("order_id,payment_total,item_count\nb,20,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_orders(spark, str(folder)).collect()


def test_stream_writes_scored_and_rejected_records(spark, stages, tmp_path):
    orders = stages.part("test").limit(20)
    rows = orders.select(*[F.col(c) if c in orders.columns else F.lit(None).alias(c) for c in ORDER_FIELDS])
    bad = rows.limit(3).withColumn("order_id", F.lit(None).cast("string"))
    rows.union(bad).write.json(str(tmp_path / "in"))
    bundle, stream = fixed_bundle(stages), read_order_stream(spark, str(tmp_path / "in"))
    for name, made in (("scored", scored_stream(stream, bundle)), ("rejected", rejected_stream(stream))):
        start_scoring(made, str(tmp_path / name), str(tmp_path / f"{name}-state")).awaitTermination()
    scored, rejected = (spark.read.parquet(str(tmp_path / n)) for n in ("scored", "rejected"))
    assert scored.count() + rejected.count() == rows.union(bad).count()
    assert rejected.where(F.col("order_id").isNull() & (F.size("reasons") > 0)).count() == 3


def test_a_value_that_is_no_number_is_rejected_in_every_text_format(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"order_id":"1","item_count":"much"}\nnot json\n')
    rejected = rejected_stream(read_order_stream(spark, str(tmp_path / "in")))
    start_scoring(rejected, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).select("order_id", "reasons").collect()
    assert {r["order_id"]: r["reasons"] for r in found} == {"1": ["item_count is not a number"], None: ["order_id is empty"]}


def test_lines_end_in_one_of_two_sinks_and_batches_replace_theirs(spark, stages, tmp_path):
    orders = stages.part("test").limit(7)
    rows = orders.select(*[F.col(c) if c in orders.columns else F.lit(None).alias(c) for c in ORDER_FIELDS])
    good = [r[0] for r in rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})).collect()]
    bad = ["", "  ", "[1]", "no", '{"order_id":"1"}', good[0][:-1] + ',"note":1}', "null", good[0][:-1] + ',"order_id":"twice"}']
    why = {r["line"]: r["reasons"] for r in mark_lines(spark.createDataFrame([(x,) for x in bad], "value string")).collect()}
    assert len(why) == 6 and all(why.values()) and why["[1]"] == why["no"] == ["no JSON object"]
    assert len(why['{"order_id":"1"}']) == len(ORDER_FIELDS) - 1 and why[bad[5]] == ["extra field: note"]
    folder, out = tmp_path / "in", [str(tmp_path / n) for n in ("scored", "rejected")]
    folder.mkdir()

    def run(state):
        lines = streams.read_order_lines(spark, str(folder))
        streams.start_scoring_lines(lines, fixed_bundle(stages), *out, str(tmp_path / state)).awaitTermination()
        return streams.scored_lines(spark, out[0]).count(), streams.rejected_lines(spark, out[1]).count()

    assert run("first") == (0, 0)
    (folder / "a.json").write_text("\n".join([*good, *bad]) + "\n")
    assert run("state") == (7, 6)
    assert run("state") == (7, 6)
    assert run("again") == (7, 6)  # the same batch after a lost checkpoint


def test_score_and_log_applies_the_contract(spark, stages, tmp_path):
    orders = stages.part("test").limit(9)
    rows = orders.select(*[F.col(c) if c in orders.columns else F.lit(None).alias(c) for c in ORDER_FIELDS])
    no_id = rows.limit(2).withColumn("order_id", F.lit(None).cast("string"))
    rows.union(no_id).write.option("header", True).csv(str(tmp_path / "some.csv"))
    rows.write.option("header", True).csv(str(tmp_path / "all.csv"))
    rows.drop("item_count").write.option("header", True).csv(str(tmp_path / "less.csv"))

    def run(name):
        paths = [str(tmp_path / f"{name}-{n}") for n in ("scores", "rejected", "log")]
        return score_and_log(spark, str(tmp_path / f"{name}.csv"), *paths, fixed_bundle(stages)), read_rejected(spark, paths[1]), spark.read.text(paths[2])

    scored, rejected, log = run("some")
    assert (scored.count(), log.count()) == (9, 10)
    assert [r["reasons"] for r in rejected.collect()] == [["order_id is empty"]] * 2
    logged = log.select(F.get_json_object("value", "$.output.late_probability").cast("double").alias("p")).where("p is not null")
    assert sorted(r["p"] for r in logged.collect()) == pytest.approx(sorted(r["late_probability"] for r in scored.collect()), abs=0)
    scored, rejected, _ = run("all")
    assert (scored.count(), rejected.count()) == (9, 0)
    with pytest.raises(ScoringError, match="missing field: item_count"):
        run("less")


def test_orders_with_bad_values_are_kept_apart(spark, tmp_path):
    path = tmp_path / "orders.csv"
    path.write_text("order_id,item_count,order_approved_at\na,2,2018-01-01 10:00:00\nb,much,2018-01-01\nc,,soon\n")
    fit, misfit = read_order_file(spark, str(path))
    assert [r["order_id"] for r in fit.collect()] == ["a"]
    assert {r["order_id"]: r["reasons"] for r in misfit.collect()} == {"b": ["item_count is no double"], "c": ["order_approved_at is no timestamp_ntz"]}
    with pytest.raises(OrderFileError, match="no double|no timestamp"):
        load_orders(spark, str(path))


def test_log_lines_that_other_parsers_accept(spark):
    lines = [
        '{"a": 1, "a": 2}',
        '{"a": NaN, "b": [-Infinity, Infinity], "c": "NaN, \\" NaN"}',
        '{"a": "x NaN"}',
        '{"a": NaN',
        "NaN",
    ]
    scan = scan_lines(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert scan.report.first().asDict() == {"lines": 5, "records": 3, "invalid": 2}
    a, c = (safe_float(F.col("record"), "$.a").alias("a"), text_field(F.col("record"), "$.c").alias("c"))
    assert [tuple(r) for r in scan.records.select(a, c).collect()] == [(2.0, None), (None, 'NaN, " NaN'), (None, None)]


def test_dates_of_csv_files_are_parsed_and_counted(spark):
    orders = spark.createDataFrame([("a", "2018-01-01 10:00:00"), ("b", "soon"), ("c", None)], "order_id string, order_approved_at string")
    assert unparsed_dates({"orders": orders}) == {"orders": {"order_approved_at": 1}}
    parsed = parse_dates({"orders": orders})["orders"]
    assert dict(parsed.dtypes)["order_approved_at"] == "timestamp_ntz" and parsed.filter("order_approved_at is null").count() == 2
