"""What a job leaves on disk, and that it is still the whole job."""

import re
import time
from pathlib import Path
from types import SimpleNamespace

from pyspark.sql import functions as F

from deliverylens.operators.labels import add_label, labelable
from deliverylens.operators.mart import build_order_mart
from deliverylens.operators.score import read_rejected, score_and_log
from deliverylens.plans.queries import _order_lines, fixed_bundle
from deliverylens.plans.stages import Stages
from deliverylens.sources.logs import read_jsonl
from deliverylens.sources.orders_file import ORDER_FIELDS
from deliverylens.sources.tables import SOURCE_SCHEMAS, write_checked
from deliverylens.streaming import scoring as streams


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString(" ")
    return set(re.findall(r"shuffle_\w+\.data", found))


def test_a_checked_table_leaves_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    rows = spark.range(1000).groupBy((F.col("id") % 50).alias("k")).agg(F.sum("id").alias("n")).join(spark.range(60), F.col("k") == F.col("id"))
    assert write_checked(rows, str(tmp_path / "t"), "k", ("n",)).count() == 50
    mine, until = None, time.time() + 20
    while mine != set() and time.time() < until:
        mine = shuffle_files(spark) - before
        time.sleep(0.2)
    # What is left is the count above, if Spark dealt it out.
    assert len(mine) <= 1 and rows.count() == 50


def commerce(spark):
    """Forty orders, some without a label, items or a key; items of unknown orders and without one."""
    def table(name, rows):
        names = [c.split()[0] for c in SOURCE_SCHEMAS[name].split(", ")]
        return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], SOURCE_SCHEMAS[name])

    days = [f"2024-01-{d:02d} 10:00:00" for d in range(1, 29)]
    orders = [
        {"order_id": f"o{i}", "customer_id": f"c{i}", "order_status": "shipped" if i % 4 == 3 else "delivered", "order_purchase_timestamp": days[i % 28],
         "order_delivered_customer_date": None if i % 10 == 1 else days[(i * 7) % 28], "order_estimated_delivery_date": days[(i * 5) % 28]}
        for i in range(40)
    ]
    items = [
        {"order_id": o, "order_item_id": n, "product_id": f"p{(i + n) % 3}" if i % 6 else None, "seller_id": f"s{i % 2}", "price": 10.0 * n + i, "freight_value": 1.0}
        for i, o in enumerate([*(f"o{i}" for i in range(38)), "absent", None]) for n in (1, 2, 2)
    ]
    return {
        "orders": table("orders", orders),
        "customers": table("customers", [{"customer_id": f"c{i}", "customer_zip_code_prefix": i % 3, "customer_state": "RJ"} for i in range(40)]),
        "order_items": table("order_items", items),
        "order_payments": table("order_payments", [{"order_id": f"o{i % 39}", "payment_type": "card", "payment_value": 2.0 * i} for i in range(60)]),
        "order_reviews": table("order_reviews", [{"review_id": f"r{i}", "order_id": f"o{i}", "review_score": i % 5} for i in range(30)]),
        "products": table("products", [{"product_id": f"p{i}", "product_category_name": f"k{i}", "product_weight_g": 100.0 * i} for i in range(2)]),
        "sellers": table("sellers", [{"seller_id": "s0", "seller_zip_code_prefix": 1, "seller_state": "SP"}]),
        "geolocation": table("geolocation", [{"geolocation_zip_code_prefix": z, "geolocation_lat": 1.0 * z, "geolocation_lng": 2.0} for z in (0, 1, 1)]),
        "product_category_translation": table("product_category_translation", [{"product_category_name": "k0", "product_category_name_english": "K0"}]),
    }


def test_items_without_a_labelled_order_are_dropped_before_their_joins(spark):
    made = Stages(spark, commerce(spark))
    orders = labelable(made.tables["orders"])
    kept = {r.order_id for r in orders.collect()}
    found = made.labelable_tables()["order_items"].collect()
    assert len(kept) == 28 and {r.order_id for r in found} == kept - {"o38"}
    assert len(found) == 27 * 3, "an item that comes twice stays twice"
    whole = add_label(build_order_mart(dict(made.tables, orders=orders)))
    rows = made.labelled()
    assert rows.count() == 28 and rows.columns == whole.columns
    assert rows.exceptAll(whole).isEmpty() and whole.exceptAll(rows).isEmpty()
    assert rows.where("order_id = 'o38' AND item_count IS NULL AND payment_records = 1").count() == 1


def test_order_lines_take_a_part_of_their_text_on_disk(spark, tmp_path):
    some = {"order_id": F.col("id"), "item_count": F.col("id") % 7, "customer_state": F.concat(F.lit("state "), F.col("id"))}
    rows = spark.range(900).coalesce(3).select(*[some.get(c, F.lit(None).cast("string")).alias(c) for c in ORDER_FIELDS])
    _order_lines(SimpleNamespace(labelled=lambda: rows), str(tmp_path / "lines"))
    lines = [r.value for r in spark.read.text(str(tmp_path / "lines")).collect()]
    assert len(lines) == 900 and sum(x.startswith("order ") for x in lines) == 9
    on_disk = sum(f.stat().st_size for f in (tmp_path / "lines").glob("part-*"))
    assert 0 < on_disk < sum(map(len, lines)) / 4


def test_lines_of_few_files_are_dealt_to_tasks(spark, stages, tmp_path):
    orders = stages.part("test").limit(30)
    rows = orders.select(*[F.col(c) if c in orders.columns else F.lit(None).alias(c) for c in ORDER_FIELDS])
    good = rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("value"))
    good.union(spark.createDataFrame([("no",), (" ",), ("no",)], "value string")).coalesce(1).write.option("compression", "gzip").text(str(tmp_path / "in"))
    found = {}
    for tasks in (None, 4):
        out = [str(tmp_path / f"{n}{tasks}") for n in ("scored", "rejected", "state")]
        streams.start_scoring_lines(streams.read_order_lines(spark, str(tmp_path / "in")), fixed_bundle(stages), *out, tasks).awaitTermination()
        assert len(list((tmp_path / f"state{tasks}-checked").glob("part-*"))) == (tasks or 1)
        found[tasks] = sorted(map(str, streams.scored_lines(spark, out[0]).collect() + streams.rejected_lines(spark, out[1]).collect()))
    assert len(found[4]) == 32 and found[4] == found[None]


def test_score_and_log_compresses_all_that_it_writes_as_text(spark, stages, tmp_path):
    some = {"order_id": F.col("id"), "item_count": F.when(F.col("id") % 10 == 0, "much").otherwise("2"), "customer_state": F.concat(F.lit("state "), F.col("id"))}
    rows = spark.range(400).coalesce(2).select(*[some.get(c, F.lit(None).cast("string")).alias(c) for c in ORDER_FIELDS])
    sinks = [str(tmp_path / n) for n in ("scores", "rejected", "log")]
    for name, codec in (("plain.csv", "none"), ("packed.csv", "gzip")):
        rows.write.option("header", True).option("compression", codec).csv(str(tmp_path / name))
        scored = score_and_log(spark, str(tmp_path / name), *sinks, fixed_bundle(stages))
        ids = {int(r.order_id) for r in scored.collect()}
        bad = read_rejected(spark, sinks[1]).collect()
        assert ids == {i for i in range(400) if i % 10} and {int(r.order_id) for r in bad} == set(range(0, 400, 10))
        assert {r.item_count for r in bad} == {"much"} and {tuple(r.reasons) for r in bad} == {("item_count is not a number",)}
    # The log is appended to, the others are replaced: 360 predictions and a request in each of two runs.
    report = read_jsonl(spark, sinks[2]).report.first()
    assert (report.lines, report.invalid) == (722, 0)
    for sink in sinks:
        files = list(Path(sink).glob("part-*"))
        text = sum(len(r.value) + 1 for r in spark.read.text(sink).collect())
        assert files and all(f.name.endswith(".gz") for f in files)
        assert sum(f.stat().st_size for f in files) < text / 2
