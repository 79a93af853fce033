"""Properties of physical plans that matter at scale."""

import contextlib
import io

from conftest import SF_DIR

from deliverylens.operators import mart, profile, score
from deliverylens.plans.queries import QUERIES, fixed_bundle


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_row_paths_have_no_python_and_no_pair_products(spark, stages):
    frames = [
        mart.build_order_mart(stages.tables),
        score.score_rows(stages.part("test"), fixed_bundle(stages)),
        stages.features("test"),
        profile.column_profile(stages.train()),
        profile.late_rate_tables(stages.train_profile(), profile.CATEGORICAL_COLUMNS),
    ]
    for df in frames:
        text = plan(df)
        for operator in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin", "Window "):
            assert operator not in text, operator


def test_items_are_read_once(stages):
    t = stages.tables
    details = mart.item_details(*(t[n] for n in ("order_items", "products", "product_category_translation", "sellers")), mart.zip_centroids(t["geolocation"]))
    text = plan(mart.aggregate_items(details))
    assert text.count("lineitem.parquet") == 1
    tree = text[: text.index("(1) ")]
    assert tree.index("Generate") < tree.index("Exchange"), "values are counted behind the last shuffle"
    assert text.count("hashpartitioning(order_id#") == 1, "both aggregates keep the partitioning by order"


def test_scoring_does_not_shuffle(stages):
    text = plan(score.score_rows(stages.part("test"), fixed_bundle(stages)))
    assert "HashPartitioning" not in text and "hashpartitioning" not in text


def test_part_pruning(stages):
    text = plan(mart.build_order_mart(stages.tables, ["order_id", "customer_state"]))
    assert "lineitem" not in text


def test_split_table_is_pruned(stages):
    text = plan(profile.late_rate_by(stages.train(), "customer_state"))
    assert "PartitionFilters: [isnotnull(split" in text
    schema = text.split("ReadSchema:")[1].splitlines()[0]
    assert "customer_state" in schema and "payment_total" not in schema


def test_entry(spark):
    assert QUERIES["a7_late_rate_by_state_all"](spark, SF_DIR).count() > 0
