"""The month with the highest late rate is one with enough orders."""

import datetime as dt

from compare import differences, open_duckdb

from deliverylens.plans.queries import QUERIES
from oracles.sql import ORACLES

TABLES = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
    "l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
}


def write_tables(spark, folder, orders):
    """Raw tables with ``orders`` of (day, late); the customer key settles on which day an order comes."""
    rows = {"nation": [(0, "BRAZIL", 1)], "supplier": [(0, "s", 0, 0.0)], "part": [(1, "p", "b", "STEEL", 3, 1.0)]}
    rows["customer"] = [(c, f"c{c}", 0, 0.0, "BUILDING") for c in range(1, 30)]
    rows["orders"], rows["lineitem"] = [], []
    for key, (day, late) in enumerate(orders, 1):
        customer = 12 * ((28 if late else 0) - 31 * key) % 29
        if late and 25 + key % 7 >= 30:
            raise ValueError(f"order {key} cannot be late")
        rows["orders"].append((key, customer or 29, "F", 1.0, day, "1-URGENT"))
        rows["lineitem"].append((key, 1, 0, 1, 1.0, 1.0, 0.0, 0.0, "N", "F", day))
    for name, schema in TABLES.items():
        spark.createDataFrame(rows[name], schema).coalesce(1).write.parquet(f"{folder}/{name}")
        (part,) = (folder / name).glob("part-*.parquet")
        (folder / f"{name}.parquet").write_bytes(part.read_bytes())
    return str(folder)


def test_a_month_of_few_orders_is_not_the_highest(spark, tmp_path):
    """12 orders of January, 7 of them late, 120 of February with 6 late; later ones are on time or outside training."""
    may_be_late = lambda key: key % 7 < 4
    january = [(dt.datetime(2024, 1, 1 + i), may_be_late(i + 1)) for i in range(12)]
    february = [(dt.datetime(2024, 2, 1 + i % 28), i < 10 and may_be_late(i + 13)) for i in range(120)]
    later = [(dt.datetime(2024, 6, 1 + i % 28), False) for i in range(68)]
    sf_dir = write_tables(spark, tmp_path, january + february + later)
    monthly = {r.purchase_year_month: (r.orders, r.late_orders) for r in QUERIES["a8_reliable_months"](spark, sf_dir).collect()}
    assert monthly["2024-01"] == (12, sum(late for _, late in january)) and monthly["2024-02"] == (120, sum(late for _, late in february))
    assert monthly["2024-01"][1] / 12 > monthly["2024-02"][1] / 120 > 0
    found = QUERIES["w5_highest_late_month"](spark, sf_dir)
    assert [(r.purchase_year_month, r.orders, r.late_orders) for r in found.collect()] == [("2024-02", *monthly["2024-02"])]
    assert differences(found, open_duckdb(sf_dir), ORACLES["w5_highest_late_month"]) == []
