"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data, ``BENCH_CPUS`` the local cores. Every time is
from calling the query to having all its rows written to a no-op sink. The
stage steps (split table, fitted preprocessing, model grid) are built on first
use and timed as entries of their own, so later entries read what they left.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "a7_late_rate_by_state_all",
    "q1_table_overview",
    "q3_key_check",
    "q5_orphans",
    "a2_item_aggregate",
    "j3_order_mart",
    "w1_chronological_split",
    "a10_describe_numeric",
    "a11_class_means_medians",
    "a14_outlier_summary",
    "a16_correlation_matrix",
    "a17_column_profile",
    "a19_missing_impact",
    "a20_categorical_summary",
    "a24_box_stats",
    "a27_late_rate_tables",
    "f14_engineer_features",
    "d1_quality_report",
    "m6_one_hot_categories",
    "m7_feature_vectors",
    "e6_threshold_metrics",
    "e8_results_summary",
    "e11_score_trained",
    "b5_monitoring_summary",
    "b7_stream_request_windows",
)


def main() -> None:
    from pyspark.sql import SparkSession

    from deliverylens.plans.queries import QUERIES
    from deliverylens.plans.stages import fixture_stages

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # The JVM and the Parquet reader are started before the first timing.
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    stages = fixture_stages(spark, sf_dir)
    times: dict[str, float] = {}

    def timed(name: str, run) -> None:
        start = time.perf_counter()
        run()
        times[name] = round(time.perf_counter() - start, 3)

    def whole(name: str):
        return lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    for name in HEADLINE[:7]:
        timed(name, whole(name))
    timed("stage_split_table", stages.split_table)
    timed("stage_fit_preprocessor", stages.preprocessor)
    timed("stage_train_matrix", stages.train_matrix)
    timed("stage_tune_grid", stages.tuning)
    timed("stage_bundle", stages.bundle)
    for name in HEADLINE[7:]:
        timed(name, whole(name))
    scale = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
