"""The steps from raw tables to a scored test set, each built once per run.

Label, profile, fit and scoring all read the split table, so it is written
once, partitioned by split, to the shared folder; later steps read only the
columns and the part they need.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deliverylens.operators import metrics, model, prep, profile, split
from deliverylens.operators.checks import stack
from deliverylens.operators.features import engineer_features, profile_features, select_model_features
from deliverylens.operators.labels import add_label, labelable
from deliverylens.operators.mart import ITEM_INPUTS, aggregate_payments, build_order_mart, item_measures, parse_dates
from deliverylens.session import cut_lineage, run_dir, short_lived_shuffles
from deliverylens.sources.bundle import Bundle
from deliverylens.sources.fixtures import commerce_table, commerce_tables
from deliverylens.sources.tables import read_table, write_checked, write_table

PURCHASE_TIME = "order_purchase_timestamp"


class Stages:
    """Lazily built stage results over one set of commerce tables."""

    def __init__(
        self,
        spark: SparkSession,
        tables: dict[str, DataFrame],
        log_lines: Callable[[str], DataFrame] | None = None,
    ):
        self.spark = spark
        self.tables = parse_dates(tables)
        self._log_lines = log_lines
        self._built: dict[str, object] = {}

    def _once(self, name: str, build):
        if name not in self._built:
            self._built[name] = build()
        return self._built[name]

    def log(self, name: str) -> DataFrame:
        """Text lines of ``request_log`` or ``prediction_log`` in column ``value``."""
        if self._log_lines is None:
            raise ValueError("these stages have no logs")
        return self._log_lines(name)

    def labelable_tables(self) -> dict[str, DataFrame]:
        """The tables with the orders that get a label, and with the items of these.

        Orders and items are filtered before the joins; parts only lose orders
        that are not there any more.
        """
        orders = labelable(self.tables["orders"])
        items = self.tables["order_items"].join(orders.select("order_id"), "order_id", "left_semi")
        return dict(self.tables, orders=orders, order_items=items)

    def labelled_lazy(self, parts: Mapping[str, DataFrame] | None = None) -> DataFrame:
        """Mart, label and filter as one plan over the raw tables, and over written parts of the mart if given."""
        return add_label(build_order_mart(self.labelable_tables(), parts=parts))

    def _written(self, name: str, df: DataFrame) -> DataFrame:
        """The rows of ``df``, written; the shuffle files that it took are gone."""
        with short_lived_shuffles(self.spark):
            return read_table(self.spark, write_table(df, run_dir(self.spark, name)))

    def written_parts(self) -> dict[str, DataFrame]:
        """The parts of the mart over the largest tables, each written on its own."""
        tables = self.labelable_tables()
        tables["order_items"] = self._written("kept_items", tables["order_items"].select(*ITEM_INPUTS))
        return {
            "order_items": self._written("items", item_measures(tables)),
            "order_payments": self._written("payments", aggregate_payments(tables["order_payments"])),
        }

    def cuts(self) -> split.SplitCuts:
        """Cut rows of the split, from the two order columns alone."""
        return self._once(
            "cuts",
            lambda: split.find_cuts(
                labelable(self.tables["orders"]).select(PURCHASE_TIME, "order_id"), PURCHASE_TIME, "order_id"
            ),
        )

    def split_table(self) -> DataFrame:
        """Labelled orders with their split, written once.

        The large parts are written before, so that the shuffle files of one
        are gone when the next is made.
        """

        def build() -> DataFrame:
            rows = self.labelled_lazy(self.written_parts()).withColumn("split", split.split_column(self.cuts(), PURCHASE_TIME, "order_id"))
            return write_checked(
                rows, run_dir(self.spark, "split"), "order_id", ("is_late", PURCHASE_TIME), partition_by=("split",)
            )

        return self._once("split_table", build)

    def labelled(self) -> DataFrame:
        return self.split_table().drop("split")

    def part(self, name: str) -> DataFrame:
        """The labelled orders of one part of the split, or of ``all``."""
        if name == "all":
            return self.labelled()
        return self.split_table().filter(F.col("split") == name).drop("split")

    def train(self) -> DataFrame:
        return self.part("train")

    def train_profile(self) -> DataFrame:
        """Training rows with the columns of the profile tables."""
        return profile_features(self.train())

    def quartiles(self, by_class: bool = False) -> DataFrame:
        """Quartiles of the numeric training columns, over all rows or per class, found once for all summaries."""
        by = ["is_late"] if by_class else []

        def build() -> DataFrame:
            return cut_lineage(profile.quartiles(self.train(), profile.NUMERIC_COLUMNS, by))

        return self._once(f"quartiles{by}", build)

    def engineered(self, name: str) -> DataFrame:
        """Model columns, key and label of one part."""
        return select_model_features(engineer_features(self.part(name)), keep=("order_id", "is_late"))

    def preprocessor(self) -> prep.Preprocessor:
        return self._once("preprocessor", lambda: prep.fit(self.engineered("train")))

    def features(self, name: str) -> DataFrame:
        """Feature vectors of one part (lazy)."""
        return prep.transform(self.engineered(name), self.preprocessor(), ["order_id", "is_late"])

    def train_matrix(self) -> DataFrame:
        """Feature vectors of the training part, written once for all fits."""

        def build() -> DataFrame:
            from deliverylens.sources.matrix import write_matrix

            return write_matrix(self.engineered("train"), self.preprocessor(), run_dir(self.spark, "matrix-train"))

        return self._once("train_matrix", build)

    def tuning(self) -> model.TuningResult:
        return self._once(
            "tuning", lambda: model.tune(self.train_matrix(), self.engineered("validation"), self.preprocessor())
        )

    def bundle(self) -> Bundle:
        """Best model of the grid with the threshold chosen on the validation part."""

        def build() -> Bundle:
            best = self.tuning().best
            scored = model.model_scores(self.engineered("validation"), self.preprocessor(), best)
            threshold = metrics.best_threshold(scored, "score", "is_late").first()["threshold"]
            return Bundle(self.preprocessor(), best, threshold, "v1")

        return self._once("bundle", build)

    def scored(self, name: str) -> DataFrame:
        """``order_id, actual_is_late, late_probability, predicted_is_late`` of one part (lazy)."""
        from deliverylens.operators.score import score_rows

        orders = self.part(name).withColumnRenamed("is_late", "actual_is_late")
        return score_rows(orders, self.bundle(), keep=("order_id", "actual_is_late"))

    def results_summary(self) -> DataFrame:
        """Metric rows of baseline, first model and chosen model on validation, and on test."""
        bundle = self.bundle()
        rate = model.prior_rate(self.train())
        first = next(m for m in self.tuning().models if m.c == 1.0 and m.class_weight is None)
        validation, test = self.engineered("validation"), self.engineered("test")
        label = ["is_late"]
        scored = stack(
            [
                validation.select(*label, F.lit("baseline").alias("candidate"), model.prior_score(rate).alias("score")),
                model.candidate_scores(validation, bundle.preprocessor, {"initial_model_validation": first, "final_validation": bundle.model}, label),
                model.candidate_scores(test, bundle.preprocessor, {"final_test": bundle.model}, label),
            ]
        )
        chosen = F.col("candidate").startswith("final")
        threshold = F.when(chosen, F.lit(bundle.threshold)).otherwise(F.lit(0.5))
        return metrics.evaluate(scored, "score", "is_late", threshold, ["candidate"]).withColumnRenamed("candidate", "section")


_RUNS: dict[tuple[str, str], Stages] = {}


def fixture_stages(spark: SparkSession, sf_dir: str) -> Stages:
    """Stages over the generated test tables, shared within one Spark application."""
    run = (spark.sparkContext.applicationId, sf_dir)
    if run not in _RUNS:
        _RUNS[run] = Stages(
            spark, commerce_tables(spark, sf_dir), lambda name: commerce_table(spark, sf_dir, name)
        )
    return _RUNS[run]
