"""The steps as jobs over one Layout: each reads its input tables and writes its output table."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.layout import Layout
from lakepipe.operators.history import merge_history
from lakepipe.operators.quality import FinerThan, orphans, quality_report, require_clean
from lakepipe.plans import bronze, dimensions, facts, features, marts, models, refresh, silver, training
from lakepipe.sources.readers import read_table
from lakepipe.sources.state import note_batch, run_values
from lakepipe.sources.writers import overwrite


class Jobs:
    """All steps of one lake. A step can be run by itself or repeated."""

    def __init__(self, spark: SparkSession, layout: Layout):
        self.spark, self.layout = spark, layout

    def _gold(self, table: str) -> DataFrame:
        return read_table(self.spark, self.layout.gold(table))

    def _feature(self, table: str) -> DataFrame:
        return read_table(self.spark, self.layout.features(table))

    def ingest_transactions(self, source: str, as_of: str | None = None, batch: str | None = None) -> None:
        """A corrected delivery replaces the first one if it has the same files and day, or the same `batch` and day."""
        target = self.layout.bronze("transactions")
        batch = bronze.ingest_dataset(self.spark, source, target, ",", bronze.TRANSACTION_SOURCE, as_of, batch)
        note_batch(self.spark, self.layout.batches, "transactions", batch, "ingested")

    def ingest_customers(self, source: str, schema: T.StructType | None = None, as_of: str | None = None) -> None:
        bronze.ingest_dataset(self.spark, source, self.layout.bronze("customers"), ";", schema, as_of)

    def silver_customers(self, key: str | None = None) -> None:
        silver.load_customers(self.spark, self.layout, key)

    def silver_transactions(self) -> DataFrame | None:
        return silver.load_transactions(self.spark, self.layout)

    def date_dimension(self, first: str | None = None, last: str | None = None) -> None:
        """The given days, or those from the first to the last transaction."""
        if first and last:
            days = dimensions.date_dimension(self.spark, first, last)
        else:
            transactions = read_table(self.spark, self.layout.silver("transactions"))
            days = dimensions.date_dimension_of(transactions, "transaction_date")
        overwrite(days, self.layout.gold("dim_date"))

    def _customers(self) -> DataFrame:
        """Silver customers with what describes the customer, and nothing about the load."""
        return read_table(self.spark, self.layout.silver("customers")).drop(*bronze.BATCH_COLUMNS)

    def customer_dimension(self, as_of: str | None = None) -> None:
        refresh.note_silver_days(self.spark, self.layout, uuid.uuid4().hex)
        overwrite(dimensions.customer_dimension(self._customers(), as_of), self.layout.gold("dim_customer"))

    def update_customer_dimension(self, as_of: str) -> None:
        """Merge the current Silver customers into the dimension and keep the old versions."""
        before = self._gold("dim_customer")
        merged = merge_history(before, self._customers(), "customer_id", "customer_sk", as_of)
        changed, since = refresh.changed_since(before, merged, as_of)
        if changed:
            refresh.note_silver_days(self.spark, self.layout, uuid.uuid4().hex, since)
        overwrite(merged, self.layout.gold("dim_customer"))

    def fact_transactions(self) -> None:
        transactions = read_table(self.spark, self.layout.silver("transactions"))
        fact = facts.build_fact(transactions, self._gold("dim_customer"), self._gold("dim_date"))
        overwrite(fact, self.layout.gold("fact_transactions"))

    def check_fact(self) -> DataFrame:
        """The quality report of the fact table; raises when a rule is violated.

        Amounts finer than sums keep are reported and do not raise.
        """
        fact = self._gold("fact_transactions")
        report = quality_report(fact, "fact_transactions", (*facts.FACT_RULES, FinerThan("amount")))
        lost = orphans(fact, self._gold("dim_date"), "date_sk").agg(F.count(F.lit(1)).alias("violations"))
        report = report.unionByName(
            lost.select(
                F.lit("fact_transactions").alias("table_name"), F.lit("known(date_sk)").alias("rule"), "violations"
            )
        )
        require_clean(report.filter(F.col("rule") != FinerThan("amount").name))
        return report

    def _mart(self, table: str, build: Callable[[DataFrame, DataFrame], DataFrame], dimension: str) -> None:
        overwrite(build(self._gold("fact_transactions"), self._gold(dimension)), self.layout.gold(table))

    def daily_mart(self) -> None:
        self._mart("daily_transaction_summary", marts.daily_summary, "dim_date")

    def monthly_mart(self) -> None:
        self._mart("monthly_revenue_summary", marts.monthly_summary, "dim_date")

    def customer_mart(self) -> None:
        self._mart("customer_activity_summary", marts.customer_activity, "dim_customer")

    def fraud_rate_mart(self) -> None:
        """Needs the daily mart."""
        daily = self._gold("daily_transaction_summary")
        overwrite(marts.fraud_rate_by_day(daily), self.layout.gold("fraud_rate_by_day"))

    def refresh(self) -> list[dt.date]:
        """Facts of the days that changed since the last refresh, and all marts; returns these days.

        In place of `fact_transactions` and the four mart steps; the facts are in `fact_by_day`.
        """
        return refresh.refresh(self.spark, self.layout)

    def lifetime_features(self) -> None:
        life = features.lifetime(self._gold("fact_transactions"))
        overwrite(life, self.layout.features("customer_lifetime_features"))

    def recency_features(self) -> None:
        recent = features.recency(self._gold("fact_transactions"), self._gold("dim_date"))
        overwrite(recent, self.layout.features("transaction_recency"))

    def rolling_features(self) -> None:
        rolling = features.rolling_7d(self._gold("fact_transactions"), self._gold("dim_date"))
        overwrite(rolling, self.layout.features("transaction_rolling_7d"))

    def training_set(self) -> None:
        joined = training.join_features(
            self._gold("fact_transactions"),
            self._feature("transaction_rolling_7d"),
            self._feature("transaction_recency"),
            self._feature("customer_lifetime_features"),
        )
        overwrite(joined, self.layout.features("fraud_training_dataset"))

    def training_set_direct(self, leak_free: bool = False) -> None:
        """The same table straight from the fact table, without the three feature tables."""
        direct = training.training_set(self._gold("fact_transactions"), self._gold("dim_date"), leak_free)
        overwrite(direct, self.layout.features("fraud_training_dataset"))

    def training_set_v2(self) -> None:
        derived = training.add_derived_features(self._feature("fraud_training_dataset"))
        overwrite(derived, self.layout.features("fraud_training_dataset_v2"))

    def logistic_regression(self, max_iter: int = 100) -> dict[str, float]:
        model, predictions = models.train_logistic_regression(
            self._feature("fraud_training_dataset"),
            self.layout.predictions("holdout_logistic_regression"),
            training.BASE_FEATURES,
            max_iter,
        )
        model.write().overwrite().save(self.layout.model("logistic_regression"))
        return models.metrics(predictions)

    def boosted_trees(self, settings: models.TreeSettings = models.EXPLORATORY_TREES, balanced: bool = False):
        """(metrics of the hold-out, feature importance)."""
        train = models.train_balanced_trees if balanced else models.train_trees
        path = self.layout.predictions("holdout_trees_balanced" if balanced else "holdout_trees")
        model, predictions = train(self._feature("fraud_training_dataset_v2"), path, settings=settings)
        return models.metrics(predictions), models.feature_importance(model)

    def tune(self, **grid) -> DataFrame:
        return models.tune_trees(self._feature("fraud_training_dataset_v2"), **grid)

    def final_model(self, settings: models.TreeSettings = models.TreeSettings()) -> str:
        return models.train_final_model(self._feature("fraud_training_dataset_v2"), self.layout, settings=settings)

    def score(self) -> None:
        scored = models.score_transactions(
            self._feature("fraud_training_dataset_v2"), models.load_trees(self.layout)
        )
        overwrite(scored, self.layout.gold("fraud_scoring_v1"))

    def threshold_predictions(self, run_id: str) -> None:
        """Hold-out predictions cut at the threshold the run found best."""
        threshold = run_values(self.spark, self.layout.run_registry, run_id, "threshold")
        version = run_values(self.spark, self.layout.run_registry, run_id, "metadata")["model_version"]
        predictions = read_table(self.spark, self.layout.predictions(f"holdout_{version}"))
        flagged = models.threshold_predictions(predictions, threshold["optimal_threshold"])
        overwrite(flagged, self.layout.predictions("fraud_predictions_v3"))
