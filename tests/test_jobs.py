"""The whole lake from CSV files to scores."""

import random

import pytest
from pyspark.ml.classification import GBTClassificationModel

from lakepipe.layout import Layout
from lakepipe.plans.bronze import FEATURE_COLUMNS
from lakepipe.plans.jobs import Jobs
from lakepipe.plans.models import TreeSettings, settings_of_run
from lakepipe.plans.training import ALL_FEATURES
from lakepipe.sources.state import read_runs, run_values

SMALL = TreeSettings(max_depth=2, max_iter=2)


def write_sources(folder, day, n, seed):
    draw = random.Random(seed)
    folder.mkdir(parents=True)
    lines = [",".join(["Time", *FEATURE_COLUMNS, "Amount", "Class"])]
    for i in range(n):
        values = [round(draw.gauss(0, 1), 3) for _ in FEATURE_COLUMNS]
        time = float((day - 1) * 86400 + draw.randint(0, 86399))
        lines.append(",".join(map(str, [time, *values, draw.randint(1, 9999) / 100, int(draw.random() < 0.25)])))
        if i % 50 == 0:
            lines.append(lines[-1])
    (folder / "part.csv").write_text("\n".join(lines) + "\n")


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("lake")
    (base / "customers").mkdir()
    people = ["age;emp.var.rate;cons.price.idx;cons.conf.idx;nr.employed;y"]
    people += [f"{20 + i};{i / 10};1.5;2.5;5000;{'yes' if i % 4 == 0 else 'no'}" for i in range(20)]
    (base / "customers" / "part.csv").write_text("\n".join(people) + "\n")

    jobs = Jobs(spark, Layout(str(base / "lake")))
    jobs.ingest_customers(str(base / "customers"), as_of="2024-01-01")
    jobs.silver_customers()
    for day in (1, 2):
        write_sources(base / f"day{day}", day * 10, 300, day)
        jobs.ingest_transactions(str(base / f"day{day}"), as_of=f"2024-01-0{day}")
        assert jobs.silver_transactions().count() == 300
    assert jobs.silver_transactions() is None

    for step in (
        jobs.date_dimension,
        lambda: jobs.customer_dimension("2024-01-01"),
        jobs.fact_transactions,
        jobs.check_fact,
        jobs.daily_mart,
        jobs.monthly_mart,
        jobs.customer_mart,
        jobs.fraud_rate_mart,
        jobs.lifetime_features,
        jobs.recency_features,
        jobs.rolling_features,
        jobs.training_set,
        jobs.training_set_v2,
    ):
        step()
    return jobs


def table(jobs, path):
    return jobs.spark.read.parquet(path)


def test_star_schema(lake):
    fact = table(lake, lake.layout.gold("fact_transactions"))
    assert fact.columns == ["transaction_sk", "customer_sk", "date_sk", "amount", "fraud_flag"]
    assert fact.count() == 600
    customers = table(lake, lake.layout.gold("dim_customer"))
    assert sorted(r["customer_sk"] for r in customers.collect()) == list(range(20))
    assert customers.filter("response_flag = 1").count() == 5


def test_marts_agree(lake):
    daily = table(lake, lake.layout.gold("daily_transaction_summary"))
    monthly = table(lake, lake.layout.gold("monthly_revenue_summary"))
    activity = table(lake, lake.layout.gold("customer_activity_summary"))
    fraud = table(lake, lake.layout.gold("fraud_rate_by_day"))
    assert fraud.columns == ["date_sk", "full_date", "fraud_count", "total_transactions", "fraud_rate"]
    counts = [
        daily.groupBy().sum("total_transactions").first()[0],
        monthly.groupBy().sum("total_transactions").first()[0],
        activity.groupBy().sum("transaction_count").first()[0],
    ]
    assert counts == [600, 600, 600]


def test_direct_training_set_is_the_same(lake, rows):
    joined = rows(table(lake, lake.layout.features("fraud_training_dataset")))
    lake.training_set_direct()
    assert rows(table(lake, lake.layout.features("fraud_training_dataset"))) == joined
    assert len(joined) == 600


def test_rebuilding_the_fact_table_changes_nothing(lake, rows):
    before = rows(table(lake, lake.layout.gold("fact_transactions")))
    lake.fact_transactions()
    assert rows(table(lake, lake.layout.gold("fact_transactions"))) == before


def test_customer_history(lake, spark, rows):
    before = rows(table(lake, lake.layout.gold("dim_customer")))
    lake.update_customer_dimension("2024-06-01")
    assert rows(table(lake, lake.layout.gold("dim_customer"))) == before


def test_models(lake, spark):
    quality = lake.logistic_regression(max_iter=5)
    assert {"pr_auc", "roc_auc", "precision", "recall", "weighted_precision", "top_0.01_capture"} <= set(quality)
    for balanced in (False, True):
        quality, importance = lake.boosted_trees(SMALL, balanced)
        assert 0 <= quality["pr_auc"] <= 1
        assert list(importance) == ALL_FEATURES
    grid = lake.tune(depths=(1, 2), iterations=(1,)).collect()
    assert [r["max_depth"] for r in grid] == [1, 2]
    assert sum(r["is_best"] for r in grid) == 1
    assert max(grid, key=lambda r: r["pr_auc"])["is_best"] == 1


def test_final_model_and_scores(lake, spark):
    run_id = lake.final_model(SMALL)
    assert settings_of_run(spark, lake.layout, run_id) == SMALL
    kinds = {r["kind"] for r in read_runs(spark, lake.layout.run_registry).filter(f"run_id = '{run_id}'").collect()}
    assert kinds == {"parameter", "metric", "threshold", "feature", "importance", "metadata"}
    metadata = run_values(spark, lake.layout.run_registry, run_id, "metadata")
    assert metadata["feature_count"] == 18
    assert 0 < metadata["training_rows"] < 600

    lake.score()
    scores = table(lake, lake.layout.gold("fraud_scoring_v1"))
    assert scores.columns == [
        "transaction_sk",
        "fraud_flag",
        "amount",
        "risk_score",
        "risk_bucket",
        "model_version",
        "scoring_timestamp",
    ]
    assert scores.select("transaction_sk").distinct().count() == 600
    assert isinstance(GBTClassificationModel.load(lake.layout.model("v3_gbt_final")), GBTClassificationModel)

    lake.threshold_predictions(run_id)
    threshold = run_values(spark, lake.layout.run_registry, run_id, "threshold")["optimal_threshold"]
    flagged = table(lake, lake.layout.predictions("fraud_predictions_v3"))
    assert flagged.filter(f"(fraud_probability > {threshold!r}) <> (fraud_prediction = 1)").count() == 0
    assert flagged.count() == 600 - metadata["training_rows"]
