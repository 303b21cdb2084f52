"""Parts of an ensemble against ensembles of that size."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Observation
from pyspark.sql import functions as F

from lakepipe.plans import models
from lakepipe.plans.models import LABEL, MARGIN, TreeSettings


@pytest.fixture(scope="module")
def points(spark):
    noise = F.xxhash64("id") % 1000 / 250
    rows = spark.range(400).select(
        F.col("id").alias("transaction_sk"),
        (F.col("id") % 17).cast("double").alias("a"),
        (F.col("id") % 5).cast("double").alias("b"),
        F.when(F.col("id") % 17 + F.col("id") % 5 + noise > 12, 1).otherwise(0).alias(LABEL),
    )
    return models.assemble(models.fit_order(rows), ["a", "b"]).persist()


@pytest.mark.parametrize("count", [1, 3, 6])
def test_first_trees_are_the_shorter_ensemble(points, count):
    long = models.gradient_boosted_trees(TreeSettings(2, 6)).fit(points)
    short = models.gradient_boosted_trees(TreeSettings(2, count)).fit(points)
    margins = models.with_margin(long, points, count)
    both = short.transform(margins).select(MARGIN, models.positive_probability().alias("p")).collect()
    assert all(abs(1 / (1 + 2.718281828459045 ** (-2 * r[MARGIN])) - r["p"]) < 1e-12 for r in both)
    assert len({r["p"] for r in both}) > 1


def test_grid_is_that_of_single_fits(points, spark):
    rows = points.drop("features")
    grid = {(r["max_depth"], r["max_iter"]): r["pr_auc"] for r in models.tune_trees(rows, ["a", "b"], (1, 2), (2, 4)).collect()}
    train, test = (models.assemble(models.fit_order(p), ["a", "b"]) for p in models.hash_split(rows, models.KEY, 0.8, models.SEED))
    evaluator = BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderPR")
    for (depth, trees), area in grid.items():
        model = models.gradient_boosted_trees(TreeSettings(depth, trees)).fit(train)
        assert evaluator.evaluate(model.transform(test)) == pytest.approx(area, abs=1e-9)
    assert len(grid) == 4


def test_logistic_regression_scores_in_a_session_that_has_observed(points, spark, tmp_path):
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{tmp_path}/seen")
    assert seen.get == {"n": 3}
    _, scored = models.train_logistic_regression(points.drop("features"), f"{tmp_path}/scored", ["a", "b"], 5)
    assert scored.count() == models.hash_split(points, models.KEY)[1].count() > 0
