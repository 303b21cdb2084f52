import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lakepipe.operators import sampling
from lakepipe.operators.dedup import keep_first, not_yet_loaded
from lakepipe.operators.evaluation import (
    best_threshold,
    curve_areas,
    pr_auc,
    roc_auc,
    score_curve,
    threshold_report,
    top_capture,
    weighted_precision_recall,
)


def scored(spark, data):
    rows = [(i, float(s), int(label)) for i, (s, label) in enumerate(data)]
    return spark.createDataFrame(rows, "k bigint, s double, y int").repartition(4)


def random_scores(n=400):
    """A third of the rows share one score."""
    draw = random.Random(5)
    return [(0.5 if i % 3 == 0 else round(draw.random(), 2), draw.random() < 0.3) for i in range(n)]


def test_areas_equal_the_mllib_evaluator(spark):
    df = scored(spark, random_scores())
    areas = curve_areas(score_curve(df, "s", "y")).first()
    raw = df.withColumn("raw", array_to_vector(F.array(-F.col("s"), F.col("s"))))
    for name, metric in (("pr_auc", "areaUnderPR"), ("roc_auc", "areaUnderROC")):
        evaluator = BinaryClassificationEvaluator(
            rawPredictionCol="raw", labelCol="y", metricName=metric, numBins=0
        )
        assert areas[name] == pytest.approx(evaluator.evaluate(raw), abs=1e-12)


def test_weighted_metrics_equal_the_mllib_evaluator(spark):
    df = scored(spark, random_scores()).withColumn("p", (F.col("s") > 0.5).cast("double"))
    got = weighted_precision_recall(df, "y", "p").first()
    for name, metric in (("weighted_precision", "weightedPrecision"), ("weighted_recall", "weightedRecall")):
        evaluator = MulticlassClassificationEvaluator(labelCol="y", predictionCol="p", metricName=metric)
        assert got[name] == pytest.approx(evaluator.evaluate(df), abs=1e-12)


def test_best_threshold_by_trying_all(spark):
    data = random_scores()
    got = best_threshold(score_curve(scored(spark, data), "s", "y")).first()

    def f1(t):
        hits = [y for s, y in data if s >= t]
        precision, recall = sum(hits) / len(hits), sum(hits) / sum(y for _, y in data)
        return 2 * precision * recall / (precision + recall + 1e-10)

    best = max(f1(s) for s, _ in data)
    assert got["best_f1"] == pytest.approx(best)
    assert got["threshold"] == min(s for s, _ in data if f1(s) == pytest.approx(best, abs=1e-15))


def test_lowest_of_equally_good_thresholds(spark):
    # Precision 1, recall 1/2 and precision 1/2, recall 1/2 + ... chosen so that 0.9 and 0.2 tie.
    data = [(0.9, 1), (0.5, 0), (0.2, 1), (0.2, 0), (0.2, 0), (0.1, 0)]
    curve = score_curve(scored(spark, [(0.9, 1), (0.8, 0), (0.8, 1), (0.8, 0)]), "s", "y")
    assert best_threshold(curve).first()["threshold"] == 0.8
    assert best_threshold(score_curve(scored(spark, data), "s", "y")).count() == 1


def test_no_positives(spark):
    df = scored(spark, [(0.1, 0), (0.9, 0)])
    curve = score_curve(df, "s", "y")
    assert best_threshold(curve).count() == 0
    assert roc_auc(curve).first()[0] is None
    assert tuple(threshold_report(df, "s", "y").first())[-2:] == (0.0, 0.0)
    assert top_capture(df, "s", "y", "k", 0.5).first()["capture_rate"] == 0.0


def test_only_positives(spark):
    curve = score_curve(scored(spark, [(0.1, 1), (0.9, 1)]), "s", "y")
    assert pr_auc(curve).first()[0] == 1.0
    assert roc_auc(curve).first()[0] is None


def test_all_scores_tied(spark):
    areas = curve_areas(score_curve(scored(spark, [(0.5, 1), (0.5, 0), (0.5, 0), (0.5, 0)]), "s", "y")).first()
    assert (areas["pr_auc"], areas["roc_auc"]) == (0.25, 0.5)


def test_score_on_the_threshold_is_negative(spark):
    got = threshold_report(scored(spark, [(0.5, 1), (0.51, 1), (0.5, 0)]), "s", "y", 0.5).first()
    assert (got["tp"], got["fp"], got["fn"], got["tn"]) == (1, 0, 1, 1)


def test_top_share_of_less_than_one_row(spark):
    got = top_capture(scored(spark, random_scores(60)), "s", "y", "k", 0.01).first()
    assert (got["top_rows"], got["capture_rate"]) == (0, 0.0)


@pytest.fixture
def labelled(spark):
    return spark.range(3000).select(
        F.col("id").alias("k"), (F.col("id") % 10 == 0).cast("int").alias("y"), F.lit(1.5).alias("a")
    )


def test_split_is_disjoint_complete_and_stable(labelled, rows):
    train, test = sampling.hash_split(labelled, "k", 0.8)
    assert train.join(test, "k").count() == 0
    assert train.count() + test.count() == 3000
    assert 0.77 < train.count() / 3000 < 0.83
    again, _ = sampling.hash_split(labelled.repartition(7), "k", 0.8)
    assert rows(train) == rows(again)
    other_seed, _ = sampling.hash_split(labelled, "k", 0.8, seed=1)
    assert rows(train) != rows(other_seed)


def test_holdout_keeps_repeated_rows_where_set_difference_does_not(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "k int, v string")
    train = df.filter("k = 1")
    assert sampling.holdout(df, train, "k").count() == 2
    assert sampling.except_rows(df, train).count() == 1


def test_stratified_sample(labelled):
    counts = dict(
        sampling.stratified_sample(labelled, "k", "y", {0: 0.5, 1: 1.0}).groupBy("y").count().collect()
    )
    assert counts[1] == 300
    assert 0.45 < counts[0] / 2700 < 0.55
    assert sampling.stratified_sample(labelled, "k", "y", {1: 1.0}).filter("y = 0").count() == 0


def test_downsampling(labelled):
    counts = dict(sampling.downsample_majority(labelled, "k", "y", 3.0).groupBy("y").count().collect())
    assert counts[1] == 300
    assert 750 < counts[0] < 1050
    assert sampling.downsample_majority(labelled, "k", "y", 50.0).count() == 3000
    assert sampling.downsample_majority(labelled.filter("y = 1"), "k", "y").count() == 300


def test_class_weights(labelled):
    weighted = sampling.with_class_weights(labelled, "y")
    assert weighted.agg(F.sum("class_weight")).first()[0] == pytest.approx(3000)
    assert dict(sampling.class_weights(labelled, "y").collect()) == {0: 3000 / 5400, 1: 5.0}


def test_keep_first(spark, plan_text):
    data = [(1, "b", 2), (1, "a", 1), (1, "a", 3), (None, "c", 1), (None, "b", 9)]
    df = spark.createDataFrame(data, "k int, o string, v int")
    first = keep_first(df, ["k"], ["o", "v"])
    assert sorted(map(repr, map(tuple, first.collect()))) == ["(1, 'a', 1)", "(None, 'b', 9)"]
    # Limited per key on both sides of the shuffle.
    assert plan_text(keep_first(df, ["k"], ["o", "v"])).count("WindowGroupLimit") == 2


def test_not_yet_loaded(spark):
    df, target = spark.range(5), spark.range(3)
    assert sorted(r[0] for r in not_yet_loaded(df, target, "id").collect()) == [3, 4]
