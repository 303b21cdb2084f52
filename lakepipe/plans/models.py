"""Training, tuning and scoring of fraud models with MLlib.

Training tables are expected to be stored tables. They are split first and assembled into vectors
afterwards, so that the split reaches the Parquet scan.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml.classification import (
    GBTClassificationModel,
    GBTClassifier,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.functions.risk import flag_above, positive_probability, risk_bucket
from lakepipe.layout import Layout
from lakepipe.operators.evaluation import (
    best_threshold,
    curve_areas,
    score_curve,
    threshold_report,
    top_capture,
    weighted_precision_recall,
)
from lakepipe.operators.sampling import (
    downsample_majority,
    hash_split,
    stratified_split,
    with_class_weights,
)
from lakepipe.plans.training import ALL_FEATURES, LABEL, fill_missing
from lakepipe.session import scratch_path
from lakepipe.sources.state import record_run, run_values
from lakepipe.sources.writers import overwrite

KEY = "transaction_sk"
SCORE = "fraud_probability"
MARGIN = "margin"
SEED = 42
# Training rows are dealt to parts of about this many rows, at least FIT_PARTS of them.
FIT_ROWS, FIT_PARTS = 250_000, 8


@dataclass(frozen=True)
class TreeSettings:
    """Boosted-tree parameters. Defaults: the final model; `EXPLORATORY_TREES` the earlier ones."""

    # Fixed values.

    max_depth: int = 3
    max_iter: int = 50
    step_size: float = 0.1
    seed: int = SEED


EXPLORATORY_TREES = TreeSettings(max_depth=6, max_iter=100)


def assemble(df: DataFrame, features: Sequence[str] = ALL_FEATURES) -> DataFrame:
    """Fill missing features with 0 and pack them into a vector; rows that stay invalid are skipped."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    return assembler.transform(fill_missing(df, features))


def gradient_boosted_trees(settings: TreeSettings = TreeSettings(), label: str = LABEL) -> GBTClassifier:
    return GBTClassifier(
        featuresCol="features",
        labelCol=label,
        maxDepth=settings.max_depth,
        maxIter=settings.max_iter,
        stepSize=settings.step_size,
        seed=settings.seed,
    )


def logistic_regression(max_iter: int = 100, weight: str | None = "class_weight", label: str = LABEL) -> LogisticRegression:
    estimator = LogisticRegression(featuresCol="features", labelCol=label, maxIter=max_iter)
    return estimator.setWeightCol(weight) if weight else estimator


def fit_order(train: DataFrame, key: str = KEY) -> DataFrame:
    """Training rows in parts and an order that follow from the rows alone.

    MLlib draws from rows by their place, so the parts must not depend on cores, file splits or
    the order in which shuffled blocks arrive.
    """
    parts = max(FIT_PARTS, -(-train.count() // FIT_ROWS))
    return train.repartition(parts, key).sortWithinPartitions(key, *[c for c in train.columns if c != key])


def predict(model, df: DataFrame, path: str | None = None) -> DataFrame:
    """Predictions with the probability of class 1. With `path` they are written once and read
    back, so that several metrics do not score the rows again."""
    scored = model.transform(df).withColumn(SCORE, positive_probability())
    if path is None:
        return scored
    overwrite(scored.select(KEY, LABEL, SCORE, "prediction"), path)
    return scored.sparkSession.read.parquet(path)


def metrics(
    predictions: DataFrame, shares: Sequence[float] = (0.01, 0.05), threshold: float = 0.5
) -> dict[str, float]:
    """PR-AUC, ROC-AUC, precision and recall, their weighted forms, and capture rates of the top shares."""
    curve = score_curve(predictions, SCORE, LABEL)
    result = {
        **curve_areas(curve).first().asDict(),
        **threshold_report(predictions, SCORE, LABEL, threshold).first().asDict(),
        **weighted_precision_recall(predictions, LABEL, "prediction").first().asDict(),
    }
    for share in shares:
        captured = top_capture(predictions, SCORE, LABEL, KEY, share, counts=curve).first()
        result[f"top_{share:g}_capture"] = captured["capture_rate"]
    return result


def feature_importance(model, features: Sequence[str] = ALL_FEATURES) -> dict[str, float]:
    return dict(zip(features, model.featureImportances.toArray().tolist()))


def train_logistic_regression(
    training: DataFrame, predictions_path: str, features: Sequence[str], max_iter: int = 100
):
    """Weighted logistic regression on an 80/20 split: (model, predictions of the hold-out)."""
    train, test = hash_split(with_class_weights(training, LABEL), KEY, 0.8, SEED)
    model = logistic_regression(max_iter).fit(assemble(fit_order(train), features))
    # A fitted model holds its summary, and that the session, which tasks can't have once it has e.g.
    # observed a write; a loaded one holds neither.
    stored = scratch_path(training.sparkSession, "logistic-regression")
    model.write().save(stored)
    scoring = LogisticRegressionModel.load(stored)
    return model, predict(scoring, assemble(test, features), predictions_path)


def train_trees(
    training: DataFrame,
    predictions_path: str,
    features: Sequence[str] = ALL_FEATURES,
    settings: TreeSettings = TreeSettings(),
):
    """Boosted trees on an 80/20 split: (model, predictions of the hold-out)."""
    train, test = hash_split(training, KEY, 0.8, SEED)
    model = gradient_boosted_trees(settings).fit(assemble(fit_order(train), features))
    return model, predict(model, assemble(test, features), predictions_path)


def train_balanced_trees(
    training: DataFrame,
    predictions_path: str,
    features: Sequence[str] = ALL_FEATURES,
    settings: TreeSettings = EXPLORATORY_TREES,
):
    """Boosted trees on a stratified 80% sample with at most three negatives per positive."""
    train, test = stratified_split(training, KEY, LABEL, {0: 0.8, 1: 0.8}, SEED)
    balanced = downsample_majority(train, KEY, LABEL, 3.0, SEED + 1)
    model = gradient_boosted_trees(settings).fit(assemble(fit_order(balanced), features))
    return model, predict(model, assemble(test, features), predictions_path)


def with_margin(model: GBTClassificationModel, df: DataFrame, count: int) -> DataFrame:
    """Add the margin that the first `count` trees of an ensemble give: the weighted sum of what they predict."""
    margin = F.lit(0.0)
    for i, (tree, weight) in enumerate(zip(model.trees[:count], model.treeWeights[:count])):
        df = tree.setPredictionCol(f"_tree{i}").transform(df)
        margin = margin + F.col(f"_tree{i}") * F.lit(weight)
    return df.withColumn(MARGIN, margin).drop(*[f"_tree{i}" for i in range(count)])


def tune_trees(
    training: DataFrame,
    features: Sequence[str] = ALL_FEATURES,
    depths: Sequence[int] = (3, 5, 7),
    iterations: Sequence[int] = (50, 100),
    step_size: float = 0.1,
    parallelism: int = 2,
) -> DataFrame:
    """(max_depth, max_iter, pr_auc, is_best) for every point of the grid on one hold-out.

    Boosting adds trees one by one, so the first trees of the longest ensemble are the shorter one:
    each depth is fitted once.
    """
    train, test = [
        assemble(fit_order(part), features).select("features", LABEL).persist()
        for part in hash_split(training, KEY, 0.8, SEED)
    ]
    estimator = gradient_boosted_trees(TreeSettings(max_iter=max(iterations), step_size=step_size))
    grid = ParamGridBuilder().addGrid(estimator.maxDepth, list(depths)).build()
    evaluator = BinaryClassificationEvaluator(labelCol=LABEL, metricName="areaUnderPR", rawPredictionCol=MARGIN)
    fits = estimator.fitMultiple(train, grid)

    def next_results(_: int) -> list[tuple[int, int, float]]:
        index, model = next(fits)
        depth = grid[index][estimator.maxDepth]
        return [(depth, n, float(evaluator.evaluate(with_margin(model, test, n)))) for n in iterations]

    with ThreadPool(min(parallelism, len(grid))) as pool:
        results = [r for some in pool.map(next_results, range(len(grid)), chunksize=1) for r in some]
    train.unpersist(), test.unpersist()
    best = max(results, key=lambda r: r[2])
    rows = sorted((*r, int(r == best)) for r in results)
    schema = "max_depth int, max_iter int, pr_auc double, is_best int"
    return training.sparkSession.createDataFrame(rows, schema)


def train_final_model(
    training: DataFrame,
    layout: Layout,
    version: str = "v3_gbt_final",
    features: Sequence[str] = ALL_FEATURES,
    settings: TreeSettings = TreeSettings(),
    run_id: str | None = None,
) -> str:
    """Train, evaluate and save the final model; everything about the run goes to the registry.

    Returns the run id. The counts describe the rows the model was fitted on.
    """
    spark = training.sparkSession
    run_id = run_id or f"{version}-{uuid.uuid4().hex[:12]}"
    train, test = hash_split(training, KEY, 0.8, SEED)
    model = gradient_boosted_trees(settings).fit(assemble(fit_order(train), features))
    predictions = predict(model, assemble(test, features), layout.predictions(f"holdout_{version}"))
    model.write().overwrite().save(layout.model(version))

    curve = score_curve(predictions, SCORE, LABEL)
    best = best_threshold(curve).first()
    counts = train.agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(LABEL) == 1).alias("fraud")).first()
    threshold = {"optimal_threshold": best["threshold"], "best_f1_score": best["best_f1"]} if best else {}
    record_run(
        spark,
        layout.run_registry,
        run_id,
        {
            "parameter": {
                "model_type": "GBTClassifier",
                "max_depth": settings.max_depth,
                "max_iter": settings.max_iter,
                "step_size": settings.step_size,
                "seed": settings.seed,
            },
            "metric": curve_areas(curve).first().asDict(),
            "threshold": threshold,
            "feature": {name: i for i, name in enumerate(features)},
            "importance": feature_importance(model, features),
            "metadata": {
                "model_version": version,
                "training_rows": counts["rows"],
                "fraud_rows": counts["fraud"],
                "fraud_ratio": counts["fraud"] / counts["rows"] if counts["rows"] else 0.0,
                "feature_count": len(features),
                "trained_at": dt.datetime.now(dt.timezone.utc),
            },
        },
    )
    return run_id


def settings_of_run(spark: SparkSession, layout: Layout, run_id: str) -> TreeSettings:
    """The tree parameters stored for a run, to train with them again."""
    stored = run_values(spark, layout.run_registry, run_id, "parameter")
    return TreeSettings(
        int(stored["max_depth"]), int(stored["max_iter"]), float(stored["step_size"]), int(stored["seed"])
    )


def load_trees(layout: Layout, version: str = "v3_gbt_final") -> GBTClassificationModel:
    return GBTClassificationModel.load(layout.model(version))


def score_transactions(
    training: DataFrame, model, version: str = "v3_gbt_final", features: Sequence[str] = ALL_FEATURES
) -> DataFrame:
    """Risk score and bucket of every transaction, with its key, the model version and the time."""
    scored = model.transform(assemble(training, features)).withColumn("risk_score", positive_probability())
    return scored.select(
        KEY,
        LABEL,
        "amount",
        "risk_score",
        risk_bucket("risk_score").alias("risk_bucket"),
        F.lit(version).alias("model_version"),
        F.current_timestamp().alias("scoring_timestamp"),
    )


def threshold_predictions(predictions: DataFrame, threshold: float, inclusive: bool = False) -> DataFrame:
    """fraud_prediction 1 above the threshold; `inclusive` also for scores on it, as on the curve
    the threshold was chosen from."""
    flag = flag_above(SCORE, threshold, inclusive).alias("fraud_prediction")
    return predictions.select(KEY, SCORE, flag, LABEL)


