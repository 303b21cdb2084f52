"""Metrics of a score with many ties over the events."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.functions.risk import risk_bucket
from lakepipe.operators import evaluation
from lakepipe.operators.ordering import top_share
from lakepipe.plans.models import threshold_predictions
from lakepipe.queries import views
from lakepipe.queries.views import SCORED_SQL

SCORE, LABEL = "fraud_probability", "fraud_flag"
SHARES = (0.01, 0.05)


def _curve(spark, sf_dir):
    return evaluation.score_curve(views.scored_events(spark, sf_dir), SCORE, LABEL)


def score_curve(spark, sf_dir):
    return _curve(spark, sf_dir).select("score", "tp", "fp")


def precision_recall(spark, sf_dir):
    return evaluation.precision_recall(_curve(spark, sf_dir))


def pr_auc(spark, sf_dir):
    return evaluation.pr_auc(_curve(spark, sf_dir)).select(F.round("pr_auc", 10).alias("pr_auc"))


def roc_auc(spark, sf_dir):
    return evaluation.roc_auc(_curve(spark, sf_dir)).select(F.round("roc_auc", 10).alias("roc_auc"))


def best_threshold(spark, sf_dir):
    return evaluation.best_threshold(_curve(spark, sf_dir))


def confusion_threshold(spark, sf_dir):
    return evaluation.threshold_report(views.scored_events(spark, sf_dir), SCORE, LABEL, 0.5)


def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_matrix(views.scored_events(spark, sf_dir), LABEL, "prediction")


def weighted_prf(spark, sf_dir):
    result = evaluation.weighted_precision_recall(views.scored_events(spark, sf_dir), LABEL, "prediction")
    return result.select(*[F.round(c, 10).alias(c) for c in result.columns])


def topk_capture(spark, sf_dir):
    scored = views.scored_events(spark, sf_dir)
    curve = _curve(spark, sf_dir)
    rows = [evaluation.top_capture(scored, SCORE, LABEL, "transaction_sk", share, curve) for share in SHARES]
    return reduce(DataFrame.unionByName, rows)


def topk_rows(spark, sf_dir):
    return top_share(views.scored_events(spark, sf_dir).drop("prediction"), SCORE, "transaction_sk", 0.05)


def risk_buckets(spark, sf_dir):
    scored = views.scored_events(spark, sf_dir)
    return scored.select("transaction_sk", SCORE, risk_bucket(SCORE).alias("risk_bucket"))


def threshold_flags(spark, sf_dir):
    """Flags at the best threshold: above it, and from it on."""
    scored = views.scored_events(spark, sf_dir)
    best = evaluation.best_threshold(_curve(spark, sf_dir)).first()["threshold"]
    above = threshold_predictions(scored, best)
    from_on = threshold_predictions(scored, best, inclusive=True).select(
        "transaction_sk", F.col("fraud_prediction").alias("fraud_prediction_inclusive")
    )
    return above.join(from_on, "transaction_sk")


QUERIES = {
    "q_score_curve": score_curve,
    "q_precision_recall": precision_recall,
    "q_pr_auc": pr_auc,
    "q_roc_auc": roc_auc,
    "q_best_threshold": best_threshold,
    "q_confusion_threshold": confusion_threshold,
    "q_confusion_matrix": confusion_matrix,
    "q_weighted_prf": weighted_prf,
    "q_topk_capture": topk_capture,
    "q_topk_rows": topk_rows,
    "q_risk_bucket": risk_buckets,
    "q_threshold_predictions": threshold_flags,
}

CURVE_SQL = f"""
    SELECT score, n, pos, CAST(SUM(pos) OVER w AS BIGINT) AS tp, CAST(SUM(n - pos) OVER w AS BIGINT) AS fp,
        SUM(pos) OVER () AS p_all, SUM(n - pos) OVER () AS n_all
    FROM (SELECT fraud_probability AS score, COUNT(*) AS n, SUM(fraud_flag) AS pos FROM ({SCORED_SQL}) GROUP BY 1)
    WINDOW w AS (ORDER BY score DESC)
"""
PR_SQL = f"""
    SELECT score, tp, fp, CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision,
        CAST(tp AS DOUBLE) / CAST(p_all AS DOUBLE) AS recall FROM ({CURVE_SQL})
"""
BEST_SQL = f"""
    SELECT score AS threshold,
        2.0::DOUBLE * (precision * recall) / (precision + recall + 1e-10::DOUBLE) AS best_f1
    FROM ({PR_SQL}) ORDER BY best_f1 DESC, threshold LIMIT 1
"""


def _top_sql(share: float) -> str:
    return f"""
        SELECT * FROM (
            SELECT *, row_number() OVER (ORDER BY fraud_probability DESC, transaction_sk) AS place
            FROM ({SCORED_SQL}))
        WHERE place <= (SELECT floor(COUNT(*) * {share}::DOUBLE) FROM events)
    """


ORACLE = {
    "q_score_curve": f"SELECT score, tp, fp FROM ({CURVE_SQL})",
    "q_precision_recall": f"SELECT score, precision, recall FROM ({PR_SQL})",
    "q_pr_auc": f"""
        SELECT ROUND(SUM((recall - recall0) * (precision + precision0) / 2), 10) AS pr_auc FROM (
            SELECT precision, recall, lag(recall, 1, 0) OVER w AS recall0, lag(precision, 1, precision) OVER w
                AS precision0 FROM ({PR_SQL}) WINDOW w AS (ORDER BY score DESC))
    """,
    "q_roc_auc": f"""
        SELECT ROUND(SUM((n - pos) * (2 * tp - pos)) / (2.0::DOUBLE * MAX(p_all) * MAX(n_all)), 10) AS roc_auc
        FROM ({CURVE_SQL})
    """,
    "q_best_threshold": BEST_SQL,
    "q_confusion_threshold": f"""
        SELECT *, COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fp, 0), 0) AS precision,
            COALESCE(CAST(tp AS DOUBLE) / NULLIF(tp + fn, 0), 0) AS recall
        FROM (SELECT COUNT(*) FILTER (fraud_probability > 0.5 AND fraud_flag = 1) AS tp,
            COUNT(*) FILTER (fraud_probability > 0.5 AND fraud_flag = 0) AS fp,
            COUNT(*) FILTER (fraud_probability <= 0.5 AND fraud_flag = 1) AS fn,
            COUNT(*) FILTER (fraud_probability <= 0.5 AND fraud_flag = 0) AS tn FROM ({SCORED_SQL}))
    """,
    "q_confusion_matrix": f"""
        SELECT fraud_flag, prediction, COUNT(*) AS count FROM ({SCORED_SQL}) GROUP BY fraud_flag, prediction
    """,
    "q_weighted_prf": f"""
        SELECT ROUND(SUM(hit / predicted * actual) / SUM(actual), 10) AS weighted_precision,
            ROUND(SUM(hit) / SUM(actual), 10) AS weighted_recall
        FROM (SELECT c, CAST(COUNT(*) FILTER (fraud_flag = c AND prediction = c) AS DOUBLE) AS hit,
            CAST(COUNT(*) FILTER (prediction = c) AS DOUBLE) AS predicted,
            CAST(COUNT(*) FILTER (fraud_flag = c) AS DOUBLE) AS actual
            FROM ({SCORED_SQL}), (VALUES (0), (1)) AS classes(c) GROUP BY c)
    """,
    "q_topk_capture": " UNION ALL ".join(
        f"""
        SELECT {share}::DOUBLE AS share, COUNT(*) AS top_rows, CAST(SUM(fraud_flag) AS BIGINT) AS captured,
            CAST(SUM(fraud_flag) AS DOUBLE) / (SELECT COUNT(*) FROM events WHERE event_type = 'error') AS capture_rate
        FROM ({_top_sql(share)})
        """
        for share in SHARES
    ),
    "q_topk_rows": f"SELECT transaction_sk, fraud_flag, fraud_probability FROM ({_top_sql(0.05)})",
    "q_risk_bucket": f"""
        SELECT transaction_sk, fraud_probability,
            CASE WHEN fraud_probability > 0.7 THEN 'High' WHEN fraud_probability > 0.4 THEN 'Medium' ELSE 'Low' END
                AS risk_bucket
        FROM ({SCORED_SQL})
    """,
    "q_threshold_predictions": f"""
        SELECT transaction_sk, fraud_probability, fraud_flag,
            CASE WHEN fraud_probability > threshold THEN 1 ELSE 0 END AS fraud_prediction,
            CASE WHEN fraud_probability >= threshold THEN 1 ELSE 0 END AS fraud_prediction_inclusive
        FROM ({SCORED_SQL}), ({BEST_SQL})
    """,
}
