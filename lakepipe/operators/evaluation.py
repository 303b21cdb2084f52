"""Quality of a score against 0/1 labels, computed from the counts per distinct score.

Scores are grouped first (combined on the map side), so a score shared by a third of the rows is
one row of the curve. The curve itself comes from running totals, not from a sort in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakepipe.operators.ordering import running_totals, top_share
from lakepipe.session import checkpoint

TINY = 1e-10


def score_curve(df: DataFrame, score: str, label: str) -> DataFrame:
    """One row per distinct score: rows at it (n, pos), at or above it (cum_n, tp, fp), all (p_all, n_all)."""
    positive = F.count_if(F.col(label) == 1)
    counts = df.groupBy(F.col(score).alias("score")).agg(F.count(F.lit(1)).alias("n"), positive.alias("pos"))
    counts = checkpoint(counts)
    totals = counts.agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).first()
    all_positive = totals["pos"] or 0
    all_negative = (totals["n"] or 0) - all_positive
    curve = running_totals(counts, "score", ["n", "pos"], descending=True)
    # Areas, thresholds and top shares all read the finished curve.
    return checkpoint(
        curve.select(
            "score",
            "n",
            "cum_n",
            "pos",
            F.col("cum_pos").alias("tp"),
            (F.col("cum_n") - F.col("cum_pos")).alias("fp"),
            F.lit(all_positive).cast("bigint").alias("p_all"),
            F.lit(all_negative).cast("bigint").alias("n_all"),
        )
    )


def precision_recall(curve: DataFrame) -> DataFrame:
    """(score, precision, recall) for `score or higher is positive`."""
    precision, recall = _precision_recall()
    return curve.select("score", precision.alias("precision"), recall.alias("recall"))


def _precision_recall() -> tuple[Column, Column]:
    return F.try_divide("tp", F.col("tp") + F.col("fp")), F.try_divide("tp", "p_all")


def _pr_area() -> Column:
    precision, recall = _precision_recall()
    tp_before, fp_before = F.col("tp") - F.col("pos"), F.col("fp") - (F.col("n") - F.col("pos"))
    earlier_precision = F.coalesce(F.try_divide(tp_before, tp_before + fp_before), precision)
    step = recall - F.coalesce(F.try_divide(tp_before, F.col("p_all")), F.lit(0.0))
    return F.sum(step * (precision + earlier_precision) / 2)


def _roc_area() -> Column:
    negatives = F.col("n") - F.col("pos")
    tp_before = F.col("tp") - F.col("pos")
    doubled = negatives.cast("decimal(19,0)") * (tp_before + F.col("tp")).cast("decimal(19,0)")
    pairs = F.max("p_all").cast("double") * F.max("n_all").cast("double")
    return F.try_divide(F.sum(doubled).cast("double"), pairs * 2)


def pr_auc(curve: DataFrame) -> DataFrame:
    """Area under precision over recall by trapezoids; the first point repeats the first precision."""
    return curve.agg(_pr_area().alias("pr_auc"))


def roc_auc(curve: DataFrame) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties counting one half."""
    return curve.agg(_roc_area().alias("roc_auc"))


def curve_areas(curve: DataFrame) -> DataFrame:
    """pr_auc and roc_auc in one pass."""
    return curve.agg(_pr_area().alias("pr_auc"), _roc_area().alias("roc_auc"))


def best_threshold(curve: DataFrame) -> DataFrame:
    """The score with the best F1, the lowest one among equals; no row without positives."""
    precision, recall = _precision_recall()
    f1 = F.lit(2.0) * (precision * recall) / (precision + recall + F.lit(TINY))
    scored = curve.filter("p_all > 0").select(F.col("score").alias("threshold"), f1.alias("best_f1"))
    return scored.orderBy(F.desc("best_f1"), F.asc("threshold")).limit(1)


def threshold_report(df: DataFrame, score: str, label: str, threshold: float = 0.5) -> DataFrame:
    """One pass: tp, fp, fn, tn, precision and recall of `score > threshold`; 0 where undefined."""
    hit, positive = F.col(score) > threshold, F.col(label) == 1
    counts = df.agg(
        F.count_if(hit & positive).alias("tp"),
        F.count_if(hit & ~positive).alias("fp"),
        F.count_if(~hit & positive).alias("fn"),
        F.count_if(~hit & ~positive).alias("tn"),
    )
    return counts.withColumns(
        {
            "precision": F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(0.0)),
            "recall": F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), F.lit(0.0)),
        }
    )


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("count"))


def weighted_precision_recall(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision and recall per label, averaged with the labels' row counts as weights."""
    matrix = confusion_matrix(df, label, prediction)
    n, none = F.col("count"), F.lit(0).cast("bigint")
    right = F.when(F.col(label) == F.col(prediction), n).otherwise(none)

    def cell(cls: str, actual: Column, predicted: Column, hit: Column) -> Column:
        counts = [actual.alias("actual"), predicted.alias("predicted"), hit.alias("hit")]
        return F.struct(F.col(cls).cast("double").alias("cls"), *counts)

    both = F.array(cell(label, n, none, right), cell(prediction, none, n, none))
    cells = matrix.select(F.explode(both).alias("c")).select("c.*")
    classes = cells.groupBy("cls").agg(*[F.sum(c).alias(c) for c in ("actual", "predicted", "hit")])
    weight = F.col("actual")
    precision = F.coalesce(F.try_divide("hit", "predicted"), F.lit(0.0))
    return classes.agg(
        F.try_divide(F.sum(precision * weight), F.sum(weight)).alias("weighted_precision"),
        F.try_divide(F.sum("hit"), F.sum(weight)).alias("weighted_recall"),
    )


def top_capture(
    df: DataFrame, score: str, label: str, key: str, share: float, counts: DataFrame | None = None
) -> DataFrame:
    """Share of all positives found among the int(rows * share) highest scores.

    `counts` is a known score curve of the same rows.
    """
    top = top_share(df.select(key, score, label), score, key, share, counts)
    captured = top.agg(F.count_if(F.col(label) == 1).alias("captured"), F.count(F.lit(1)).alias("top_rows"))
    positives = df.agg(F.count_if(F.col(label) == 1)).scalar()
    return captured.select(
        F.lit(share).alias("share"),
        "top_rows",
        "captured",
        F.coalesce(F.try_divide(F.col("captured"), positives), F.lit(0.0)).alias("capture_rate"),
    )


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
