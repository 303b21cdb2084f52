"""Decisions taken on a fraud probability."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower limits of the risk buckets, highest first; a score on a limit stays below it.
RISK_LIMITS = ((0.7, "High"), (0.4, "Medium"))
LOWEST_RISK = "Low"


def risk_bucket(score: Column | str) -> Column:
    column = F.col(score) if isinstance(score, str) else score
    (first_limit, first_name), *others = RISK_LIMITS
    decision = F.when(column > first_limit, first_name)
    for limit, name in others:
        decision = decision.when(column > limit, name)
    return decision.otherwise(LOWEST_RISK)


def flag_above(score: Column | str, threshold: float, inclusive: bool = False) -> Column:
    """1 above the threshold, else 0. `inclusive` also flags rows exactly on it."""
    column = F.col(score) if isinstance(score, str) else score
    hit = column >= threshold if inclusive else column > threshold
    return F.when(hit, 1).otherwise(0)


def positive_probability(vector: str = "probability") -> Column:
    """Probability of class 1 out of a model's probability vector."""
    return vector_to_array(F.col(vector))[1]
