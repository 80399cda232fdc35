"""Binary-classification metrics as aggregations (one-row DataFrames).

Scores are first grouped by distinct value (a hot score costs one row), so
ties are handled exactly: ROC-AUC counts tied pairs as half, average
precision steps over distinct thresholds without interpolation.  All four metrics
come from one such table with its running sums.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import DECISION_THRESHOLD
from .ranking import running_sums


def by_score(df: DataFrame, label: str, score: str, parts: Sequence[str] = ()) -> DataFrame:
    """score, pos, neg: labels counted per distinct score (and part); rows without either are left out."""
    y = F.col(label).cast("int")
    return (df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
            .groupBy(*parts, F.col(score).cast("double").alias("_s"))
            .agg(F.sum(y).cast("double").alias("pos"),
                 F.sum(F.lit(1) - y).cast("double").alias("neg")))


def curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """The by-score table with running sums from the highest score down."""
    return running_sums(by_score(df, label, score), "_s", ["pos", "neg"], descending=True)


def _auc() -> Column:
    # Each positive beats the negatives below its score and half of those at it.
    above = F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") / F.lit(2.0)))
    pairs = F.sum("pos") * F.sum("neg")
    return F.try_divide(pairs - above, pairs)


def _average_precision() -> Column:
    precision = F.try_divide(F.col("cum_pos"), F.col("cum_pos") + F.col("cum_neg"))
    return F.try_divide(F.sum(F.col("pos") * precision), F.sum("pos"))


def _accuracy(threshold: float) -> Column:
    right = F.sum(F.when(F.col("_s") >= F.lit(threshold), F.col("pos")).otherwise(F.col("neg")))
    return F.try_divide(right, F.sum("pos") + F.sum("neg"))


def _brier() -> Column:
    miss = F.col("pos") * (F.col("_s") - 1) * (F.col("_s") - 1) + F.col("neg") * F.col("_s") * F.col("_s")
    return F.try_divide(F.sum(miss), F.sum("pos") + F.sum("neg"))


def auc(df: DataFrame, label: str = "target", score: str = "score") -> DataFrame:
    """ROC-AUC; NULL when a class is absent."""
    return curve(df, label, score).agg(_auc().alias("auc"))


def auc_by(df: DataFrame, parts: Sequence[str], label: str = "target", score: str = "score") -> DataFrame:
    """ROC-AUC of each part that has scored rows: all parts share one table of scores."""
    found = running_sums(by_score(df, label, score, parts), "_s", ["pos", "neg"], descending=True, parts=parts)
    return found.groupBy(*parts).agg(_auc().alias("auc"))


def average_precision(df: DataFrame, label: str = "target", score: str = "score") -> DataFrame:
    """AP = sum over distinct thresholds (descending) of recall step x precision."""
    return curve(df, label, score).agg(_average_precision().alias("average_precision"))


def accuracy_brier(df: DataFrame, label: str = "target", score: str = "score",
                   threshold: float = DECISION_THRESHOLD) -> DataFrame:
    return by_score(df, label, score).agg(_accuracy(threshold).alias("accuracy"), _brier().alias("brier"))


def all_metrics(df: DataFrame, label: str = "target", score: str = "score",
                threshold: float = DECISION_THRESHOLD) -> DataFrame:
    """auc, average_precision, accuracy, brier from one scan of the scored rows."""
    return curve(df, label, score).agg(
        _auc().alias("auc"), _average_precision().alias("average_precision"),
        _accuracy(threshold).alias("accuracy"), _brier().alias("brier"))
