"""Seeded, reproducible splits: stratified holdout, stratified folds, temporal.

Row order comes from the first 8 hex digits of md5(id || '-' || seed), which
the SQL oracle can reproduce.  Stratification is exact: each row's rank
within its class is computed with ``rank_within`` (no two-partition window).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import md5_hash32
from ..schemas import CLOSED_STAGES, CV_FOLDS, HOLDOUT_FRACTION, SEED, STAGE_WON
from .ranking import rank_within


def closed_with_target(mart: DataFrame) -> DataFrame:
    """Closed deals with the training target (Won = 1, Lost = 0)."""
    return (mart.filter(F.col("deal_stage").isin(*CLOSED_STAGES))
            .withColumn("target", (F.col("deal_stage") == STAGE_WON).cast("int")))


def _ranked(df: DataFrame, label: str, id_col: str, seed: int) -> DataFrame:
    keyed = df.withColumn("_h", md5_hash32(F.col(id_col), seed))
    return rank_within(keyed, [label], "_h", id_col)


def with_holdout(df: DataFrame, label: str = "target", id_col: str = "opportunity_id",
                 frac: float = HOLDOUT_FRACTION, seed: int = SEED) -> DataFrame:
    """Adds ``split`` = 'test' for the first ceil(frac * n_c) rows of each class
    in hash order, else 'train'."""
    r = _ranked(df, label, id_col, seed)
    quota = F.ceil(F.lit(frac) * F.col("_size"))
    return (r.withColumn("split", F.when(F.col("_rank") < quota, F.lit("test"))
                         .otherwise(F.lit("train")))
            .drop("_h", "_rank", "_size"))


def with_folds(df: DataFrame, label: str = "target", id_col: str = "opportunity_id",
               k: int = CV_FOLDS, seed: int = SEED) -> DataFrame:
    """Adds ``fold`` in 0..k-1: class rank modulo k, so every fold keeps the
    class ratio (sizes differ by at most one per class)."""
    r = _ranked(df, label, id_col, seed)
    return (r.withColumn("fold", (F.col("_rank") % F.lit(k)).cast("int"))
            .drop("_h", "_rank", "_size"))


def quantile_date(df: DataFrame, col: str = "close_date", q: float = 0.75):
    """Date at the q-quantile of a date column (floor of the interpolated day
    number), as a scalar subquery."""
    return df.select(F.date_from_unix_date(
        F.floor(F.percentile(F.unix_date(F.col(col)), q)).cast("int"))).scalar()


def with_temporal(df: DataFrame, cutoff=None, col: str = "close_date") -> DataFrame:
    """Adds ``split``: 'train' before the cut-off, 'test' on or after it; rows
    without a date get no split.  ``cutoff=None`` uses the 75th percentile."""
    cut = quantile_date(df, col) if cutoff is None else F.lit(cutoff).cast("date")
    return df.withColumn("split", F.when(F.col(col) < cut, F.lit("train"))
                         .when(F.col(col) >= cut, F.lit("test")))
