"""Funnel counts and conversion: one aggregation pass, then rows via ``inline``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_ratio
from ..schemas import (CLOSED_STAGES, FUNNEL_COUNT_LABELS, FUNNEL_STEPS, STAGE_ENGAGING,
                       STAGE_LOST, STAGE_PROSPECTING, STAGE_WON)


def stage_counts(mart: DataFrame) -> DataFrame:
    """One row: total, reached (stage <> Prospecting; NULL stage not counted),
    closed, won, lost, engaging, prospecting."""
    stage = F.col("deal_stage")
    return mart.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(stage != STAGE_PROSPECTING).alias("reached"),
        F.count_if(stage.isin(*CLOSED_STAGES)).alias("closed"),
        F.count_if(stage == STAGE_WON).alias("won"),
        F.count_if(stage == STAGE_LOST).alias("lost"),
        F.count_if(stage == STAGE_ENGAGING).alias("engaging"),
        F.count_if(stage == STAGE_PROSPECTING).alias("prospecting"))


def funnel_conversion(mart: DataFrame) -> DataFrame:
    """Four transitions with denominator, numerator and rate (double)."""
    rows = F.array(*[
        F.struct(F.lit(order).alias("stage_order"), F.lit(label).alias("transition"),
                 F.col(den).alias("denominator"), F.col(num).alias("numerator"))
        for order, label, den, num in FUNNEL_STEPS])
    return (stage_counts(mart)
            .select(F.inline(rows))
            .withColumn("conversion_rate", safe_ratio(F.col("numerator"), F.col("denominator")))
            .orderBy("stage_order"))


def funnel_counts(mart: DataFrame) -> DataFrame:
    """Observed progression: all, reached Engaging, closed, won."""
    keys = ("total", "reached", "closed", "won")
    rows = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(label).alias("stage"),
                              F.col(k).alias("deals"))
                     for i, (label, k) in enumerate(zip(FUNNEL_COUNT_LABELS, keys))])
    return stage_counts(mart).select(F.inline(rows)).orderBy("step")
