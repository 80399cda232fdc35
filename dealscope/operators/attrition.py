"""Attrition diagnostics: where losses are observed, computed in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_ratio
from ..schemas import (ATTRITION_INTERPRETATION, ATTRITION_POINT, STAGE_ENGAGING, STAGE_LOST,
                       STAGE_PROSPECTING, STAGE_WON)


def attrition(mart: DataFrame) -> DataFrame:
    """One row: losses, wins, loss rate among closed, unresolved counts and the
    interpretation (whose claim the check on losses' engage dates backs)."""
    stage = F.col("deal_stage")
    base = mart.agg(
        F.count_if(stage == STAGE_LOST).alias("lost_deals"),
        F.count_if(stage == STAGE_WON).alias("won_deals"),
        F.count_if(stage == STAGE_ENGAGING).alias("unresolved_engaging"),
        F.count_if(stage == STAGE_PROSPECTING).alias("unresolved_prospecting"))
    return base.select(
        F.lit(ATTRITION_POINT).alias("observed_attrition_point"),
        "lost_deals", "won_deals",
        safe_ratio(F.col("lost_deals"), F.col("lost_deals") + F.col("won_deals"))
        .alias("loss_rate_among_closed"),
        "unresolved_engaging", "unresolved_prospecting",
        F.lit(ATTRITION_INTERPRETATION).alias("interpretation"))
