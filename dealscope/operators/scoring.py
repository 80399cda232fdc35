"""Open-deal scoring: propensity + stall signal -> risk score, summary, order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import clip, md5_hash32
from ..functions.text import deal_summary
from ..schemas import (OPEN_STAGES, RISK_PROPENSITY_WEIGHT, RISK_RATIO_CAP, RISK_STALL_WEIGHT,
                       SCORE_COLUMNS, SEED)
from .stall import attach_stall


def open_deals(mart: DataFrame) -> DataFrame:
    return mart.filter(F.col("deal_stage").isin(*OPEN_STAGES))


def standin_propensity(key: Column, seed: int = SEED) -> Column:
    """Deterministic stand-in score in [0, 0.999]: md5 bucket / 1000.  Used where a
    query must be checkable without a fitted model."""
    return (md5_hash32(key, seed) % F.lit(1000)) / F.lit(1000.0)


def risk_score(propensity: Column, ratio: Column) -> Column:
    """0.65 * (1 - p) + 0.35 * clip(ratio, 0, 4) / 4; a missing ratio counts as 0."""
    stall_part = clip(F.coalesce(ratio, F.lit(0.0)), 0.0, RISK_RATIO_CAP) / F.lit(RISK_RATIO_CAP)
    return ((F.lit(1.0) - propensity) * F.lit(RISK_PROPENSITY_WEIGHT)
            + stall_part * F.lit(RISK_STALL_WEIGHT))


def score_open(scored: DataFrame, mart: DataFrame) -> DataFrame:
    """``scored``: open deals (mart columns) with ``propensity_to_close``.
    Returns the 15-column score table (unordered; see ``rank_by_risk``)."""
    with_stall = attach_stall(scored, mart)
    out = (with_stall
           .withColumn("risk_score", risk_score(F.col("propensity_to_close"), F.col("stall_ratio")))
           .withColumn("deal_summary", deal_summary(
               F.col("sales_agent"), F.col("product"), F.col("propensity_to_close"),
               F.col("days_in_stage"), F.col("historical_stage_norm_days"), F.col("stall_ratio"))))
    return out.select(*SCORE_COLUMNS)


def score_open_standin(mart: DataFrame, seed: int = SEED) -> DataFrame:
    deals = open_deals(mart).withColumn(
        "propensity_to_close", standin_propensity(F.col("opportunity_id"), seed))
    return score_open(deals, mart)


def risk_order() -> list[Column]:
    """Stalled first, then highest risk; id breaks ties deterministically."""
    return [F.col("stalled").desc(), F.col("risk_score").desc(), F.col("opportunity_id").asc()]


def top_risk(scores: DataFrame, n: int = 100) -> DataFrame:
    """Top-N by risk: ``orderBy().limit()`` plans as TakeOrderedAndProject
    (per-partition top-N, then a merge of N rows per partition)."""
    return scores.orderBy(*risk_order()).limit(n)
