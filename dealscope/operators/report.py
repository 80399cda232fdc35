"""Read-side operators: findings report, portfolio metrics, filters, lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import display_or_dash, fixed, percent, thousands
from ..schemas import OPEN_STAGES, STAGE_ENGAGING, STALL_RULE_TEXT
from .attrition import attrition
from .funnel import funnel_conversion, stage_counts
from .scoring import risk_order
from .stall import stalled_count, stalled_deals


def key_findings(mart: DataFrame) -> DataFrame:
    """Funnel rates, the attrition point and the stalled count as text rows
    (finding, value, detail) in report order."""
    funnel = funnel_conversion(mart).select(
        F.col("stage_order").alias("_pos"),
        F.col("transition").alias("finding"),
        percent(F.col("conversion_rate"), 1).alias("value"),
        F.concat(thousands(F.col("numerator")), F.lit(" of "), thousands(F.col("denominator")),
                 F.lit(" opportunities")).alias("detail"))
    attr = attrition(mart).select(
        F.lit(5).alias("_pos"), F.lit("Observed attrition point").alias("finding"),
        F.col("observed_attrition_point").alias("value"),
        F.concat(thousands(F.col("lost_deals")), F.lit(" recorded losses")).alias("detail"))
    stalled = stalled_count(stalled_deals(mart)).select(
        F.lit(6).alias("_pos"), F.lit("Stalled engaging deals").alias("finding"),
        thousands(F.col("flagged")).alias("value"), F.lit(STALL_RULE_TEXT).alias("detail"))
    return funnel.unionByName(attr).unionByName(stalled).orderBy("_pos").drop("_pos")


def portfolio_metrics(mart: DataFrame, scores: DataFrame) -> DataFrame:
    """One row of headline counts; the score counts arrive as one scalar
    subquery (a struct), so no join is needed."""
    s = scores.select(F.struct(
        F.count(F.lit(1)).alias("open_deals"),
        F.count_if(F.col("deal_stage") == STAGE_ENGAGING).alias("open_engaging_deals"),
        F.count_if(F.col("stalled")).alias("stalled_deals"))).scalar()
    return stage_counts(mart).select(
        F.col("total").alias("records_total"), F.col("closed").alias("records_closed"),
        F.col("won").alias("wins"), F.col("lost").alias("losses"),
        F.try_divide(F.col("won").cast("double"), F.col("closed")).alias("closed_win_rate"),
        s["open_deals"].alias("open_deals"),
        s["open_engaging_deals"].alias("open_engaging_deals"),
        s["stalled_deals"].alias("stalled_deals"))


def options(scores: DataFrame, column: str = "regional_office") -> DataFrame:
    """Distinct non-null values, sorted (filter choices)."""
    return (scores.select(column).where(F.col(column).isNotNull()).distinct()
            .orderBy(column))


def prioritized(scores: DataFrame, regions: Sequence[str] | None = None,
                stages: Sequence[str] = OPEN_STAGES, stalled_only: bool = False,
                n: int = 25) -> DataFrame:
    """Filtered risk table: region and stage membership, optional stalled-only,
    top ``n`` (10..100) by the risk order."""
    if not 10 <= n <= 100:
        raise ValueError("n must be within 10..100")
    df = scores
    if regions is not None:
        df = df.filter(F.col("regional_office").isin(*regions))
    df = df.filter(F.col("deal_stage").isin(*stages))
    if stalled_only:
        df = df.filter(F.col("stalled"))
    return (df.orderBy(*risk_order()).limit(n)
            .select("opportunity_id", "sales_agent", "regional_office", "product", "deal_stage",
                    "propensity_to_close", "days_in_stage", "stall_ratio", "stalled",
                    "risk_score"))


def deal(scores: DataFrame, opportunity_id=None) -> DataFrame:
    """Display row for one deal.  Without an id, the highest-risk candidate (id as
    tie-break): the top-1 row of one pass over the scores."""
    if opportunity_id is None:
        found = scores.orderBy(F.col("risk_score").desc(), F.col("opportunity_id")).limit(1)
    else:
        found = scores.filter(F.col("opportunity_id") == F.lit(str(opportunity_id)))
    return (found
            .select("opportunity_id",
                    percent(F.col("propensity_to_close"), 1).alias("propensity_display"),
                    display_or_dash(F.col("days_in_stage").cast("string")).alias("days_display"),
                    display_or_dash(F.concat(fixed(F.col("stall_ratio"), 2), F.lit("×")))
                    .alias("ratio_display"),
                    "deal_summary"))
