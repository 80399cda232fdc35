"""Segment norms and the stalled-deal operator (strict and fallback variants)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_ratio
from ..schemas import STAGE_ENGAGING, STALL_QUANTILE, STALL_THRESHOLD

SEGMENT_KEYS = ("product", "regional_office")
NORM = "historical_stage_norm_days"
STALLED_COLUMNS = ("opportunity_id", "sales_agent", "manager", "regional_office", "product",
                   "account", "engage_date", "days_in_stage")


def closed_cycles(mart: DataFrame) -> DataFrame:
    return mart.filter((F.col("is_closed") == 1) & F.col("cycle_days").isNotNull())


def segment_norms(mart: DataFrame, keys=SEGMENT_KEYS, quantile: float = STALL_QUANTILE) -> DataFrame:
    """Exact interpolated quantile of closed-deal cycle days per segment.

    NULL keys form their own group.  ``percentile`` aggregates value -> count
    maps partially on each map task; day counts have few distinct values, so a
    hot segment stays cheap to shuffle.
    """
    return (closed_cycles(mart)
            .groupBy(*keys)
            .agg(F.percentile("cycle_days", quantile).alias(NORM)))


def overall_norm(mart: DataFrame, quantile: float = STALL_QUANTILE):
    """Quantile over all closed deals with a known cycle, as a scalar subquery."""
    return closed_cycles(mart).select(F.percentile("cycle_days", quantile)).scalar()


def stalled_deals(mart: DataFrame, *, threshold: float = STALL_THRESHOLD,
                  quantile: float = STALL_QUANTILE, fallback: str | None = None,
                  keys=SEGMENT_KEYS) -> DataFrame:
    """Engaging deals with their segment norm, age ratio and stall flag.

    ``fallback=None`` (strict): NULL segment keys never match, a missing or
    zero norm leaves ratio and flag NULL.  ``fallback="overall"``: keys match
    null-safely, a missing norm takes the overall quantile, and an unknown
    flag is false.  The norms table has one row per segment; adaptive execution
    broadcasts it if its measured bytes are few.
    """
    engaging = mart.filter(F.col("deal_stage") == STAGE_ENGAGING).select(*STALLED_COLUMNS)
    norms = segment_norms(mart, keys, quantile)
    if fallback is None:
        scored = engaging.join(norms, list(keys), "left")
        norm = F.col(NORM)
    elif fallback == "overall":
        n = norms.select(*[F.col(k).alias(f"_n_{k}") for k in keys], F.col(NORM).alias("_norm"))
        cond = None
        for k in keys:
            c = engaging[k].eqNullSafe(n[f"_n_{k}"])
            cond = c if cond is None else cond & c
        scored = engaging.join(n, cond, "left").drop(*[f"_n_{k}" for k in keys])
        norm = F.coalesce(F.col("_norm"), overall_norm(mart, quantile))
    else:
        raise ValueError(f"unknown fallback {fallback!r}")
    ratio = safe_ratio(F.col("days_in_stage"), F.col(NORM))
    flag = ratio >= F.lit(threshold)
    if fallback is not None:
        flag = F.coalesce(flag, F.lit(False))
    return (scored
            .withColumn(NORM, norm)
            .select(*STALLED_COLUMNS, NORM)
            .withColumn("stall_ratio", ratio)
            .withColumn("stalled", flag))


def worst_first(stalled: DataFrame) -> DataFrame:
    """The derived table's order: highest ratio first, unknown ratios last, then by id."""
    return stalled.orderBy(F.col("stall_ratio").desc_nulls_last(), F.col("opportunity_id"))


def attach_stall(deals: DataFrame, mart: DataFrame, *, threshold: float = STALL_THRESHOLD,
                 quantile: float = STALL_QUANTILE, keys=SEGMENT_KEYS) -> DataFrame:
    """Add norm, ratio and flag (fallback semantics) to any set of deals in one
    pass: Engaging rows get their segment norm (overall quantile when the
    segment has none), other stages keep NULL norm and ratio and a false flag.
    This replaces a join of the deals with the stalled-deal table on id."""
    norms = segment_norms(mart, keys, quantile)
    n = norms.select(*[F.col(k).alias(f"_n_{k}") for k in keys], F.col(NORM).alias("_norm"))
    cond = None
    for k in keys:
        c = deals[k].eqNullSafe(n[f"_n_{k}"])
        cond = c if cond is None else cond & c
    engaging = F.col("deal_stage") == STAGE_ENGAGING
    norm = F.when(engaging, F.coalesce(F.col("_norm"), overall_norm(mart, quantile)))
    ratio = safe_ratio(F.col("days_in_stage"), F.col(NORM))
    return (deals.join(n, cond, "left")
            .drop(*[f"_n_{k}" for k in keys])
            .withColumn(NORM, norm)
            .drop("_norm")
            .withColumn("stall_ratio", F.when(engaging, ratio))
            .withColumn("stalled", F.coalesce(F.col("stall_ratio") >= F.lit(threshold),
                                              F.lit(False))))


def stalled_count(stalled: DataFrame) -> DataFrame:
    return stalled.agg(F.count_if(F.col("stalled")).alias("flagged"))
