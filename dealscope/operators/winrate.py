"""Win-rate breakdowns over closed deals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import MIN_REP_SUPPORT


def win_rate(mart: DataFrame, keys: Sequence[str | Column], *, min_closed: int = 0,
             extra: Sequence[Column] = (), order: bool = True) -> DataFrame:
    """closed_deals, won_deals, win_rate (+ extra aggregates) per key among
    closed deals; groups below ``min_closed`` are dropped (HAVING).  Partial
    aggregation runs map-side, so a hot key ships one row per task."""
    closed = mart.filter(F.col("is_closed") == 1)
    out = (closed.groupBy(*keys)
           .agg(F.count(F.lit(1)).alias("closed_deals"),
                F.sum("won").cast("bigint").alias("won_deals"),
                F.avg("won").alias("win_rate"),
                *extra))
    if min_closed:
        out = out.filter(F.col("closed_deals") >= min_closed)
    if order:
        names = [k if isinstance(k, str) else None for k in keys]
        tie = [F.col(n).asc_nulls_last() for n in names if n]
        out = out.orderBy(F.col("win_rate").desc_nulls_last(),
                          F.col("closed_deals").desc(), *tie)
    return out


def win_rate_by_rep(mart: DataFrame, min_closed: int = MIN_REP_SUPPORT) -> DataFrame:
    revenue = F.sum(F.when(F.col("won") == 1, F.col("close_value")).otherwise(F.lit(0.0)))
    return win_rate(mart, ["sales_agent", "manager", "regional_office"], min_closed=min_closed,
                    extra=[revenue.alias("won_revenue")])


def win_rate_by_segment(mart: DataFrame) -> DataFrame:
    return win_rate(mart, [F.coalesce(F.col("sector"), F.lit("Unknown")).alias("sector")],
                    extra=[F.avg("sales_price").alias("avg_list_price")])


def win_rate_by_product(mart: DataFrame) -> DataFrame:
    won_value = F.avg(F.when(F.col("won") == 1, F.col("close_value")))
    return win_rate(mart, ["product", "series"],
                    extra=[won_value.alias("avg_won_value")])
