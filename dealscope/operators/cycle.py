"""Sales-cycle summary (exact interpolated quantiles) and banded distribution."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CYCLE_EDGES, CYCLE_LABELS

QUANTILES = (0.25, 0.5, 0.75, 0.9, 0.95)
TOTAL_LABEL = "All closed"


def quantile_name(q: float) -> str:
    return "median_cycle_days" if q == 0.5 else f"p{round(q * 100)}_cycle_days"


def cycle_summary(mart: DataFrame, by: str = "deal_stage",
                  quantiles: Sequence[float] = QUANTILES, total: bool = False,
                  approx_accuracy: int | None = None) -> DataFrame:
    """Count, mean and quantiles of cycle days per outcome among closed deals.

    All quantiles come from one ``percentile`` aggregate (value -> count maps,
    merged partially map-side).  ``approx_accuracy`` switches to
    ``percentile_approx`` for high-cardinality measures.  ``total=True`` adds
    the all-closed row through ROLLUP.
    """
    closed = mart.filter(F.col("is_closed") == 1)
    qs = list(quantiles)
    if approx_accuracy:
        pct = F.percentile_approx(F.col("cycle_days").cast("double"), qs, approx_accuracy)
    else:
        pct = F.percentile("cycle_days", qs)
    grouped = closed.rollup(by) if total else closed.groupBy(by)
    aggs = [F.count(F.lit(1)).alias("deals"), F.avg("cycle_days").alias("avg_cycle_days"),
            pct.alias("_q")]
    if total:
        aggs.append(F.grouping(by).alias("_g"))
    out = grouped.agg(*aggs)
    outcome = (F.when(F.col("_g") == 1, F.lit(TOTAL_LABEL)).otherwise(F.col(by))
               if total else F.col(by))
    cols = [outcome.alias("outcome"), "deals", "avg_cycle_days"]
    cols += [F.col("_q")[i].alias(quantile_name(q)) for i, q in enumerate(qs)]
    return out.select(*cols).orderBy(F.col("outcome").asc_nulls_last())


def cycle_band(days, edges: Sequence[int] = CYCLE_EDGES, labels: Sequence[str] = CYCLE_LABELS,
               null_band: str | None = None):
    """Fixed-edge band label; NULL days fall into the last band (as ELSE does)
    unless ``null_band`` names one."""
    expr = F.when(days <= edges[0], F.lit(labels[0]))
    for edge, label in zip(edges[1:], labels[1:-1]):
        expr = expr.when(days <= edge, F.lit(label))
    if null_band is not None:
        expr = expr.when(days.isNull(), F.lit(null_band))
    return expr.otherwise(F.lit(labels[-1]))


def cycle_distribution(mart: DataFrame, edges: Sequence[int] = CYCLE_EDGES,
                       labels: Sequence[str] = CYCLE_LABELS,
                       null_band: str | None = None) -> DataFrame:
    closed = mart.filter(F.col("is_closed") == 1)
    return (closed
            .groupBy(cycle_band(F.col("cycle_days"), edges, labels, null_band).alias("cycle_bucket"))
            .agg(F.count(F.lit(1)).alias("deals"), F.avg("won").alias("win_rate"),
                 F.min("cycle_days").alias("_first"))
            .orderBy(F.col("_first").asc_nulls_last())
            .drop("_first"))
