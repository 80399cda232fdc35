"""Warehouse build: sources -> mart -> the derived tables, in a fixed order.

The mart is checkpointed once (a reliable copy in the shared checkpoint
folder), so each analysis reads it instead of re-running the source joins and
an executor loss never sends the work back to the raw scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import attrition, cycle, funnel, stall, winrate
from ..operators.mart import build_mart
from ..session import materialize
from ..sources.sinks import write_table

# Step order of the derived tables (fixed).
ANALYSES = (
    ("funnel_conversion", funnel.funnel_conversion),
    ("win_rate_by_rep", winrate.win_rate_by_rep),
    ("win_rate_by_segment", winrate.win_rate_by_segment),
    ("win_rate_by_product", winrate.win_rate_by_product),
    ("sales_cycle_summary", cycle.cycle_summary),
    ("sales_cycle_distribution", cycle.cycle_distribution),
    ("attrition_diagnostics", attrition.attrition),
    ("stalled_deals", lambda mart: stall.worst_first(stall.stalled_deals(mart))),
)


def mart_from_sources(sources: dict[str, DataFrame], **kw) -> DataFrame:
    return build_mart(sources["sales_pipeline"], sources["sales_teams"], sources["products"],
                      sources["accounts"], **kw)


def run_analyses(mart: DataFrame) -> dict[str, DataFrame]:
    return {"mart_opportunities": mart, **{name: op(mart) for name, op in ANALYSES}}


def build_warehouse(spark: SparkSession, sources: dict[str, DataFrame], out_dir: str,
                    fmt: str = "parquet", **mart_kw) -> dict[str, DataFrame]:
    """Full refresh of every derived table under ``out_dir``; returns the
    written tables (read back) keyed by name."""
    mart = materialize(mart_from_sources(sources, **mart_kw))
    base = out_dir.rstrip("/")
    written = {}
    for name, df in run_analyses(mart).items():
        write_table(df, f"{base}/{name}", fmt=fmt)
        written[name] = spark.read.format(fmt).load(f"{base}/{name}")
    return written
