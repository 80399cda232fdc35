"""Roll-ups: cubes with exact distinct counts, mergeable sketch tables, hierarchies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CLOSED_STAGES, STAGE_WON
from ..session import materialize

CUBE_DIMENSIONS = ("regional_office", "product", "sector")
THETA_LOG_ENTRIES = 12          # 4,096 entries: exact up to there, about 1.6 % standard error beyond
HLL_LOG_BUCKETS = 12            # about 1.6 % standard error
KLL_SIZE = 200                  # about 1.3 % rank error


class HierarchyCycleError(ValueError):
    pass


def outcome_cube(mart: DataFrame, dimensions: Sequence[str] = CUBE_DIMENSIONS, distinct: str = "account") -> DataFrame:
    """Closed deals, wins, win rate and distinct accounts for every subset of the dimensions.

    ``level`` is the grouping id: bit i (from the last dimension) is set where a dimension is summed over, which
    tells a total from a NULL value.  Rows are first counted per finest cell and account, so what is
    expanded into the levels is that smaller table.
    """
    fine = (mart.where(F.col("deal_stage").isin(*CLOSED_STAGES)).groupBy(*dimensions, distinct)
            .agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("deal_stage") == STAGE_WON).alias("_won")))
    cells = fine.cube(*dimensions).agg(F.grouping_id().alias("level"), F.sum("_n").alias("deals"), F.sum("_won").alias("won"),
                                       F.count_distinct(distinct).alias("accounts"))
    return cells.select("level", *dimensions, "deals", "won", (F.col("won") / F.col("deals")).alias("win_rate"), "accounts")


# ---------------------------------------------------------------- sketches

def sketch_table(df: DataFrame, keys: Sequence[str], member: str, measure: str) -> DataFrame:
    """One row of sketches per key: distinct members (theta and HLL) and the distribution of a measure (KLL).  Stored as a
    table, its rows merge upwards in any order (:func:`merge_sketches`)."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.theta_sketch_agg(member, THETA_LOG_ENTRIES).alias("members_theta"),
        F.hll_sketch_agg(member, HLL_LOG_BUCKETS).alias("members_hll"),
        F.kll_sketch_agg_double(F.col(measure).cast("double"), KLL_SIZE).alias("measure_kll"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    return sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.theta_union_agg("members_theta", THETA_LOG_ENTRIES).alias("members_theta"),
        F.hll_union_agg("members_hll").alias("members_hll"), F.kll_merge_agg_double("measure_kll", KLL_SIZE).alias("measure_kll"))


def sketch_estimates(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """n, distinct members by either sketch, and quartiles of the measure (NULL where it has no value)."""
    some = F.kll_sketch_get_n_double("measure_kll") > 0
    quartiles = [F.when(some, F.kll_sketch_get_quantile_double("measure_kll", F.lit(q))).alias(name)
                 for q, name in ((0.25, "measure_p25"), (0.5, "measure_p50"), (0.75, "measure_p75"))]
    return sketches.select(*keys, "n", F.theta_sketch_estimate("members_theta").alias("members"),
                           F.hll_sketch_estimate("members_hll").alias("members_hll"), *quartiles)


# ---------------------------------------------------------------- hierarchies

def roots(parents: DataFrame, child: str = "child", parent: str = "parent") -> DataFrame:
    """child, root, depth of every node of a forest by pointer doubling: each round joins the table with itself and
    doubles the reach of every pointer, so a chain of 1,000 takes ten rounds.

    A NULL parent, or one that has no row of its own, is a top: the latter is then the root itself.  Cycles raise
    :class:`HierarchyCycleError`; so does a child with two parents.  Each round is written to the checkpoint folder.
    """
    links = parents.where(F.col(child).isNotNull()).select(F.col(child).alias("child"), F.col(parent).alias("parent"))
    tops = links.where("parent IS NOT NULL").select(F.col("parent").alias("child")).distinct() \
                .join(links.select("child"), "child", "left_anti").withColumn("parent", F.lit(None).cast(links.schema["parent"].dataType))
    nodes = links.unionByName(tops)
    if nodes.groupBy("child").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        raise HierarchyCycleError("a node has more than one parent")
    at = materialize(nodes.select("child", F.coalesce("parent", "child").alias("up"), F.when(F.col("parent").isNull(), 0).otherwise(1).cast("bigint").alias("depth"),
                                  F.col("parent").isNull().alias("done")))
    total, reach = at.count(), 1
    while at.where("NOT done").limit(1).count():
        if reach > total:                       # a path longer than the table has nodes
            raise HierarchyCycleError("the parents form a cycle")
        # Only unfinished pointers are joined: finished ones all point at a few tops.
        above = at.select(F.col("child").alias("_at"), F.col("up").alias("_up"), F.col("depth").alias("_more"), F.col("done").alias("_done"))
        moved = at.where("NOT done").join(above, F.col("up") == F.col("_at")).select(
            "child", F.col("_up").alias("up"), (F.col("depth") + F.col("_more")).alias("depth"), F.col("_done").alias("done"))
        at, reach = materialize(at.where("done").unionByName(moved)), 2 * reach
    return at.select("child", F.col("up").alias("root"), "depth")


def subtree_totals(parents: DataFrame, values: DataFrame, measures: Sequence[str], child: str = "child", parent: str = "parent") -> DataFrame:
    """root, members, deepest and the sums of ``measures`` (of ``values``, keyed by ``child``) over each tree."""
    found = roots(parents, child, parent)
    sums = values.groupBy(F.col(child).alias("child")).agg(*[F.sum(m).alias(m) for m in measures])
    return (found.join(sums, "child", "left").groupBy("root")
            .agg(F.count(F.lit(1)).alias("members"), F.max("depth").alias("deepest"), *[F.sum(m).alias(m) for m in measures]))
