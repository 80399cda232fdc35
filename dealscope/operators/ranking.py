"""Distributed ranks, running sums and exact quantiles without a single-partition window.

All follow one plan whatever the input size: deal the ordering key into ranges, count or
sum per range (a small table), turn that into offsets with a window over the small table,
and finish with a window partitioned by range.  No task holds more than one range.  The
number of ranges follows ``spark.sql.shuffle.partitions``, as that of any other shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_SO_FAR = (Window.unboundedPreceding, Window.currentRow)


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner equi-join on ``keys`` in which NULL equals NULL; keeps the left keys."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = reduce(lambda x, y: x & y, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(renamed, cond).drop(*[f"_r_{k}" for k in keys])


def rank_within(df: DataFrame, part_cols: Sequence[str], hash_col: str, tie_col: str,
                bits: int | None = None, rank_col: str = "_rank", size_col: str = "_size") -> DataFrame:
    """Exact 0-based rank of each row within ``part_cols`` ordered by
    (``hash_col``, ``tie_col``), plus the group size.

    ``hash_col`` must be a uniform integer in [0, 2**32) (an md5 prefix), so its
    top ``bits`` bits give balanced ranges; by default there are at least eight
    ranges per shuffle partition.  Rows whose hash or class is NULL are kept: a
    NULL hash ranks first in its class, a NULL class is a class of its own.
    """
    parts = list(part_cols)
    if bits is None:
        bits = min(32, max(8, math.ceil(math.log2(8 * _partitions(df)))))
    rng = F.coalesce(F.call_function("shiftright", F.col(hash_col), F.lit(32 - bits)), F.lit(-1))
    withr = df.withColumn("_rng", rng)
    counts = withr.groupBy(*parts, "_rng").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(*parts).orderBy("_rng")
    offsets = (counts
               .withColumn("_off", F.sum("_cnt").over(w) - F.col("_cnt"))
               .withColumn(size_col, F.sum("_cnt").over(Window.partitionBy(*parts)))
               .drop("_cnt"))
    joined = _null_safe_join(withr, offsets, [*parts, "_rng"])
    w2 = Window.partitionBy(*parts, "_rng").orderBy(hash_col, tie_col)
    return (joined
            .withColumn(rank_col, F.col("_off") + F.row_number().over(w2) - F.lit(1))
            .drop("_rng", "_off"))


def _running(df: DataFrame, part_cols: Sequence[str], key: Column, value_cols: Sequence[str],
             ranges: int | None) -> DataFrame:
    """``cum_<v>`` within ``part_cols`` in order of ``key`` (distinct within a part).

    Rows are range-partitioned by (parts, key); the dealt rows are materialised once,
    so that the totals and the sums see the same ranges even if a task is repeated.
    """
    parts = list(part_cols)
    keyed = df.withColumn("_key", key)
    dealt = keyed.repartitionByRange(ranges or max(2, _partitions(df)), *parts, "_key")
    dealt = materialize(dealt.withColumn("_rng", F.spark_partition_id()))
    totals = dealt.groupBy(*parts, "_rng").agg(*[F.sum(v).alias(f"_t_{v}") for v in value_cols])
    before = Window.partitionBy(*parts).orderBy("_rng").rowsBetween(*_SO_FAR)
    offsets = totals.select(*parts, "_rng", *[
        (F.sum(f"_t_{v}").over(before) - F.col(f"_t_{v}")).alias(f"_o_{v}") for v in value_cols])
    inside = Window.partitionBy(*parts, "_rng").orderBy("_key").rowsBetween(*_SO_FAR)
    out = _null_safe_join(dealt, offsets, [*parts, "_rng"])
    for v in value_cols:
        out = out.withColumn(f"cum_{v}", F.col(f"_o_{v}") + F.sum(v).over(inside))
    return out.drop("_rng", "_key", *[f"_o_{v}" for v in value_cols])


def running_sums(df: DataFrame, order_col: str, value_cols: Sequence[str],
                 descending: bool = False, ranges: int | None = None, parts: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums ``cum_<v>`` in order of ``order_col`` (values
    must be distinct, e.g. after a ``groupBy`` on it), within ``parts``."""
    key = F.col(order_col).cast("double")
    return _running(df, parts, -key if descending else key, value_cols, ranges)


def exact_quantiles(df: DataFrame, cols: Sequence[str], q: float, ranges: int | None = None) -> DataFrame:
    """One row: the exact interpolated quantile (as ``percentile``) of each numeric
    column, NULL for a column without values.

    All columns are reduced together to (column, value, count) by one distributed
    group-by; running counts per column locate the two values that bracket position
    (n - 1) * q, so no task holds all distinct values of a column.
    """
    cols = list(cols)
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("_f"), F.col(c).cast("double").alias("_v"))
                                for i, c in enumerate(cols)]))
    values = (df.select(pairs.alias("p")).select("p.*").where(F.col("_v").isNotNull())
              .groupBy("_f", "_v").agg(F.count(F.lit(1)).alias("_c")))
    cum = _running(values, ["_f"], F.col("_v"), ["_c"], ranges)
    n = values.groupBy("_f").agg(F.sum("_c").alias("_n"))
    pos = (F.col("_n") - 1) * F.lit(float(q))
    low, high = F.floor(pos), F.ceil(pos)
    ends = cum.join(n, "_f").groupBy("_f", pos.alias("_pos"), low.alias("_low"), high.alias("_high")).agg(
        F.min(F.when(F.col("cum__c") > low, F.col("_v"))).alias("_v0"),
        F.min(F.when(F.col("cum__c") > high, F.col("_v"))).alias("_v1"))
    mid = (F.col("_high") - F.col("_pos")) * F.col("_v0") + (F.col("_pos") - F.col("_low")) * F.col("_v1")
    value = F.when((F.col("_low") == F.col("_high")) | (F.col("_v0") == F.col("_v1")), F.col("_v0")).otherwise(mid)
    return ends.agg(*[F.max(F.when(F.col("_f") == i, value)).alias(c) for i, c in enumerate(cols)])


def exact_quantile(df: DataFrame, col: str, q: float, ranges: int | None = None) -> float | None:
    """The exact interpolated quantile of one column as a number."""
    return exact_quantiles(df, [col], q, ranges).first()[0]


def top_k_array(values: Sequence[tuple[str, Column]], k: int) -> Column:
    """Per-row top-k of named values by absolute size (name breaks ties), as an
    array of structs (name, value) -- sorted inside the row, no shuffle."""
    items = F.array(*[F.struct((-F.abs(c)).alias("neg_abs"), F.lit(n).alias("name"),
                               c.alias("value")) for n, c in values])
    return F.slice(F.sort_array(items), 1, k)


def top_k_of_array(names: Sequence[str] | Column, values: Column, k: int) -> Column:
    """Top-k of an array<double> column (position i named ``names[i]``; an array column of names
    keeps the plan small) by absolute size, name breaking ties; compact higher-order
    expressions instead of one expression per element."""
    labels = names if isinstance(names, Column) else F.array(*[F.lit(n) for n in names])
    labelled = F.arrays_zip(labels.alias("name"),
                            values.alias("value"))
    items = F.transform(labelled, lambda s: F.struct((-F.abs(s["value"])).alias("neg_abs"),
                                                      s["name"].alias("name"),
                                                      s["value"].alias("value")))
    return F.slice(F.sort_array(items), 1, k)
