"""Weighted sampling without replacement, exact quotas per stratum, the same rows on every run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import md5_hash32
from ..schemas import SEED
from .ranking import _partitions


def exponential_key(id_col: str, weight: Column, seed: int = SEED) -> Column:
    """-ln(u) / weight with u in (0, 1) from a hash of the id: the k smallest keys are a weighted sample without
    replacement (Efraimidis & Spirakis, 2006)."""
    u = (md5_hash32(F.col(id_col), seed) + 0.5) / F.lit(float(1 << 32))
    return -F.log(u) / weight


def weighted_sample(df: DataFrame, stratum: str, weight: str, id_col: str, k: int, seed: int = SEED) -> DataFrame:
    """``df``'s rows in the sample, at most ``k`` per stratum (all rows with a positive weight if there are fewer).

    Each stratum is first cut to its k smallest keys in every one of many hash parts, then over the parts, so
    a large stratum is never in one task.  Rows with a NULL id, or a weight that is NULL or not positive, are never drawn.
    """
    real = df.where((F.col(weight) > 0) & F.col(id_col).isNotNull())
    keyed = real.withColumn("_key", exponential_key(id_col, F.col(weight).cast("double"), seed)) \
                .withColumn("_part", F.pmod(F.xxhash64(id_col), F.lit(_partitions(df))))
    for parts in ([stratum, "_part"], [stratum]):
        rank = F.row_number().over(Window.partitionBy(*parts).orderBy("_key", id_col))
        keyed = keyed.withColumn("_rank", rank).where(F.col("_rank") <= k)
    return keyed.drop("_key", "_part", "_rank")
