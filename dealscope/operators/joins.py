"""Validated many-to-one joins.

No join is forced to broadcast: ``spark.sql.autoBroadcastJoinThreshold`` and adaptive
execution decide by measured bytes, and split skewed partitions of the preserved side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    pass


def duplicate_keys(df: DataFrame, on: list[str] | str) -> DataFrame:
    """Keys that occur more than once (a shuffle on the key; partial counts
    are combined map-side, so a hot key costs one row per task)."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def validated_left_join(left: DataFrame, right: DataFrame, on: list[str] | str) -> DataFrame:
    """Left join that fails if the right side repeats a key (many-to-one)."""
    dups = duplicate_keys(right, on).limit(5).collect()
    if dups:
        raise DuplicateKeyError(f"right side of join repeats keys: {[r.asDict() for r in dups]}")
    return left.join(right, on, "left")
