"""Change sets between two snapshots of a table, and validity intervals (slowly changing dimension, type 2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ADDED, REMOVED, CHANGED = "added", "removed", "changed"


def _different(columns: Sequence[str]):
    out = F.lit(False)
    for c in columns:
        out |= ~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    return out


def diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """key, change, old, new (structs of the other columns) of the rows that differ, NULL equal to NULL.  The
    key must be unique on both sides and not NULL (a full outer join by key)."""
    columns = [c for c in old.columns if c != key]
    a, b = (df.select(F.col(key).alias(f"_{n}_key"), F.struct(*columns).alias(f"_{n}")) for df, n in ((old, "old"), (new, "new")))
    joined = a.join(b, F.col("_old_key") == F.col("_new_key"), "full")
    change = (F.when(F.col("_old_key").isNull(), ADDED).when(F.col("_new_key").isNull(), REMOVED)
              .when(_different(columns), CHANGED))
    return (joined.select(F.coalesce("_old_key", "_new_key").alias(key), change.alias("change"), F.col("_old").alias("old"), F.col("_new").alias("new"))
            .where("change IS NOT NULL"))


def apply_diff(old: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The new snapshot: old rows without a change, and the new side of the others."""
    kept = old.join(changes.select(key), key, "left_anti").select(*old.columns)
    fresh = changes.where(F.col("new").isNotNull()).select(key, "new.*")
    return kept.unionByName(fresh)


def merge_history(history: DataFrame, snapshot: DataFrame, key: str, as_of) -> DataFrame:
    """A type-2 history (columns of the table, valid_from, valid_to) after another snapshot: rows that changed or
    went are closed at ``as_of``, changed and added ones open there."""
    as_of = F.lit(as_of).cast("date")
    columns = [c for c in history.columns if c not in ("valid_from", "valid_to")]
    current = history.where(F.col("valid_to").isNull())
    changes = diff(current.select(*columns), snapshot.select(*columns), key)
    ended = current.join(changes.where(F.col("change") != ADDED).select(key), key, "left_semi").withColumn("valid_to", as_of)
    lasting = current.join(changes.select(key), key, "left_anti")
    opened = (changes.where(F.col("change") != REMOVED).select(key, "new.*").select(*columns)
              .withColumn("valid_from", as_of).withColumn("valid_to", F.lit(None).cast("date")))
    past = history.where(F.col("valid_to").isNotNull())
    return past.unionByName(ended.select(*history.columns)).unionByName(lasting.select(*history.columns)).unionByName(opened.select(*history.columns))
