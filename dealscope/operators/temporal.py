"""Joins and frames over time that spread a hot key over many tasks.

* :func:`asof_join`: for every left row the latest right row of its key at or before its time.
* :func:`overlap_join`: pairs of rows of a key whose half-open intervals overlap.
* :func:`peak_overlap`: the largest number of a key's intervals that are open at once.
* :func:`sessions`: runs of a key's events with gaps of at most a limit.
* :func:`trailing`: aggregates over a key's last days up to each event.

Keys ordered by time are dealt into ranges of (key, time), so a key with many rows fills several
ranges; what a range must know of the ranges before it is one row per (range, key), a small table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .ranking import _null_safe_join, _partitions, _running

_BEFORE = (Window.unboundedPreceding, -1)
_UP_TO = (Window.unboundedPreceding, Window.currentRow)
DAY_MICROS = 86_400_000_000


def micros(ts: str) -> Column:
    """Wall-clock microseconds since 1970 of a timestamp column, whatever the session's time zone."""
    c = F.col(ts)
    second = (F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("bigint")
    return F.unix_date(F.to_date(c)).cast("bigint") * DAY_MICROS + (F.hour(c) * 3600 + F.minute(c) * 60).cast("bigint") * 1_000_000 + second


def _dealt(df: DataFrame, *order: str) -> DataFrame:
    """Rows in ranges (``_rng``) of ``order``, written once so that later reads see the same ranges."""
    return materialize(df.repartitionByRange(max(2, _partitions(df)), *order).withColumn("_rng", F.spark_partition_id()))


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_time: str, right_time: str,
              values: Sequence[str], tie: Sequence[str] = (), max_age_days: int | None = None) -> DataFrame:
    """``left`` with the ``values`` and ``right_time`` of the latest right row of the same keys whose time is not
    later; NULL where there is none (or it is older than ``max_age_days``).

    Right rows of one key and time: the one with the largest ``tie``, then values, counts.  A NULL key or
    time matches nothing.  Every left row is kept, repeated ones too.
    """
    keys = list(keys)
    offered = right.dropna(subset=[*keys, right_time]).groupBy(*keys, F.col(right_time).alias("_t")).agg(
        F.max(F.struct(*[F.col(c).alias(f"_tie{i}") for i, c in enumerate(tie)], *values)).alias("_v"))
    offered = offered.select(*keys, "_t", F.lit(0).alias("_tag"), F.lit(0).cast("bigint").alias("_deal"),
                             F.struct(F.col("_t").alias(right_time), *[F.col(f"_v.{c}") for c in values]).alias("_v"))
    asked = left.select(*keys, F.col(left_time).alias("_t"), F.lit(1).alias("_tag"), F.xxhash64(F.struct("*")).alias("_deal"),
                        F.struct("*").alias("_left"))
    # _deal spreads left rows of one key and time over ranges; a range border between them is as good as any.
    dealt = _dealt(asked.unionByName(offered, allowMissingColumns=True), *keys, "_t", "_tag", "_deal")
    inside = Window.partitionBy("_rng", *keys).orderBy("_t", "_tag").rowsBetween(*_UP_TO)
    ends = dealt.groupBy("_rng", *keys).agg(F.max_by("_v", F.when(F.col("_tag") == 0, F.col("_t"))).alias("_last"))
    carried = F.last("_last", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_rng").rowsBetween(*_BEFORE))
    found = _null_safe_join(dealt.withColumn("_here", F.last("_v", ignorenulls=True).over(inside)),
                            ends.select("_rng", *keys, carried.alias("_carried")), ["_rng", *keys])
    match = F.coalesce(F.col("_here"), F.col("_carried"))
    usable = F.col("_t").isNotNull()
    for k in keys:
        usable &= F.col(k).isNotNull()
    if max_age_days is not None:
        usable &= F.date_add(F.to_date(match[right_time]), max_age_days) >= F.to_date("_t")
    match = F.when(usable, match)
    return found.where("_tag = 1").select("_left.*", match[right_time].alias(right_time), *[match[c].alias(c) for c in values])


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], span: tuple[str, str], width: int | None = None) -> DataFrame:
    """Pairs ``l``, ``r`` (structs of the rows) of equal keys whose intervals [start, end) overlap, with the overlap's
    bounds ``from_``, ``to_``.  ``span`` names the two whole-number columns on both sides.

    Each interval goes to the bins of ``width`` it touches; rows of equal (keys, bin) meet, the overlap is checked
    exactly, and a pair counts in the first bin that both touch.  The default width is the mean length, so
    that both sides together have at most three times their rows.  Empty, inverted and NULL intervals overlap nothing.
    """
    keys, (start, end) = list(keys), span
    sides = [df.where(F.col(start) < F.col(end)).dropna(subset=keys) for df in (left, right)]
    if width is None:
        lengths = sides[0].select(F.col(end) - F.col(start)).union(sides[1].select(F.col(end) - F.col(start))).toDF("n")
        width = max(1, int(lengths.agg(F.ceil(F.avg("n"))).first()[0] or 1))

    def binned(df: DataFrame, name: str) -> DataFrame:
        first, last = (F.floor(c / F.lit(width)) for c in (F.col(start), F.col(end) - 1))
        return df.select(*[F.col(k).alias(f"_{name}_{k}") for k in keys], F.struct("*").alias(name), F.explode(F.sequence(first, last)).alias(f"_{name}_bin"))

    a, b = binned(sides[0], "l"), binned(sides[1], "r")
    on = F.col("_l_bin") == F.col("_r_bin")
    for k in keys:
        on &= F.col(f"_l_{k}") == F.col(f"_r_{k}")
    low, high = F.greatest(f"l.{start}", f"r.{start}"), F.least(f"l.{end}", f"r.{end}")
    return (a.join(b, on).where((low < high) & (F.floor(low / F.lit(width)) == F.col("_l_bin")))
            .select("l", "r", low.alias("from_"), high.alias("to_")))


def peak_overlap(df: DataFrame, keys: Sequence[str], span: tuple[str, str]) -> DataFrame:
    """keys, peak (largest number of intervals open at once) and peak_start (when first reached): a running sum of
    openings and closings, dealt by (key, time)."""
    keys, (start, end) = list(keys), span
    real = df.where(F.col(start) < F.col(end)).dropna(subset=keys)
    steps = real.select(*keys, F.col(start).alias("at"), F.lit(1).alias("step")).unionByName(
        real.select(*keys, F.col(end).alias("at"), F.lit(-1).alias("step")))
    net = steps.groupBy(*keys, "at").agg(F.sum("step").alias("step"))
    running = _running(net, keys, F.col("at"), ["step"], None)
    best = running.groupBy(*keys).agg(F.max(F.struct(F.col("cum_step").alias("peak"), (-F.col("at")).alias("first"))).alias("m"))
    return best.select(*keys, F.col("m.peak").alias("peak"), (-F.col("m.first")).alias("peak_start"))


def sessions(events: DataFrame, key: str, at: str, gap: int, order: Sequence[str] = (), values: Mapping[str, Column] | None = None) -> DataFrame:
    """key, session (1, 2, ... by time), first_at, last_at, n and ``values`` (aggregates) of each session: events
    of a key no more than ``gap`` after the one before.  ``at`` is a whole number; rows without it are left out."""
    dealt = _dealt(events.where(F.col(at).isNotNull()), key, at, *order)
    inside = Window.partitionBy("_rng", key).orderBy(at, *order)
    marked = dealt.withColumn("_new", F.coalesce((F.col(at) - F.lag(at).over(inside) > gap).cast("int"), F.lit(0)))
    part = marked.groupBy("_rng", key).agg(F.min(at).alias("_low"), F.max(at).alias("_high"), F.sum("_new").alias("_inner"))
    by_range = Window.partitionBy(key).orderBy("_rng")
    opens = F.coalesce((F.col("_low") - F.lag("_high").over(by_range) > gap).cast("int"), (F.lag("_high").over(by_range).isNull()).cast("int"))
    part = part.withColumn("_opens", opens)
    before = F.sum(F.col("_opens") + F.col("_inner")).over(by_range.rowsBetween(*_UP_TO)) - F.col("_inner")
    numbered = _null_safe_join(marked, part.select("_rng", key, before.alias("_before")), ["_rng", key])
    number = F.col("_before") + F.sum("_new").over(inside.rowsBetween(*_UP_TO))
    return numbered.withColumn("session", number).groupBy(key, "session").agg(
        F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.count(F.lit(1)).alias("n"),
        *[c.alias(n) for n, c in (values or {}).items()])


def trailing(events: DataFrame, key: str, at: str, span: int, values: Mapping[str, Column]) -> DataFrame:
    """``events`` with aggregates over the same key's rows from ``span`` before to the row's own time (equal times
    included).  Time is cut into blocks of ``span``; a block's frames reach back into the one before, whose rows it
    gets as context, so no task holds more of a key than two blocks.  Rows without a time are left out."""
    block = F.floor(F.col(at) / F.lit(span))
    real = events.where(F.col(at).isNotNull())
    both = real.withColumn("_block", block).withColumn("_own", F.lit(True)).unionByName(
        real.withColumn("_block", block + 1).withColumn("_own", F.lit(False)))
    frame = Window.partitionBy(key, "_block").orderBy(at).rangeBetween(-span, Window.currentRow)
    out = both
    for name, c in values.items():
        out = out.withColumn(name, c.over(frame))
    return out.where("_own").drop("_block", "_own")
