"""Cubes, sketches, hierarchies, snapshot changes, samples, funnels over events."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dealscope.operators import funnel_events, rollup, sampling, snapshots_diff


def test_cube_tells_totals_from_nulls(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["E", "W", None]), rng.choice(["p", "q"]), rng.choice(["s", None]), f"a{rng.randrange(12)}" if rng.random() < 0.9 else None,
             rng.choice(["Won", "Lost", "Engaging"])) for _ in range(400)]
    df = spark.createDataFrame(rows, "regional_office string, product string, sector string, account string, deal_stage string")
    expected = {}
    closed = [r for r in rows if r[4] != "Engaging"]
    for kept in itertools.product((True, False), repeat=3):
        level = sum((not k) << (2 - i) for i, k in enumerate(kept))
        for r in closed:
            key = level, *(v if k else None for k, v in zip(kept, r))
            n, won, accounts = expected.get(key, (0, 0, frozenset()))
            expected[key] = n + 1, won + (r[4] == "Won"), accounts | ({r[3]} - {None})
    found = {(r.level, r.regional_office, r.product, r.sector): (r.deals, r.won, r.accounts) for r in rollup.outcome_cube(df).collect()}
    assert found == {k: (n, w, len(a)) for k, (n, w, a) in expected.items()}


def test_sketches_merge_in_any_order_and_stay_close(spark, scratch):
    df = spark.range(60_000).select((F.col("id") % 30).alias("day"), (F.col("id") % 2).alias("segment"), (F.hash("id") % 20_000).alias("member"),
                                    (F.col("id") % 1000).cast("double").alias("m"))
    rollup.sketch_table(df, ["day", "segment"], "member", "m").write.parquet(f"{scratch}/daily")
    daily = spark.read.parquet(f"{scratch}/daily")
    weekly = rollup.merge_sketches(daily.withColumn("week", F.floor(F.col("day") / 7)), ["week", "segment"])
    ways = [rollup.merge_sketches(daily, ["segment"]), rollup.merge_sketches(weekly, ["segment"]),
            rollup.merge_sketches(daily.orderBy(F.desc("day")).repartition(5), ["segment"])]
    exact = {r.segment: r for r in df.groupBy("segment").agg(F.count_distinct("member").alias("members"), F.count(F.lit(1)).alias("n")).collect()}
    for way in ways:
        for r in rollup.sketch_estimates(way, ["segment"]).collect():
            assert r.n == exact[r.segment].n
            assert abs(r.members - exact[r.segment].members) <= 0.06 * exact[r.segment].members
            assert abs(r.members_hll - exact[r.segment].members) <= 0.06 * exact[r.segment].members
            assert abs(r.measure_p50 - 500) < 40
    few = rollup.sketch_table(df.where("member < 500 AND member >= 0"), ["segment"], "member", "m")
    true = {r.segment: r.n for r in df.where("member < 500 AND member >= 0").groupBy("segment").agg(F.count_distinct("member").alias("n")).collect()}
    assert {r.segment: r.members for r in rollup.sketch_estimates(few, ["segment"]).collect()} == true      # exact while small


def test_hierarchy_chain_and_dangling_parent(spark):
    links = [(i, i - 1 if i else None) for i in range(1000)] + [(2000, 5000), (2001, 2000), (None, 3)]
    found = {r.child: (r.root, r.depth) for r in rollup.roots(spark.createDataFrame(links, "child int, parent int")).collect()}
    assert found == {**{i: (0, i) for i in range(1000)}, 5000: (5000, 0), 2000: (5000, 1), 2001: (5000, 2)}
    assert rollup.roots(spark.createDataFrame([], "child int, parent int")).collect() == []


@pytest.mark.parametrize("cycle", [1, 2, 3, 8])
def test_hierarchy_cycles_are_found(spark, cycle):
    links = [(100 + i, 100 + (i + 1) % cycle) for i in range(cycle)] + [(i, i - 1 if i else None) for i in range(20)]
    with pytest.raises(rollup.HierarchyCycleError):
        rollup.roots(spark.createDataFrame(links, "child int, parent int"))


def test_two_parents_are_refused(spark):
    with pytest.raises(rollup.HierarchyCycleError):
        rollup.roots(spark.createDataFrame([(1, 2), (1, 3)], "child int, parent int"))


SNAP = "k int, a string, b double"


def test_diff_applied_to_the_old_gives_the_new(spark):
    rng = random.Random(6)
    make = lambda keep: [(k, rng.choice(["x", "y", None]), rng.choice([1.0, None])) for k in range(200) if rng.random() < keep]
    old, new = spark.createDataFrame(make(0.8), SNAP), spark.createDataFrame(make(0.7), SNAP)
    changes = snapshots_diff.diff(old, new, "k")
    assert set(r.change for r in changes.collect()) == {"added", "removed", "changed"}
    as_set = lambda df: sorted((tuple(r) for r in df.select("k", "a", "b").collect()), key=repr)
    assert as_set(snapshots_diff.apply_diff(old, changes, "k")) == as_set(new)
    assert snapshots_diff.diff(old, old, "k").collect() == []


def test_history_gives_back_every_snapshot(spark):
    rng = random.Random(7)
    days = ["2024-01-01", "2024-02-01", "2024-03-01", "2024-04-01"]
    snaps = [[(k, rng.choice(["x", "y"]), rng.choice([1.0, None])) for k in range(40) if rng.random() < 0.8] for _ in days]
    history = spark.createDataFrame(snaps[0], SNAP).withColumn("valid_from", F.lit(days[0]).cast("date")).withColumn("valid_to", F.lit(None).cast("date"))
    for day, snap in zip(days[1:], snaps[1:]):
        history = snapshots_diff.merge_history(history, spark.createDataFrame(snap, SNAP), "k", day)
    rows = history.collect()
    for day, snap in zip(days, snaps):
        valid = [tuple(r)[:3] for r in rows if str(r.valid_from) <= day and (r.valid_to is None or str(r.valid_to) > day)]
        assert sorted(valid, key=repr) == sorted(snap, key=repr)


def test_weighted_sample_quotas_and_rates(spark):
    rows = [(f"d{i}", "big" if i % 10 else "small", float(1 + 3 * (i % 2)) if i % 50 else None) for i in range(6000)] + [(None, "big", 1.0), ("zero", "big", 0.0)]
    df = spark.createDataFrame(rows, "id string, s string, w double")
    first = {r.id for r in sampling.weighted_sample(df, "s", "w", "id", 300).collect()}
    assert first == {r.id for r in sampling.weighted_sample(df.repartition(9), "s", "w", "id", 300).collect()}
    counts, heavy = Counter(), 0
    for seed in range(6):
        for r in sampling.weighted_sample(df, "s", "w", "id", 300, seed=seed).collect():
            counts[seed, r.s] += 1
            heavy += r.s == "big" and r.w == 4.0
    assert set(counts.values()) == {300}
    # "big" holds odd ids (weight 4) and even ones (weight 1) in a ratio of 5 to 4.
    assert 0.78 < heavy / (6 * 300) < 0.88
    assert sampling.weighted_sample(df, "s", "w", "id", 10_000).count() == 6000 - 120


def brute_reach(events, limit, steps):
    best = 0
    for i, (t, name) in enumerate(events):
        if name != steps[0]:
            continue
        best = max(best, 1)
        at = 1
        for t2, n2 in events[i + 1:]:
            if t2 - t <= limit and at < len(steps) and n2 == steps[at]:
                at += 1
                best = max(best, at)
    return best


def test_event_funnel(spark):
    rng = random.Random(12)
    rows = [(i, rng.choice([None, 1, 2, 3, 4, 5, 6, 7]), rng.choice([None] + list(range(100))), rng.choice(["view", "click", "purchase", "error", None]))
            for i in range(250)]
    df = spark.createDataFrame(rows, "i int, u int, t bigint, name string")
    for limit in (3, 20):
        found = funnel_events.furthest_step(df, "u", "t", "name", limit, order=["i"])
        expected = {}
        for u in {r[1] for r in rows if r[2] is not None}:
            events = [(t, n) for t, _, n in sorted((t, i, n) for i, u2, t, n in rows if u2 == u and t is not None)]
            expected[u] = brute_reach(events, limit, funnel_events.STEPS)
        assert {r.user: r.step for r in found.collect()} == expected
    counts = funnel_events.step_counts(found).collect()
    assert [c.users for c in counts] == [sum(v > k for v in expected.values()) for k in range(3)]
