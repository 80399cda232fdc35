"""Joins and frames over time against brute force, with hot keys, NULLs and ties."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from dealscope.operators import temporal as T

NOTHING = (None, None)


def skewed(rng, n, keys=6):
    """Keys of which one holds half of all rows; some NULL keys and times; many ties."""
    return [(rng.choice(["hot"] * keys + [f"k{i}" for i in range(keys - 1)] + [None]), rng.choice([None] + list(range(60)) * 2)) for _ in range(n)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    left = [(i, k, t) for i, (k, t) in enumerate(skewed(rng, 900))]
    right = [(k, t, rng.randrange(5), rng.choice([None, f"v{rng.randrange(9)}"])) for k, t in skewed(rng, 300)]
    return left + left[:20], right


def brute_asof(left, right, max_age=None):
    out = []
    for i, k, t in left:
        found = [(rt, tie, v) for rk, rt, tie, v in right if None not in (k, t, rt) and rk == k and rt <= t]
        best = max(found, key=lambda x: (x[0], x[1], x[2] is not None, x[2] or "")) if found else (None, None, None)
        if max_age is not None and best[0] is not None and best[0] + max_age < t:
            best = (None, None, None)
        out.append((i, k, t, best[0], best[2]))
    return sorted(out, key=repr)


def dated(df, column):
    return df.withColumn(column, F.date_add(F.lit("2020-01-01").cast("date"), F.col(column)))


@pytest.mark.parametrize("max_age", [None, 3])
def test_asof_join(spark, rows, max_age):
    left = dated(spark.createDataFrame(rows[0], "i int, k string, t int"), "t")
    right = dated(spark.createDataFrame(rows[1], "k string, rt int, tie int, v string"), "rt")
    found = T.asof_join(left, right, ["k"], "t", "rt", ["v"], tie=["tie"], max_age_days=max_age)
    day = lambda d: None if d is None else (d - __import__("datetime").date(2020, 1, 1)).days
    assert sorted(((r.i, r.k, day(r.t), day(r.rt), r.v) for r in found.collect()), key=repr) == brute_asof(*rows, max_age)


def test_asof_join_carries_over_ranges(spark):
    """One right row far before all left rows of a hot key: every range but one gets it from the small table."""
    left = spark.range(4000).select(F.lit("hot").alias("k"), (F.col("id") + 10).cast("int").alias("t"))
    right = spark.createDataFrame([("hot", 1, "old"), ("hot", 3000, "new")], "k string, rt int, v string")
    found = T.asof_join(left, right, ["k"], "t", "rt", ["v"])
    assert {r.v: r.n for r in found.groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect()} == {"old": 2990, "new": 1010}
    dealt = T._dealt(left, "k", "t")
    assert dealt.groupBy("_rng").count().count() >= 4


def test_asof_join_empty_sides(spark):
    left = spark.createDataFrame([("a", 1)], "k string, t int")
    right = spark.createDataFrame([], "k string, rt int, v string")
    assert [tuple(r) for r in T.asof_join(left, right, ["k"], "t", "rt", ["v"]).collect()] == [("a", 1, None, None)]
    assert T.asof_join(left.limit(0), right, ["k"], "t", "rt", ["v"]).collect() == []


def interval_rows(seed=3, n=400):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        a = rng.choice([None] + list(range(-30, 90)) * 3)
        b = None if a is None or rng.random() < 0.02 else a + rng.choice([-2, 0, 1, 1, 3, 8, 8, 70])
        out.append((i, rng.choice(["hot", "hot", "x", "y", None]), a, b))
    return out


def test_overlap_join(spark):
    rows = interval_rows()
    df = spark.createDataFrame(rows, "i int, k string, a int, b int")
    real = [r for r in rows if None not in r and r[2] < r[3]]
    expected = sorted((x[0], y[0], max(x[2], y[2]), min(x[3], y[3])) for x in real for y in real
                      if x[1] == y[1] and max(x[2], y[2]) < min(x[3], y[3]))
    for width in (None, 1, 1000):
        found = T.overlap_join(df, df, ["k"], ("a", "b"), width)
        assert sorted(tuple(r) for r in found.select("l.i", "r.i", "from_", "to_").collect()) == expected
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert T.overlap_join(df.limit(0), df, ["k"], ("a", "b")).collect() == []


def test_peak_overlap(spark):
    rows = [r for r in interval_rows(5) if None not in r and r[2] < r[3]]
    expected = {}
    for k in {r[1] for r in rows}:
        at = sorted({r[2] for r in rows if r[1] == k})
        n = {t: sum(r[1] == k and r[2] <= t < r[3] for r in rows) for t in at}
        top = max(n.values())
        expected[k] = (top, min(t for t in at if n[t] == top))
    found = T.peak_overlap(spark.createDataFrame(rows, "i int, k string, a int, b int"), ["k"], ("a", "b"))
    assert {r.k: (r.peak, r.peak_start) for r in found.collect()} == expected


def test_sessions(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice(["hot"] * 5 + ["a", None]), rng.choice([None] + list(range(0, 4000))), rng.random()) for i in range(1500)]
    df = spark.createDataFrame(rows, "i int, k string, t bigint, v double")
    by_key = defaultdict(list)
    for i, k, t, v in rows:
        if t is not None:
            by_key[k].append(t)
    expected = []
    for k, times in by_key.items():
        times.sort()
        runs = [[times[0]]]
        for t in times[1:]:
            if t - runs[-1][-1] > 5:
                runs.append([])
            runs[-1].append(t)
        expected += [(k, n, r[0], r[-1], len(r)) for n, r in enumerate(runs, 1)]
    found = T.sessions(df, "k", "t", 5, ["i"], {"v": F.sum("v")})
    assert sorted((tuple(r)[:5] for r in found.collect()), key=repr) == sorted(expected, key=repr)


def test_trailing(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice(["hot"] * 4 + ["a", None]), rng.choice([None] + list(range(-50, 300))), rng.randrange(9)) for i in range(500)]
    found = T.trailing(spark.createDataFrame(rows, "i int, k string, t bigint, v int"), "k", "t", 20, {"n": F.count(F.lit(1)), "s": F.sum("v")})
    expected = sorted((i, len(w), sum(w)) for i, k, t, _ in rows if t is not None
                      for w in [[v for _, k2, t2, v in rows if k2 == k and t2 is not None and t - 20 <= t2 <= t]])
    assert sorted((r.i, r.n, r.s) for r in found.collect()) == expected


def test_micros_do_not_depend_on_the_time_zone(spark):
    df = spark.createDataFrame([("2024-03-31 02:30:00.000007",), ("1969-12-31 23:59:59.999999",)], "s string")
    df = df.select(F.expr("to_timestamp_ntz(s)").alias("ts"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        seen = []
        for zone in ("UTC", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            seen.append([r[0] for r in df.select(T.micros("ts")).collect()])
        assert seen[0] == seen[1] == [1711852200000007, -1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
