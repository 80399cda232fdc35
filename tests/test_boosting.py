"""Leaf-wise boosted trees against a plain Python version, and their life as a pipeline stage."""

import math
import pickle
import random

import numpy as np
import pytest
from pyspark import RDD
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from dealscope.operators import boosting, models, treeshap
from dealscope.operators.explain import explain
from dealscope.operators.features import fit_features
from dealscope.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES

CATS, NUMS = ("colour", "shape"), ("size", "age")
GROWTH = boosting.Growth(trees=6, leaves=8, rate=0.1, l2=5.0, min_rows=20)


def deal_rows(n=500, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        colour, shape = rng.choice(("red", "green", "blue", None)), rng.choice(("o'clock", "sq\\uare"))
        size, age = float(rng.randrange(40)), rng.choice((None, float(rng.randrange(300))))
        score = (colour == "red") * 1.2 + (size > 17) * 1.5 - (shape == "o'clock") * (size < 9) * 2 + ((age or 0) > 200) - 1
        rows.append((f"d{i}", colour, shape, size, age, int(rng.random() < 1 / (1 + math.exp(-score)))))
    return rows


@pytest.fixture(scope="module")
def deals(spark):
    return spark.createDataFrame(deal_rows(), "opportunity_id string, colour string, shape string, size double, age double, target int")


# ---------------------------------------------------------------- plain version

def plain_boost(x, y, growth, n_categorical):
    """Exact greedy search over every level and every value, row by row; returns the margins after each tree."""
    base = math.log(sum(y) / (len(y) - sum(y)))
    margin, history = [base] * len(y), []
    for _ in range(growth.trees):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g, h = [a - b for a, b in zip(p, y)], [a * (1 - a) for a in p]

        def value(rows):
            return sum(g[i] for i in rows) ** 2 / (sum(h[i] for i in rows) + growth.l2)

        def best(rows):
            found = (0.0, None, None)
            for f in range(len(x[0])):
                for v in sorted({x[i][f] for i in rows}):
                    left = [i for i in rows if (x[i][f] == v if f < n_categorical else x[i][f] <= v)]
                    chosen = set(left)
                    right = [i for i in rows if i not in chosen]
                    if min(len(left), len(right)) >= growth.min_rows:
                        gain = value(left) + value(right) - value(rows)
                        if gain > found[0] + 1e-9:
                            found = (gain, left, right)
            return found

        leaves = [(list(range(len(y))), best(list(range(len(y)))))]
        while len(leaves) < growth.leaves:
            k = max(range(len(leaves)), key=lambda j: leaves[j][1][0])
            if leaves[k][1][0] <= 0:
                break
            _, (_, left, right) = leaves.pop(k)
            leaves += [(left, best(left)), (right, best(right))]
        for rows, _ in leaves:
            step = -sum(g[i] for i in rows) / (sum(h[i] for i in rows) + growth.l2) * growth.rate
            for i in rows:
                margin[i] += step
        history.append((len(leaves), list(margin)))
    return history


def prepared_of(deals):
    feats = fit_features(deals, CATS, NUMS)
    return feats, feats.transform(deals)


def test_equals_plain_python(deals):
    feats, prepared = prepared_of(deals)
    model = boosting.fit_many([(feats, prepared)], growth=GROWTH)[0]
    rows = prepared.orderBy("opportunity_id").select(*[f"idx__{c}" for c in CATS], *[f"num__{c}" for c in NUMS], "target").collect()
    history = plain_boost([tuple(r)[:4] for r in rows], [r.target for r in rows], GROWTH, len(CATS))
    assert [sum("value" in n for n in t.values()) for t in model.trees] == [n for n, _ in history]
    assert max(n for n, _ in history) == 8
    found = [r.m for r in prepared.orderBy("opportunity_id").select(model.margin().alias("m")).collect()]
    assert max(abs(a - b) for a, b in zip(found, history[-1][1])) < 1e-6


def test_dealing_and_lockstep_change_nothing(deals):
    feats, prepared = prepared_of(deals)
    alone = boosting.fit_many([(feats, prepared)], growth=GROWTH)[0].trees
    other = prepared_of(deals.where("size > 3"))
    together = boosting.fit_many([(feats, prepared.repartition(7)), other], growth=GROWTH)
    assert together[0].trees == alone
    assert together[1].trees == boosting.fit_many([other], growth=GROWTH)[0].trees != alone


def test_checkpointed_margins_change_nothing(deals, monkeypatch):
    feats, prepared = prepared_of(deals)
    alone = boosting.fit_many([(feats, prepared)], growth=GROWTH)[0].trees
    monkeypatch.setattr(boosting, "CHECKPOINT_TREES", 2)
    assert boosting.fit_many([(feats, prepared)], growth=GROWTH)[0].trees == alone


def test_l2_shrinks_and_min_rows_holds(deals):
    feats, prepared = prepared_of(deals)
    one = boosting.Growth(trees=1, l2=0.0, min_rows=60)
    free, held = (boosting.fit_many([(feats, prepared)], growth=boosting.Growth(trees=1, l2=x, min_rows=60))[0].trees[0] for x in (0.0, 50.0))
    assert min(n["cover"] for n in free.values()) >= one.min_rows
    size = {k: max(abs(n["value"]) for n in t.values() if "value" in n) for k, t in (("free", free), ("held", held))}
    assert size["held"] < size["free"]


def test_degenerate_frames(spark, deals):
    feats, prepared = prepared_of(deals)
    nothing, sure = boosting.fit_many([(feats, prepared.limit(0)), (feats, prepared.withColumn("target", F.lit(1)))], growth=GROWTH)
    assert nothing.trees == [] and nothing.base == 0.0
    assert all(len(t) == 1 for t in sure.trees) and sure.base > 30
    few = boosting.fit_many([(feats, prepared.limit(15))], growth=GROWTH)[0]
    assert all(len(t) == 1 for t in few.trees)              # 20 rows a leaf: no split
    assert prepared.select(nothing.margin().alias("m")).distinct().collect() == [(0.0,)]


def test_saved_stage_scores_alike(spark, deals, scratch):
    feats, prepared = prepared_of(deals)
    model = boosting.fit_many([(feats, prepared)], growth=GROWTH)[0]
    pipeline = PipelineModel(stages=feats.stages + [model])
    pipeline.write().overwrite().save(f"{scratch}/m")
    again = PipelineModel.load(f"{scratch}/m")
    unseen = spark.createDataFrame([("x", "violet", None, None, float("nan"), 1)], deals.schema).union(deals)
    a, b = ([tuple(r) for r in p.transform(unseen).select("opportunity_id", F.col("probability").cast("string")).collect()] for p in (pipeline, again))
    assert sorted(a) == sorted(b) and len(a) == 501


def test_contributions_add_up_and_only_used_columns_travel(deals):
    feats, prepared = prepared_of(deals)
    fitted = models.FittedModel(models.BOOSTED, PipelineModel(stages=feats.stages + boosting.fit_many([(feats, prepared)], growth=GROWTH)), feats)
    contrib = treeshap.tree_contributions(prepared, fitted)
    rows = contrib.join(fitted.score(deals).select("opportunity_id", "propensity_to_close"), "opportunity_id").collect()
    for r in rows:
        p = r.propensity_to_close
        assert abs(sum(r.contributions) + r.base_value - math.log(p / (1 - p))) < 1e-9
    names = treeshap.used_features(fitted, deals.sparkSession)
    top = {}
    for r in explain(fitted, deals, k=3).collect():
        top.setdefault(r.opportunity_id, []).append((r["rank"], r.feature, r.shap_value))
    for r in rows:
        expected = sorted(zip(names, r.contributions), key=lambda x: (-abs(x[1]), x[0]))[:3]
        assert [(f, round(v, 12)) for _, f, v in sorted(top[r.opportunity_id])] == [(f, round(v, 12)) for f, v in expected]
    plan = contrib._jdf.queryExecution().optimizedPlan().toString()
    assert "features" not in plan.split("MapInPandas")[0] and "imp__" in plan


def test_wide_columns_use_quantile_bins(spark):
    rows = [(f"d{i}", "a", float(i), int(i % 997 < 400)) for i in range(3000)]
    df = spark.createDataFrame(rows, "opportunity_id string, c string, v double, target int")
    feats = fit_features(df, ("c",), ("v",))
    edges = boosting.bin_edges(feats.transform(df), ["num__v"], 32)
    assert 20 <= len(edges[0]) <= 31 and edges[0] == sorted(set(edges[0]))


# ---------------------------------------------------------------- fits in one task and distributed fits

def jobs_of(spark, run) -> int:
    group = f"boosting-{random.random()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_small_fits_take_no_job_per_step(spark, deals):
    jobs = [prepared_of(deals), prepared_of(deals.where("size > 3"))]
    assert jobs_of(spark, lambda: boosting.fit_many(jobs, growth=GROWTH)) <= 6


@pytest.mark.parametrize("wide", [1 << 30, 3, 2])
def test_distributed_growth_finds_the_same_trees(deals, monkeypatch, wide):
    """Also with columns dealt by level, of which some levels have more rows than a partition's share."""
    jobs = [prepared_of(deals), prepared_of(deals.where("size > 3").repartition(3))]
    whole = [m.getOrDefault("spec") for m in boosting.fit_many(jobs, growth=GROWTH)]
    monkeypatch.setattr(boosting, "WHOLE_BYTES", 0)
    monkeypatch.setattr(boosting, "WIDE_LEVELS", wide)
    monkeypatch.setattr(boosting, "CHECKPOINT_TREES", 4)
    assert [m.getOrDefault("spec") for m in boosting.fit_many(jobs, growth=GROWTH)] == whole


def test_deal_keeps_every_level_in_one_partition_but_the_hot_ones():
    counts = np.array([5] * 400 + [9000] + [7] * 300 + [0, 3])
    deal = boosting.Deal.by(0, counts, 8)
    assert deal.hot.tolist() == [400] and deal.parts[400] == -1 and deal.cells[400] == deal.width
    cold = np.delete(np.arange(len(counts)), 400)
    assert (deal.first[deal.parts[cold]] + deal.cells[cold] == cold).all() and (deal.cells[cold] < deal.width).all()
    rows = np.repeat(np.arange(len(counts)), counts)
    part = deal.part_of([rows.astype(np.uint16), np.arange(len(rows), dtype=np.uint32)])
    assert np.bincount(part, minlength=8).max() < 2 * len(rows) / 8


def many_levels(spark):
    """6,000 levels, most of a few rows."""
    rng = random.Random(3)
    rows = [(f"d{i}", f"s{k:05d}", float(rng.randrange(50)), int(rng.random() < 0.2 + 0.6 * (k % 7 == 0)))
            for i, k in enumerate(int(6000 * rng.random() ** 4) for _ in range(20000))]
    df = spark.createDataFrame(rows, "opportunity_id string, rep string, v double, target int")
    feats = fit_features(df, ("rep",), ("v",))
    return [(feats, feats.transform(df))]


def test_many_levels_distributed(spark, monkeypatch):
    """The levels' sums stay in the tasks: what reaches the driver are best splits."""
    jobs, growth = many_levels(spark), boosting.Growth(trees=3, rate=0.3, min_rows=10)
    whole = boosting.fit_many(jobs, growth=growth)[0].trees
    assert any("level" in n for t in whole for n in t.values())
    monkeypatch.setattr(boosting, "WHOLE_BYTES", 0, raising=False)
    monkeypatch.setattr(boosting, "WIDE_LEVELS", 1000, raising=False)
    sent, collect = [], RDD.collect

    def spied(rdd):
        found = collect(rdd)
        sent.append(len(pickle.dumps(found)))
        return found

    monkeypatch.setattr(RDD, "collect", spied)
    assert boosting.fit_many(jobs, growth=growth)[0].trees == whole
    assert sent and max(sent) < 20_000


def test_both_fits_of_the_selected_model_take_a_few_jobs(spark):
    """``train_selected`` fits the holdout's and the temporal training rows together."""
    rows = [(f"r{i % 7}", f"p{i % 5}", f"m{i % 3}", "x", f"s{i % 4}", "y", "z", *[float((i * k) % 17) for k in range(3, 10)], int(i * 7 % 10 < 4 + i % 3))
            for i in range(400)]
    df = spark.createDataFrame(rows, ", ".join([*[f"{c} string" for c in CATEGORICAL_FEATURES], *[f"{c} double" for c in NUMERIC_FEATURES], "target int"]))
    fitted = []
    assert jobs_of(spark, lambda: fitted.extend(models.fit_each([df, df.where("sales_price > 2")], models.BOOSTED))) <= 6
    assert [len(m.estimator_model.trees) for m in fitted] == [100, 100]
    scored = fitted[0].score(df)
    assert scored.count() == 400 and not {"features", "ohe__sales_agent"} & set(scored.columns)
    assert fitted[0].pipeline.transform(df).columns[-2:] == ["features", "probability"]
