import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from dealscope.operators import explain, features, treeshap
from dealscope.schemas import CONTRIBUTION_SCHEMA


def test_mode_median_and_unknown_level(spark):
    train = spark.createDataFrame(
        [("b", 1.0), ("a", 2.0), ("a", 4.0), ("b", 9.0), (None, None)], "c string, x double")
    modes = features.fit_modes(train, ["c"]).first()
    assert modes.c == "a"                                        # tie -> smallest
    assert features.fit_medians(train, ["x"]).first().x == 3.0   # exact median
    fitted = features.fit_features(train, ["c"], ["x"])
    assert fitted.feature_names() == ["cat__c_a", "cat__c_b", "num__x"]
    test = spark.createDataFrame([("zzz", 3.0), (None, None), ("b", 1.0)], "c string, x double")
    got = [r.features.toArray().tolist() for r in fitted.transform(test).collect()]
    # unseen level -> all zeros; NULL -> the mode ("a"); numerics standardised
    imputed = [1.0, 2.0, 4.0, 9.0, 3.0]
    mu = sum(imputed) / 5
    sd = math.sqrt(sum((v - mu) ** 2 for v in imputed) / 5)   # population std
    assert got[0][:2] == [0.0, 0.0] and abs(got[0][2] - (3.0 - mu) / sd) < 1e-12
    assert got[1][:2] == [1.0, 0.0]
    assert got[2][:2] == [0.0, 1.0]


def test_top_contributions_ties_and_empty(spark):
    df = spark.createDataFrame([("d1", 0.5, -0.5, 0.5, -0.5), ("d2", 0.1, -0.3, 0.2, 0.0)],
                               "opportunity_id string, a double, b double, c double, d double")
    terms = [(n, F.col(n)) for n in "dcba"]
    out = explain.top_contributions(df, terms, k=3).orderBy("opportunity_id", "rank").collect()
    assert [r.feature for r in out if r.opportunity_id == "d1"] == ["a", "b", "c"]
    assert [r.feature for r in out if r.opportunity_id == "d2"] == ["b", "c", "a"]
    assert out[1].direction == "lowers score" and out[0].direction == "raises score"
    empty = explain.top_contributions(df.limit(0), terms, k=3)
    assert empty.count() == 0
    assert [f.name for f in empty.schema] == [f.name for f in CONTRIBUTION_SCHEMA]


def _brute_shapley(tree, x, n_features):
    """Shapley values over *all* features with the cover-weighted value function."""
    nodes = tree["nodes"]
    root = treeshap._root(nodes)

    def value(i, S):
        n = nodes[i]
        if n["left"] < 0:
            return n["value"]
        if n["feature"] in S:
            left = treeshap._goes_left(n, np.array([x[n["feature"]]]))[0]
            return value(n["left"] if left else n["right"], S)
        cl, cr = nodes[n["left"]]["cover"], nodes[n["right"]]["cover"]
        return (cl * value(n["left"], S) + cr * value(n["right"], S)) / (cl + cr)

    phi = np.zeros(n_features)
    M = n_features
    for i in range(M):
        others = [j for j in range(M) if j != i]
        for r in range(M):
            for S in itertools.combinations(others, r):
                w = math.factorial(r) * math.factorial(M - r - 1) / math.factorial(M)
                phi[i] += w * (value(root, set(S) | {i}) - value(root, set(S)))
    return phi


def test_treeshap_matches_brute_force():
    tree = {"weight": 0.5, "nodes": {
        0: dict(value=0, cover=10, left=1, right=2, feature=0, split=[0.5], categorical=False),
        1: dict(value=0, cover=6, left=3, right=4, feature=1, split=[1.0], categorical=False),
        2: dict(value=0, cover=4, left=5, right=6, feature=2, split=[0.0], categorical=False),
        3: dict(value=1.0, cover=2, left=-1, right=-1, feature=None, split=[], categorical=False),
        4: dict(value=-2.0, cover=4, left=-1, right=-1, feature=None, split=[], categorical=False),
        5: dict(value=3.0, cover=1, left=-1, right=-1, feature=None, split=[], categorical=False),
        6: dict(value=0.5, cover=3, left=-1, right=-1, feature=None, split=[], categorical=False),
    }}
    X = np.array([[0.0, 2.0, 1.0, 7.0], [1.0, 0.0, -1.0, 0.0]])
    phi, base = treeshap.shap_matrix([tree], X, 4)
    for r in range(2):
        assert np.allclose(phi[r], 2 * 0.5 * _brute_shapley(tree, X[r], 4))
        assert phi[r][3] == 0.0                                # unused feature


def test_treeshap_additivity_on_spark_gbt(spark):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    import random
    random.seed(1)
    rows = [(f"r{i}", float(random.random()), float(random.randint(0, 3)), float(random.random()))
            for i in range(300)]
    df = spark.createDataFrame(rows, "opportunity_id string, a double, b double, c double")
    df = df.withColumn("target", ((F.col("a") + F.col("b") / 3 + F.rand(7) * 0.5) > 1.0).cast("int"))
    data = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    gbt = GBTClassifier(labelCol="target", maxIter=10, maxDepth=3, seed=42).fit(data)
    scored = gbt.transform(data).select("opportunity_id", "probability")
    contrib = treeshap.tree_contributions(data, gbt)
    joined = contrib.join(scored, "opportunity_id").collect()
    for r in joined:
        p = r.probability[1]
        assert abs(sum(r.contributions) + r.base_value - math.log(p / (1 - p))) < 1e-9


def test_modes_take_the_smallest_of_ties(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("a", None), ("b", None), (None, None), ("c", None)], "c string, d string")
    assert features.modes(df, ["c", "d"]) == {"c": "a", "d": None}
    assert features.modes(df.limit(0), ["c"]) == {"c": None}


def test_treeshap_additivity_on_pipeline_model(spark):
    """Σ contributions + base = logit(P(won)) for the real feature pipeline
    (one-hot columns included) fitted on the smallest driver tables."""
    from dealscope.operators import models, splits
    from dealscope.plans.queries import load_mart
    from tests.conftest import SF_SMALL
    closed = splits.with_holdout(models.model_frame(load_mart(spark, SF_SMALL)))
    train = closed.filter(F.col("split") == "train")
    test = closed.filter(F.col("split") == "test")
    model = models.fit(train, models.BOOSTED)
    cats = {n["categorical"] for t in treeshap.tree_tables(model.estimator_model, spark)
            for n in t["nodes"].values()}
    contrib = treeshap.tree_contributions(model.pipeline.transform(test), model)
    rows = contrib.join(model.score(test).select("opportunity_id", "propensity_to_close"),
                        "opportunity_id").collect()
    assert rows and cats
    for r in rows:
        p = r.propensity_to_close
        assert abs(sum(r.contributions) + r.base_value - math.log(p / (1 - p))) < 1e-9
