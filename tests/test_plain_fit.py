"""Learned numbers of a fixed small frame against a plain solver: logistic coefficients, scores, holdout AUC."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealscope.operators import metrics, models
from dealscope.schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES


@pytest.fixture(scope="module")
def deals(spark):
    rng = random.Random(21)
    rows = []
    for i in range(240):
        cats = [rng.choice([f"{c}{k}" for k in range(3)] + ([None] if c == "sector" else [])) for c in CATEGORICAL_FEATURES]
        nums = [float(rng.randrange(50)) if rng.random() < 0.95 else None for _ in NUMERIC_FEATURES]
        z = (cats[0] == "sales_agent0") * 1.5 - (cats[1] == "product2") + ((nums[0] or 25) - 25) / 15
        rows.append((f"d{i}", *cats, *nums, int(rng.random() < 1 / (1 + np.exp(-z)))))
    names = ", ".join(["opportunity_id string", *[f"{c} string" for c in CATEGORICAL_FEATURES], *[f"{c} double" for c in NUMERIC_FEATURES], "target int"])
    return spark.createDataFrame(rows, names)


def plain_features(train, rows):
    """Mode, median, population scaling and one-hot by hand."""
    columns, names = [], []
    for c in CATEGORICAL_FEATURES:
        known = [r[c] for r in train if r[c] is not None]
        mode = min(set(known), key=lambda v: (-known.count(v), v))
        for level in sorted({r[c] or mode for r in train}):
            columns.append([float((r[c] or mode) == level) for r in rows])
            names.append(f"cat__{c}_{level}")
    for c in NUMERIC_FEATURES:
        median = float(np.median([r[c] for r in train if r[c] is not None]))
        filled = np.array([median if r[c] is None else r[c] for r in train])
        columns.append([((median if r[c] is None else r[c]) - filled.mean()) / filled.std() for r in rows])
        names.append(f"num__{c}")
    return np.array(columns).T, names


def newton(x, y, c):
    """Minimum of C * log-loss + |w|^2 / 2, intercept free."""
    x1 = np.hstack((x, np.ones((len(x), 1))))
    penalty = np.eye(x1.shape[1])
    penalty[-1, -1] = 0
    w = np.zeros(x1.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x1 @ w))
        step = np.linalg.solve(c * (x1.T * (p * (1 - p))) @ x1 + penalty, c * x1.T @ (p - y) + penalty @ w)
        w -= step
        if np.abs(step).max() < 1e-12:
            return w
    raise AssertionError("no convergence")


def plain_auc(y, s):
    pairs = [(a > b) + 0.5 * (a == b) for a, k in zip(s, y) if k for b, j in zip(s, y) if not j]
    return sum(pairs) / len(pairs)


def test_logistic_equals_plain_newton(deals):
    rows = deals.collect()
    train, test = [r for i, r in enumerate(rows) if i % 4], [r for i, r in enumerate(rows) if not i % 4]
    held = deals.where(F.substring("opportunity_id", 2, 9).cast("int") % 4 == 0)
    fitted = models.fit(deals.join(held.select("opportunity_id"), "opportunity_id", "left_anti"), models.LOGISTIC)
    x, names = plain_features(train, train)
    assert fitted.feature_names() == names
    w = newton(x, np.array([r.target for r in train]), models.LOGISTIC_C)
    assert np.abs(fitted.estimator_model.coefficients.toArray() - w[:-1]).max() < 5e-3
    expected = 1 / (1 + np.exp(-(plain_features(train, test)[0] @ w[:-1] + w[-1])))
    scored = fitted.score(held)
    found = {r.opportunity_id: r.propensity_to_close for r in scored.collect()}
    assert max(abs(found[r.opportunity_id] - e) for r, e in zip(test, expected)) < 2e-3
    auc = metrics.auc(scored, "target", "propensity_to_close").first()["auc"]
    assert abs(auc - plain_auc([r.target for r in test], [found[r.opportunity_id] for r in test])) < 1e-12
    assert auc > 0.6


def test_hashed_levels_score_like_indexed_ones(deals, scratch):
    """Without collisions the same model in other positions; nothing about levels is fitted, unseen ones do no harm."""
    plain, hashed = models.fit(deals, models.LOGISTIC), models.fit(deals, models.LOGISTIC, hash_bits=12)
    a, b = ({r.opportunity_id: r.propensity_to_close for r in m.score(deals).collect()} for m in (plain, hashed))
    assert max(abs(a[k] - b[k]) for k in a) < 2e-3 and len(hashed.feature_names()) == (1 << 12) + len(NUMERIC_FEATURES)
    assert not any(hasattr(s, "labelsArray") for s in hashed.pipeline.stages)
    unseen = hashed.score(deals.limit(1).withColumn("product", F.lit("never seen"))).first()
    assert 0 < unseen.propensity_to_close < 1
    with pytest.raises(ValueError):
        models.fit(deals, models.BOOSTED, hash_bits=12)
