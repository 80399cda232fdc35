"""Per-row Tree SHAP contributions for fitted boosted trees.

Path-dependent Tree SHAP (Lundberg, Erion & Lee, "Consistent individualized
feature attribution for tree ensembles", 2018): the value of a coalition S
is the tree's expected output when features in S follow the row and the
others are averaged with the training covers.  For each tree only the features it
splits on matter (other features are null players), and 8 leaves bound them to 7,
so we evaluate all 2**m coalitions vectorised over a batch of rows and apply
the Shapley formula exactly.

Only what the trees use travels: the columns they test (``boosting`` models) or the used
positions of the feature vector (Spark's GBT) go to Python, and one number per used feature,
or the top k of them, comes back.

The node tables are bounded by trees x nodes and travel to the executors inside the
``mapInPandas`` closure.  Contributions and the base value are on the log-odds scale (Spark's
GBT margin is ``F = sum_t w_t f_t`` with P(won) = sigmoid(2F)): base + sum(contributions) = logit(P(won)).
"""

from __future__ import annotations

import math
import uuid

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir, ship_package
from .boosting import LeafwiseTreesModel


def tree_tables(gbt_model, spark) -> list[dict]:
    """Node arrays per tree: from a ``boosting`` model's own description, or from the saved data
    of a Spark GBT (treeID, nodeData)."""
    if isinstance(gbt_model, LeafwiseTreesModel):
        return _Used(gbt_model, spark).trees
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/treeshap-{uuid.uuid4().hex}"
    gbt_model.write().overwrite().save(path)
    rows = (spark.read.parquet(f"{path}/data")
            .select("treeID", "nodeData.id", "nodeData.prediction", "nodeData.rawCount",
                    "nodeData.leftChild", "nodeData.rightChild", "nodeData.split.featureIndex",
                    "nodeData.split.leftCategoriesOrThreshold", "nodeData.split.numCategories")
            .collect())
    weights = list(gbt_model.treeWeights)
    trees: dict[int, dict] = {}
    for r in rows:
        t = trees.setdefault(r["treeID"], {"nodes": {}, "weight": weights[r["treeID"]]})
        t["nodes"][r["id"]] = {
            "value": r["prediction"], "cover": float(r["rawCount"]),
            "left": r["leftChild"], "right": r["rightChild"], "feature": r["featureIndex"],
            "split": list(r["leftCategoriesOrThreshold"] or []),
            "categorical": (r["numCategories"] or -1) > -1}
    return [trees[k] for k in sorted(trees)]


MAX_TREE_FEATURES = 7       # a tree of 8 leaves has 7 splits


def _root(nodes: dict) -> int:
    children = {n["left"] for n in nodes.values()} | {n["right"] for n in nodes.values()}
    return next(i for i in nodes if i not in children)


def _goes_left(node: dict, x: np.ndarray) -> np.ndarray:
    if node["categorical"]:
        return np.isin(x, node["split"])
    return x <= node["split"][0]


def _coalition_values(nodes: dict, root: int, X: np.ndarray, feats: list[int]) -> np.ndarray:
    """v[mask] for every coalition of ``feats`` (bit j <-> feats[j]); rows x 2**m."""
    m = len(feats)
    out = np.empty((X.shape[0], 1 << m))
    pos = {f: j for j, f in enumerate(feats)}
    for mask in range(1 << m):
        def value(i):
            n = nodes[i]
            if n["left"] < 0:
                return np.full(X.shape[0], n["value"])
            lv, rv = value(n["left"]), value(n["right"])
            if mask >> pos[n["feature"]] & 1:
                return np.where(_goes_left(n, X[:, n["feature"]]), lv, rv)
            cl, cr = nodes[n["left"]]["cover"], nodes[n["right"]]["cover"]
            tot = cl + cr
            return (cl * lv + cr * rv) / tot if tot > 0 else 0.5 * (lv + rv)
        out[:, mask] = value(root)
    return out


def shap_matrix(trees: list[dict], X: np.ndarray, n_features: int) -> tuple[np.ndarray, float]:
    """(rows x features contributions on the log-odds scale, base value)."""
    phi = np.zeros((X.shape[0], n_features))
    base = 0.0
    for t in trees:
        nodes, w = t["nodes"], 2.0 * t["weight"]
        root = _root(nodes)
        feats = sorted({n["feature"] for n in nodes.values() if n["left"] >= 0})
        v = _coalition_values(nodes, root, X, feats)
        base += w * float(v[0, 0]) if X.shape[0] else w * 0.0
        m = len(feats)
        if m == 0:
            continue
        weight = [math.factorial(s) * math.factorial(m - s - 1) / math.factorial(m) for s in range(m)]
        for j, f in enumerate(feats):
            bit = 1 << j
            acc = np.zeros(X.shape[0])
            for mask in range(1 << m):
                if mask & bit:
                    continue
                acc += weight[bin(mask).count("1")] * (v[:, mask | bit] - v[:, mask])
            phi[:, f] += w * acc
    return phi, base


class _Used:
    """The features that a model's trees test, under consecutive numbers, and how rows give their values."""

    def __init__(self, model, spark):
        estimator = model.estimator_model if hasattr(model, "estimator_model") else model
        if isinstance(estimator, LeafwiseTreesModel):
            self.base, self.tests, self.trees = estimator.base, {}, []
            for tree in estimator.trees:
                self.trees.append({"weight": 0.5, "nodes": {int(k): self._node(int(k), n) for k, n in tree.items()}})
            self.names = list(self.tests)
        else:
            self.base, self.trees = 0.0, tree_tables(estimator, spark)
            self.tests = None
            positions = sorted({n["feature"] for t in self.trees for n in t["nodes"].values() if n["left"] >= 0})
            self.positions = positions
            for tree in self.trees:
                for n in tree["nodes"].values():
                    n["feature"] = positions.index(n["feature"]) if n["left"] >= 0 else None
            known = model.feature_names() if hasattr(model, "feature_names") else None
            self.names = [known[p] if known else str(p) for p in positions]
        widest = max((len({n["feature"] for n in t["nodes"].values() if n["left"] >= 0}) for t in self.trees), default=0)
        if widest > MAX_TREE_FEATURES:
            raise ValueError(f"a tree splits on {widest} features; 2 ** {MAX_TREE_FEATURES} coalitions are the limit")

    def _node(self, at: int, node: dict) -> dict:
        if "value" in node:
            return {"value": node["value"], "cover": float(node["cover"]), "left": -1, "right": -1, "feature": None, "split": [],
                    "categorical": False}
        level = "level" in node
        self.tests.setdefault(node["name"], (node["column"], node.get("level")))
        return {"value": 0.0, "cover": float(node["cover"]), "left": 2 * at, "right": 2 * at + 1,
                "feature": list(self.tests).index(node["name"]), "split": [1.0] if level else [node["threshold"]], "categorical": level}

    def columns(self, features_col: str) -> list:
        if self.tests is not None:
            return [F.col(c) for c in sorted({c for c, _ in self.tests.values()})]
        dense = vector_to_array(F.col(features_col))
        return [dense[p].alias(f"_{p}") for p in self.positions]

    def matrix(self, pdf: pd.DataFrame) -> np.ndarray:
        if self.tests is None:
            return pdf[[f"_{p}" for p in self.positions]].to_numpy(np.float64)
        x = np.empty((len(pdf), len(self.tests)))
        for k, (column, level) in enumerate(self.tests.values()):
            values = pdf[column]
            x[:, k] = (values == level).to_numpy() if level is not None else values.to_numpy(np.float64)
        return x

    def contributions(self, pdf: pd.DataFrame) -> np.ndarray:
        return shap_matrix(self.trees, self.matrix(pdf), len(self.names))[0]

    def base_value(self) -> float:
        return self.base + shap_matrix(self.trees, np.zeros((1, len(self.names))), len(self.names))[1]


def _mapped(df: DataFrame, model, features_col: str, id_col: str, out: T.StructField, values) -> DataFrame:
    spark = df.sparkSession
    ship_package(spark)
    used = _Used(model, spark)
    base_value = used.base_value()
    names = used.names
    # Not the schema of ``df``: it may describe every level of the features.
    schema = T.StructType([T.StructField(id_col, df.select(id_col).schema[id_col].dataType), out, T.StructField("base_value", T.DoubleType())])

    def run(batches):
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({id_col: pdf[id_col].to_numpy(), out.name: values(names, used.contributions(pdf)), "base_value": base_value})

    return df.select(id_col, *used.columns(features_col)).mapInPandas(run, schema)


def tree_contributions(df: DataFrame, model, features_col: str = "features",
                       id_col: str = "opportunity_id") -> DataFrame:
    """``contributions`` (array<double>, one per feature that the trees use, see :func:`used_features`)
    and ``base_value`` of each row of an already-transformed frame."""
    return _mapped(df, model, features_col, id_col, T.StructField("contributions", T.ArrayType(T.DoubleType())),
                   lambda names, phi: list(phi))


def used_features(model, spark) -> list[str]:
    return _Used(model, spark).names


def tree_top(df: DataFrame, model, k: int, features_col: str = "features", id_col: str = "opportunity_id") -> DataFrame:
    """``_top``: the k largest contributions (name, value) of each row by absolute size, name breaking
    ties; features that no tree uses count with 0."""
    unused = sorted(set(model.feature_names()) - set(used_features(model, df.sparkSession)))[:k]

    def top(names, phi):
        by_name = np.argsort(np.array([*names, *unused]), kind="stable")
        phi = np.concatenate((phi, np.zeros((len(phi), len(unused)))), axis=1)[:, by_name]
        order = np.argsort(-np.abs(phi), axis=1, kind="stable")[:, :k]
        ordered = [sorted([*names, *unused])[j] for j in range(phi.shape[1])]
        return [[{"name": ordered[j], "value": float(row[j])} for j in at] for row, at in zip(phi, order)]

    item = T.StructType([T.StructField("name", T.StringType()), T.StructField("value", T.DoubleType())])
    return _mapped(df, model, features_col, id_col, T.StructField("_top", T.ArrayType(item)), top)
