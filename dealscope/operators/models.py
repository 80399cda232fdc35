"""Propensity models on Spark ML: fit, cross-validate, select, evaluate, score.

* Logistic baseline: L2 with C = 0.3 maps to ``regParam = 1 / (C * n)``
  (sklearn sums the log-loss, Spark averages it); features are pre-scaled,
  so ``standardization=False``; up to 2000 iterations, tolerance 1e-4.
* Boosted trees (``boosting``): 100 trees grown leaf by leaf to 8 leaves, step 0.03, L2 of 5 on
  the leaf values, 20 rows per leaf.  Spark ML's own depth-wise trees without that term
  (depth 3) can be had by the name ``spark_gbt``.

The preprocessing is refitted on the training rows of every fold (as a
pipeline would) and shared by that fold's models; the fold table is
checkpointed once so that the CV fits do not re-run the mart build.  The boosted trees of
all folds grow together.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, reduce

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import CV_FOLDS, FEATURE_POLICY, SEED
from ..session import materialize
from . import boosting, splits
from . import metrics as M
from .features import FEATURES_COL, FittedFeatures, fit_features
from .mart import engagement_features

LOGISTIC = "logistic_regression"
BOOSTED = "boosted_trees"
SPARK_GBT = "spark_gbt"
MODEL_ORDER = (LOGISTIC, BOOSTED)
LOGISTIC_C = 0.3
LOGISTIC_TOL = 1e-4   # the reference solver's default tolerance


def build_models(n_train: int, label: str = "target") -> dict:
    """The Spark ML estimators by name; boosted trees have no estimator (see ``boosting.fit_many``)."""
    logistic = LogisticRegression(
        featuresCol=FEATURES_COL, labelCol=label, regParam=1.0 / (LOGISTIC_C * max(n_train, 1)),
        elasticNetParam=0.0, standardization=False, maxIter=2000, tol=LOGISTIC_TOL)
    boosted = GBTClassifier(
        featuresCol=FEATURES_COL, labelCol=label, maxIter=100, maxDepth=3, stepSize=0.03,
        minInstancesPerNode=20, subsamplingRate=1.0, featureSubsetStrategy="all", seed=SEED,
        checkpointInterval=10)
    return {LOGISTIC: logistic, SPARK_GBT: boosted}


class FittedModel:
    """Preprocessing + estimator as one ``PipelineModel``, plus feature names."""

    def __init__(self, name: str, pipeline: PipelineModel, features: FittedFeatures):
        self.name, self.pipeline, self.features = name, pipeline, features

    @property
    def estimator_model(self):
        return self.pipeline.stages[-1]

    def feature_names(self) -> list[str]:
        return self.features.feature_names()

    def applied(self, df: DataFrame) -> DataFrame:
        """``df`` with the columns that the estimator reads and those that it adds."""
        return self.pipeline.transform(df)

    def score(self, df: DataFrame, out: str = "propensity_to_close") -> DataFrame:
        """P(won) per row; map-only (no shuffle)."""
        return self.applied(df).withColumn(out, vector_to_array(F.col("probability"))[1])


class FittedTrees(FittedModel):
    """Boosted trees: they read imputed levels and scaled numbers, so that the stages which index levels and assemble
    the feature vector are only made for ``pipeline``."""

    def __init__(self, features: FittedFeatures, model: boosting.LeafwiseTreesModel):
        self.name, self.features, self._model = BOOSTED, features, model

    @cached_property
    def pipeline(self) -> PipelineModel:
        return PipelineModel(stages=self.features.stages + [self._model])

    @property
    def estimator_model(self):
        return self._model

    def applied(self, df: DataFrame) -> DataFrame:
        return self._model.transform(self.features.scaled(df))


def fit_each(trains: list[DataFrame], name: str, label: str = "target", parallelism: int = 2, hash_bits: int | None = None) -> list[FittedModel]:
    """One model of kind ``name`` per training frame; boosted trees grow together (and need indexed levels)."""
    if name == BOOSTED and hash_bits is not None:
        raise ValueError("boosted trees split on levels; hashed features have none")
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        features = list(pool.map(lambda t: fit_features(t, hash_bits=hash_bits), trains))
        if name == BOOSTED:
            grown = boosting.fit_many([(f, f.indexed(t)) for f, t in zip(features, trains)], label)
            return [FittedTrees(f, m) for f, m in zip(features, grown)]
        prepared = [f.transform(t) for f, t in zip(features, trains)]
        fitted = list(pool.map(lambda p: build_models(p.count(), label)[name].fit(p), prepared))
    return [FittedModel(name, PipelineModel(stages=f.stages + [m]), f) for f, m in zip(features, fitted)]


def fit(train: DataFrame, name: str, label: str = "target", hash_bits: int | None = None) -> FittedModel:
    return fit_each([train], name, label, hash_bits=hash_bits)[0]


def model_frame(mart: DataFrame) -> DataFrame:
    """Closed deals with target and engagement features (the training set)."""
    return splits.closed_with_target(engagement_features(mart))


def _auc_value(df: DataFrame, label: str = "target", score: str = "propensity_to_close"):
    return M.auc(df, label, score).first()["auc"]


def cross_validate(closed: DataFrame, names=MODEL_ORDER, k: int = CV_FOLDS,
                   label: str = "target", parallelism: int = 2) -> DataFrame:
    """AUC per (model, fold) with stratified folds; returns a small DataFrame.

    Each fold fits its preprocessing once and keeps one prepared training frame for all
    models, of the columns that they learn from.  Models of Spark ML are fitted ``parallelism`` folds at a time (as in
    ``CrossValidator(parallelism=...)``); the boosted trees of all folds grow side by side."""
    spark = closed.sparkSession
    folded = materialize(splits.with_folds(closed, label=label, k=k))
    sizes = {r["fold"]: r["n"] for r in folded.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
             .collect()}
    total = sum(sizes.values())

    def prepare(i: int):
        train = folded.filter(F.col("fold") != i)
        feats = fit_features(train)
        learned = [label, FEATURES_COL, *[f"idx__{c}" for c in feats.categorical], *[f"num__{c}" for c in feats.numeric]]
        return feats, feats.transform(train).select(*learned).persist(StorageLevel.MEMORY_AND_DISK), feats.transform(folded.filter(F.col("fold") == i))

    def scored(name: str, i: int, model) -> DataFrame:
        found = model.transform(prepared[i][2])
        return found.select(F.lit(name).alias("model"), F.lit(i).alias("fold"), label, vector_to_array(F.col("probability"))[1].alias("_score"))

    def by_estimator(job: tuple):
        name, i = job
        return build_models(total - sizes.get(i, 0), label)[name].fit(prepared[i][1])

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        prepared = list(pool.map(prepare, range(k)))
        try:
            own = [(n, i) for i in range(k) for n in names if n != BOOSTED]
            fitted = list(zip(own, pool.map(by_estimator, own)))
            if BOOSTED in names:
                grown = boosting.fit_many([(f, p) for f, p, _ in prepared], label)
                fitted += [((BOOSTED, i), m) for i, m in enumerate(grown)]
        finally:
            for _, kept, _ in prepared:
                kept.unpersist(blocking=False)
    if not fitted:
        return spark.createDataFrame([], "model string, fold int, auc double")
    both = reduce(DataFrame.unionByName, [scored(n, i, m) for (n, i), m in fitted])
    aucs = {(r["model"], r["fold"]): r["auc"] for r in M.auc_by(both, ["model", "fold"], label, "_score").collect()}
    return spark.createDataFrame([(n, i, aucs.get((n, i))) for (n, i), _ in fitted], "model string, fold int, auc double")


def cv_summary(cv: DataFrame) -> DataFrame:
    """Mean and population std of fold AUCs per model."""
    return (cv.groupBy("model")
            .agg(F.avg("auc").alias("cv_auc_mean"), F.stddev_pop("auc").alias("cv_auc_std")))


def select_model(summary_rows: list, order=MODEL_ORDER) -> str:
    """Arg-max mean AUC; the first model in ``order`` wins ties."""
    best, best_auc = None, None
    by_name = {r["model"]: r["cv_auc_mean"] for r in summary_rows}
    for name in order:
        a = by_name.get(name)
        if a is not None and (best_auc is None or a > best_auc):
            best, best_auc = name, a
    return best


def evaluate(scored: DataFrame, label: str = "target", score: str = "propensity_to_close") -> dict:
    """Holdout metrics from one by-score table: the test rows are scored once."""
    m = M.all_metrics(scored, label, score).first()
    return {"holdout_auc": m["auc"], "holdout_average_precision": m["average_precision"],
            "holdout_accuracy_at_0_5": m["accuracy"], "holdout_brier": m["brier"]}


def prediction_columns(rows: DataFrame, *extra: str, label: str = "target") -> DataFrame:
    """The holdout predictions' columns."""
    return rows.select("opportunity_id", "deal_stage", "sales_agent", "product", "account", "close_date",
                       F.col(label).alias("actual_won"), *extra)


def record_counts(mart: DataFrame, cutoff: dt.date | str | None = None, label: str = "target") -> DataFrame:
    """One row: the metrics' counts that need no model."""
    closed = splits.with_temporal(splits.closed_with_target(mart), cutoff)
    total = mart.select(F.count(F.lit(1))).scalar()
    found = closed.agg(F.count(F.lit(1)).alias("records_closed"), F.sum(label).alias("wins"),
                       F.count_if(F.col("split") == "train").alias("temporal_train_records"),
                       F.count_if(F.col("split") == "test").alias("temporal_test_records"))
    return found.select(total.alias("records_total"), "records_closed", "wins",
                        (F.col("records_closed") - F.col("wins")).alias("losses"),
                        F.try_divide(F.col("wins").cast("double"), F.col("records_closed")).alias("closed_win_rate"),
                        "temporal_train_records", "temporal_test_records")


def train_selected(mart: DataFrame, *, cutoff: dt.date | str | None = None,
                   names=MODEL_ORDER, label: str = "target"):
    """CV on all closed deals, select, fit on the stratified 75% split, evaluate
    on the 25% holdout, and refit for the temporal stress test.

    Returns (FittedModel, metrics dict, holdout predictions DataFrame).
    """
    closed = materialize(model_frame(mart))
    cv = cross_validate(closed, names, label=label)
    summary = cv_summary(cv).collect()
    selected = select_model(summary, names)

    split = materialize(splits.with_holdout(closed, label=label))
    train = split.filter(F.col("split") == "train")
    test = split.filter(F.col("split") == "test")
    temporal = splits.with_temporal(closed, cutoff)
    t_train = temporal.filter(F.col("split") == "train")
    t_test = temporal.filter(F.col("split") == "test")
    model, t_model = fit_each([train, t_train], selected, label)
    scored = model.score(test)
    predictions = prediction_columns(scored, "propensity_to_close", label=label)
    metrics = {
        **record_counts(mart, cutoff, label).first().asDict(),
        "selected_model": selected,
        **evaluate(scored, label),
        "temporal_q4_auc": _auc_value(t_model.score(t_test), label),
        "cross_validation": {r["model"]: {"cv_auc_mean": r["cv_auc_mean"],
                                          "cv_auc_std": r["cv_auc_std"]} for r in summary},
        "feature_policy": FEATURE_POLICY,
    }
    return model, metrics, predictions


def score_open_deals(model: FittedModel, mart: DataFrame) -> DataFrame:
    """Model propensity for every open deal (Prospecting + Engaging)."""
    from .scoring import open_deals
    feats = engagement_features(open_deals(mart))
    scored = model.score(feats)
    return scored.select(*mart.columns, "propensity_to_close")
