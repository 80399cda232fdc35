"""Registered queries: splits, metrics, preprocessing, contributions, checks.

Metric and contribution queries use deterministic stand-ins (an md5-bucket
score; per-feature least-squares slopes as linear weights) so that the SQL
oracle can recompute them without a fitted model.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks, explain, features, metrics, models, scoring, splits
from ..operators import mart as mart_ops
from ..schemas import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from ..sources.readers import read_table
from . import oracle as O
from .analytics_queries import SCORES_CTES
from .queries import load_mart, register

METRIC_SEED = 7
_NUM = list(NUMERIC_FEATURES)
_CAT = list(CATEGORICAL_FEATURES)

# ---------------------------------------------------------------- shared SQL
_PREP_CTES = """
feat AS (
    SELECT *, CAST(month(engage_date) AS INTEGER) AS engage_month,
           CAST(isodow(engage_date) - 1 AS INTEGER) AS engage_dow,
           CAST(year(engage_date) - year_established AS INTEGER) AS account_age
    FROM mart
),
closed AS (
    SELECT *, CASE WHEN deal_stage = 'Won' THEN 1 ELSE 0 END AS target,
           ('0x' || substr(md5(opportunity_id || '-42'), 1, 8))::BIGINT AS h
    FROM feat WHERE deal_stage IN ('Won', 'Lost')
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY target ORDER BY h, opportunity_id) - 1 AS rk,
           count(*) OVER (PARTITION BY target) AS n_c
    FROM closed
),
split AS (
    SELECT *, CASE WHEN rk < ceil(0.25 * n_c) THEN 'test' ELSE 'train' END AS split FROM ranked
),
scored AS (
    SELECT *, CAST(('0x' || substr(md5(opportunity_id || '-7'), 1, 8))::BIGINT % 1000 AS DOUBLE)
              / 1000.0 AS score
    FROM split WHERE split = 'test'
),
by_score AS (
    SELECT score, CAST(SUM(target) AS DOUBLE) AS pos, CAST(SUM(1 - target) AS DOUBLE) AS neg
    FROM scored GROUP BY score
)"""


def _numeric_ctes() -> str:
    med = ", ".join(f"quantile_cont(CAST({c} AS DOUBLE), 0.5) AS {c}" for c in _NUM)
    imp = ", ".join(f"COALESCE(CAST(f.{c} AS DOUBLE), m.{c}) AS {c}" for c in _NUM)
    mom = ", ".join(f"AVG({c}) AS {c}_mean, stddev_pop({c}) AS {c}_std" for c in _NUM)
    z = ", ".join(
        f"({c} - {c}_mean) / CASE WHEN {c}_std IS NULL OR {c}_std = 0 THEN 1 ELSE {c}_std END"
        f" AS num__{c}" for c in _NUM)
    wts = ", ".join(f"covar_pop(num__{c}, CAST(target AS DOUBLE)) AS {c}_w, AVG(num__{c}) AS {c}_m"
                    for c in _NUM)
    return f""",
med AS (SELECT {med} FROM split WHERE split = 'train'),
imp AS (
    SELECT f.opportunity_id, f.deal_stage, s.split, s.target, {imp}
    FROM feat f CROSS JOIN med m LEFT JOIN split s ON s.opportunity_id = f.opportunity_id
),
mom AS (SELECT {mom} FROM imp WHERE split = 'train'),
z AS (SELECT imp.opportunity_id, imp.deal_stage, imp.split, imp.target, {z} FROM imp CROSS JOIN mom),
wts AS (SELECT {wts} FROM z WHERE split = 'train'),
contrib AS (
""" + "\n    UNION ALL\n".join(
        f"    SELECT z.opportunity_id, 'num__{c}' AS feature, ROUND({c}_w * (num__{c} - {c}_m), 6)"
        f" AS shap_value FROM z CROSS JOIN wts WHERE z.deal_stage IN ('Prospecting', 'Engaging')"
        for c in _NUM) + "\n)"


_PREPARED: dict[tuple, tuple] = {}


def _prepared(spark, d):
    """Mart with engagement features and the closed deals with their holdout split, cached
    once per application and mart (a derived table that ten queries read); another mart of
    the same tables replaces it."""
    from pyspark import StorageLevel
    key = (spark.sparkContext.applicationId, d.rstrip("/"))
    base = load_mart(spark, d)
    hit = _PREPARED.get(key)
    if hit is None or hit[0] is not base:
        if hit is not None and hit[0].sparkSession is spark:
            hit[2].unpersist(blocking=False)
        mart = mart_ops.engagement_features(base)
        closed = (splits.with_holdout(splits.closed_with_target(mart))
                  .persist(StorageLevel.MEMORY_AND_DISK))
        hit = _PREPARED[key] = (base, mart, closed, {})
    return hit[1], hit[2]


def _fitted(spark, d, fit):
    """``fit()`` once per prepared mart: the stand-in scorer's constants, which three queries share."""
    _prepared(spark, d)
    memo = _PREPARED[spark.sparkContext.applicationId, d.rstrip("/")][3]
    if "standardized" not in memo:
        memo["standardized"] = fit()
    return memo["standardized"]


def release_prepared() -> None:
    """Drop every cached split and fitted constant."""
    while _PREPARED:
        _PREPARED.popitem()[1][2].unpersist(blocking=False)


def _scored_test(spark, d):
    _, closed = _prepared(spark, d)
    return (closed.filter(F.col("split") == "test")
            .withColumn("score", scoring.standin_propensity(F.col("opportunity_id"), METRIC_SEED)))


# ---------------------------------------------------------------- splits
@register("stratified_folds", O.with_mart_and(_PREP_CTES, """
SELECT opportunity_id, target, CAST(rk % 5 AS INTEGER) AS fold FROM ranked"""))
def q_folds(spark, d):
    mart = load_mart(spark, d)
    return (splits.with_folds(splits.closed_with_target(mart))
            .select("opportunity_id", "target", "fold"))


@register("holdout_split", O.with_mart_and(_PREP_CTES,
                                           "SELECT opportunity_id, target, split FROM split"))
def q_holdout(spark, d):
    _, closed = _prepared(spark, d)
    return closed.select("opportunity_id", "target", "split")


@register("temporal_split", O.with_mart_and(_PREP_CTES + """,
cut AS (
    SELECT DATE '1970-01-01' + CAST(floor(quantile_cont(
               date_diff('day', DATE '1970-01-01', close_date), 0.75)) AS INTEGER) AS d
    FROM closed
)""", """
SELECT opportunity_id, close_date, target,
       CASE WHEN close_date < (SELECT d FROM cut) THEN 'train'
            WHEN close_date >= (SELECT d FROM cut) THEN 'test' END AS split
FROM closed"""))
def q_temporal(spark, d):
    closed = splits.closed_with_target(load_mart(spark, d))
    return splits.with_temporal(closed).select("opportunity_id", "close_date", "target", "split")


# ---------------------------------------------------------------- metrics
@register("auc_rank", O.with_mart_and(_PREP_CTES + """,
cum AS (
    SELECT *, SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg
    FROM by_score
)""", "SELECT SUM(pos * (cum_neg - neg / 2.0)) / NULLIF(SUM(pos) * SUM(neg), 0) AS auc FROM cum"))
def q_auc(spark, d):
    return metrics.auc(_scored_test(spark, d), "target", "score")


@register("average_precision", O.with_mart_and(_PREP_CTES + """,
cum AS (
    SELECT *,
           SUM(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
           SUM(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_neg
    FROM by_score
)""", """
SELECT ROUND(SUM(pos * (cum_pos / (cum_pos + cum_neg))) / NULLIF(SUM(pos), 0), 10) AS average_precision
FROM cum"""))
def q_ap(spark, d):
    found = metrics.average_precision(_scored_test(spark, d), "target", "score")
    return found.select(F.round("average_precision", 10).alias("average_precision"))


@register("accuracy_brier", O.with_mart_and(_PREP_CTES, """
SELECT AVG(CASE WHEN (CASE WHEN score >= 0.5 THEN 1 ELSE 0 END) = target
                THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) AS accuracy,
       ROUND(AVG((score - target) * (score - target)), 10) AS brier
FROM scored"""))
def q_acc_brier(spark, d):
    found = metrics.accuracy_brier(_scored_test(spark, d), "target", "score")
    return found.select("accuracy", F.round("brier", 10).alias("brier"))


# ---------------------------------------------------------------- preprocessing
_MODE_SQL = ", ".join(f"mode() WITHIN GROUP (ORDER BY {c}) AS {c}" for c in _CAT)
_MEDIAN_SQL = ", ".join(f"ROUND(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS {c}" for c in _NUM)


@register("impute_mode", O.with_mart_and(_PREP_CTES,
                                         f"SELECT {_MODE_SQL} FROM split WHERE split = 'train'"))
def q_mode(spark, d):
    _, closed = _prepared(spark, d)
    return features.fit_modes(closed.filter(F.col("split") == "train"))


@register("impute_median", O.with_mart_and(_PREP_CTES,
                                           f"SELECT {_MEDIAN_SQL} FROM split WHERE split = 'train'"))
def q_median(spark, d):
    _, closed = _prepared(spark, d)
    med = features.fit_medians(closed.filter(F.col("split") == "train"))
    return med.select(*[F.round(c, 6).alias(c) for c in _NUM])


def _standardized(spark, d):
    return _fitted(spark, d, lambda: _fit_standardized(spark, d))


def _fit_standardized(spark, d):
    """All mart rows with train-fitted, imputed and standardised numerics, plus
    the fitted per-feature weights and means of the stand-in linear scorer."""
    mart, closed = _prepared(spark, d)
    train = closed.filter(F.col("split") == "train")
    med = features.medians(train)
    imputed_train = train.select("target", *features.impute_exprs({}, med))
    mom = features.fit_scaling(imputed_train).first()
    zcols = {c: features.scaled(c, mom[f"{c}__mean"], mom[f"{c}__std"]) for c in _NUM}
    # Closed deals carry split and target; the others get NULLs.  A union of
    # the two halves of the mart replaces a join back on opportunity_id.
    keep = ["opportunity_id", "deal_stage", *_NUM]
    others = (mart.filter(~F.col("deal_stage").isin("Won", "Lost") | F.col("deal_stage").isNull())
              .select(*keep, F.lit(None).cast("string").alias("split"),
                      F.lit(None).cast("int").alias("target")))
    labelled = closed.select(*keep, "split", "target").unionByName(others)
    z = labelled.select("opportunity_id", "deal_stage", "split", "target",
                        *[F.coalesce(F.col(c).cast("double"), F.lit(med[c])).alias(c) for c in _NUM])
    z = z.select("opportunity_id", "deal_stage", "split", "target",
                 *[zcols[c].alias(f"num__{c}") for c in _NUM])
    w = (z.filter(F.col("split") == "train")
         .agg(*[F.covar_pop(f"num__{c}", F.col("target").cast("double")).alias(f"{c}_w")
                for c in _NUM],
              *[F.avg(f"num__{c}").alias(f"{c}_m") for c in _NUM]).first())
    weights = {f"num__{c}": w[f"{c}_w"] for c in _NUM}
    means = {f"num__{c}": w[f"{c}_m"] for c in _NUM}
    return z, weights, means


@register("scale_numeric", O.with_mart_and(_PREP_CTES + _numeric_ctes(),
          "SELECT opportunity_id, " + ", ".join(f"ROUND(num__{c}, 6) AS num__{c}" for c in _NUM)
          + " FROM z"))
def q_scale(spark, d):
    z, _, _ = _standardized(spark, d)
    return z.select("opportunity_id", *[F.round(f"num__{c}", 6).alias(f"num__{c}") for c in _NUM])


def _open_terms(spark, d):
    z, weights, means = _standardized(spark, d)
    open_z = z.filter(F.col("deal_stage").isin("Prospecting", "Engaging"))
    terms = explain.linear_terms(weights, means, {k: k for k in weights}, digits=6)
    return open_z, terms


@register("contributions_linear", O.with_mart_and(_PREP_CTES + _numeric_ctes(),
                                                  "SELECT * FROM contrib"))
def q_contrib(spark, d):
    open_z, terms = _open_terms(spark, d)
    return explain.contributions_long(open_z, terms)


@register("topk_contributions", O.with_mart_and(_PREP_CTES + _numeric_ctes(), """
SELECT opportunity_id, feature, CAST(NULL AS VARCHAR) AS feature_value, shap_value,
       CASE WHEN shap_value > 0 THEN 'raises score' ELSE 'lowers score' END AS direction,
       CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY opportunity_id
                                   ORDER BY abs(shap_value) DESC, feature) AS rank
      FROM contrib)
WHERE rank <= 3"""))
def q_topk(spark, d):
    open_z, terms = _open_terms(spark, d)
    return explain.top_contributions(open_z, terms, k=3)


# ---------------------------------------------------------------- quality checks
def _expected(spark, d):
    o = read_table(spark, d, "orders")
    top = F.substring("o_orderpriority", 1, 1).isin("1", "2", "3")
    fin = F.col("o_orderstatus") == "F"
    return o.agg(F.count(F.lit(1)).alias("rows"), F.count_if(fin & top).alias("wins"),
                 (F.count_if(fin) - F.count_if(fin & top)).alias("losses"))


def _check_sql() -> str:
    rows = [
        ("row count equals expected", "n = rows", "CAST(n AS VARCHAR) || ' / ' || CAST(rows AS VARCHAR)"),
        ("opportunity ids are unique", "dup_keys = 0", "'duplicated keys: ' || CAST(dup_keys AS VARCHAR)"),
        ("stage domain matches", "unexpected = 0 AND missing = 0",
         "'unexpected: ' || CAST(unexpected AS VARCHAR) || '; missing: ' || CAST(missing AS VARCHAR)"),
        ("won count equals expected", "won = wins", "CAST(won AS VARCHAR) || ' / ' || CAST(wins AS VARCHAR)"),
        ("lost count equals expected", "lost = losses",
         "CAST(lost AS VARCHAR) || ' / ' || CAST(losses AS VARCHAR)"),
        ("outcome fields excluded from predictors", "true", "'none'"),
        ("all open deals scored", "scored = open_n AND unscored = 0",
         "CAST(scored AS VARCHAR) || ' / ' || CAST(open_n AS VARCHAR)"),
        ("propensity scores are bounded", "COALESCE(p_min >= 0 AND p_max <= 1, false)",
         "printf('%.3f', p_min) || ' .. ' || printf('%.3f', p_max)"),
        ("stalled-deal heuristic surfaces risk", "flagged > 0", "CAST(flagged AS VARCHAR)"),
        ("stall ratios are non-negative", "COALESCE(ratio_min >= 0, true)",
         "COALESCE(printf('%.3f', ratio_min), 'none')"),
        ("every closed loss has an engage date", "lost_no_engage = 0", "CAST(lost_no_engage AS VARCHAR)"),
    ]
    body = "\nUNION ALL\n".join(
        f"SELECT '{n}' AS \"check\", ({p}) AS passed, ({o}) AS observed FROM stats"
        for n, p, o in rows)
    return O.with_mart_and(SCORES_CTES + """,
m AS (
    SELECT COUNT(*) AS n,
           COUNT(*) FILTER (WHERE deal_stage = 'Won') AS won,
           COUNT(*) FILTER (WHERE deal_stage = 'Lost') AS lost,
           COUNT(*) FILTER (WHERE deal_stage IN ('Prospecting', 'Engaging')) AS open_n,
           COUNT(*) FILTER (WHERE deal_stage IS NULL
                            OR deal_stage NOT IN ('Prospecting', 'Engaging', 'Won', 'Lost')) AS unexpected,
           (CASE WHEN COUNT(*) FILTER (WHERE deal_stage = 'Prospecting') = 0 THEN 1 ELSE 0 END
            + CASE WHEN COUNT(*) FILTER (WHERE deal_stage = 'Engaging') = 0 THEN 1 ELSE 0 END
            + CASE WHEN COUNT(*) FILTER (WHERE deal_stage = 'Won') = 0 THEN 1 ELSE 0 END
            + CASE WHEN COUNT(*) FILTER (WHERE deal_stage = 'Lost') = 0 THEN 1 ELSE 0 END) AS missing,
           COUNT(*) FILTER (WHERE deal_stage = 'Lost' AND engage_date IS NULL) AS lost_no_engage
    FROM mart
),
dup AS (SELECT COUNT(*) AS dup_keys FROM (SELECT opportunity_id FROM mart GROUP BY 1 HAVING COUNT(*) > 1)),
sc AS (
    SELECT COUNT(*) AS scored, COUNT(*) FILTER (WHERE propensity_to_close IS NULL) AS unscored,
           MIN(propensity_to_close) AS p_min, MAX(propensity_to_close) AS p_max,
           COUNT(*) FILTER (WHERE stalled) AS flagged, MIN(stall_ratio) AS ratio_min
    FROM scores
),
ex AS (
    SELECT COUNT(*) AS rows,
           COUNT(*) FILTER (WHERE o_orderstatus = 'F' AND substr(o_orderpriority, 1, 1) IN ('1', '2', '3')) AS wins,
           COUNT(*) FILTER (WHERE o_orderstatus = 'F')
             - COUNT(*) FILTER (WHERE o_orderstatus = 'F' AND substr(o_orderpriority, 1, 1) IN ('1', '2', '3')) AS losses
    FROM orders
),
stats AS (SELECT * FROM m, dup, sc, ex)""", body)


@register("quality_checks", _check_sql())
def q_checks(spark, d):
    mart = load_mart(spark, d)
    scores = scoring.score_open_standin(mart)
    return checks.mart_checks(mart, scores, _expected(spark, d))


# ---------------------------------------------------------------- fitted models
# Learned numbers are rows-only; what does not depend on them has an oracle of its own.
def _train_split(spark, d):
    from ..session import materialize
    mart = materialize(load_mart(spark, d))
    split = materialize(splits.with_holdout(models.model_frame(mart)))
    return mart, split


def _names_sql() -> str:
    """Sorted levels of the training rows per categorical (the mode stands in for NULL), then the numerics."""
    levels = " UNION ALL ".join(
        f"SELECT {k} AS block, {c} AS level, 'cat__{c}_' || {c} AS feature FROM split WHERE split = 'train' AND {c} IS NOT NULL GROUP BY ALL"
        for k, c in enumerate(_CAT))
    numbers = " UNION ALL ".join(f"SELECT {len(_CAT) + k}, '', 'num__{c}'" for k, c in enumerate(_NUM))
    return O.with_mart_and(_PREP_CTES, f"""
SELECT (row_number() OVER (ORDER BY block, level) - 1)::INTEGER AS position, feature FROM ({levels} UNION ALL {numbers})""")


@register("feature_names", _names_sql())
def q_feature_names(spark, d):
    from ..sources.sinks import feature_names_frame
    _, split = _train_split(spark, d)
    feats = features.fit_features(split.filter(F.col("split") == "train"))
    return feature_names_frame(spark, feats.feature_names())


@register("fold_sizes", O.with_mart_and(_PREP_CTES, """
SELECT (rk % 5)::INTEGER AS fold, target, count(*) AS deals FROM ranked GROUP BY ALL"""))
def q_fold_sizes(spark, d):
    folded = splits.with_folds(splits.closed_with_target(load_mart(spark, d)))
    return folded.groupBy("fold", "target").agg(F.count(F.lit(1)).alias("deals"))


@register("model_counts", O.with_mart_and(_PREP_CTES + """,
cut AS (SELECT DATE '1970-01-01' + CAST(floor(quantile_cont(
            date_diff('day', DATE '1970-01-01', close_date), 0.75)) AS INTEGER) AS d FROM closed)""", """
SELECT (SELECT count(*) FROM mart) AS records_total, count(*) AS records_closed, sum(target)::BIGINT AS wins,
       count(*) - wins AS losses, wins / count(*)::DOUBLE AS closed_win_rate,
       count_if(close_date < (SELECT d FROM cut))::BIGINT AS temporal_train_records,
       count_if(close_date >= (SELECT d FROM cut))::BIGINT AS temporal_test_records
FROM closed"""))
def q_model_counts(spark, d):
    return models.record_counts(load_mart(spark, d))


@register("holdout_labels", O.with_mart_and(_PREP_CTES, """
SELECT opportunity_id, deal_stage, sales_agent, product, account, close_date, target AS actual_won
FROM split WHERE split = 'test'"""))
def q_holdout_labels(spark, d):
    """The holdout predictions' table without the learned column."""
    _, closed = _prepared(spark, d)
    return models.prediction_columns(closed.filter(F.col("split") == "test"))


@register("cv_summary")
def q_cv_summary(spark, d):
    from ..session import materialize
    closed = materialize(models.model_frame(load_mart(spark, d)))
    return models.cv_summary(models.cross_validate(closed))


@register("holdout_predictions")
def q_holdout_predictions(spark, d):
    _, split = _train_split(spark, d)
    model = models.fit(split.filter(F.col("split") == "train"), models.LOGISTIC)
    test = split.filter(F.col("split") == "test")
    return models.prediction_columns(model.score(test), "propensity_to_close")


@register("fit_and_score")
def q_fit_and_score(spark, d):
    from .training import score_with_model
    mart, split = _train_split(spark, d)
    model = models.fit(split.filter(F.col("split") == "train"), models.LOGISTIC)
    return score_with_model(model, mart)


@register("contributions_tree")
def q_contributions_tree(spark, d):
    from ..session import materialize
    from .training import explain_top, score_with_model
    mart, split = _train_split(spark, d)
    model = models.fit(split.filter(F.col("split") == "train"), models.BOOSTED)
    scores = materialize(score_with_model(model, mart))
    return explain_top(model, scores, mart, 100, 3)


@register("model_metrics")
def q_model_metrics(spark, d):
    from ..session import materialize
    from ..sources.sinks import metrics_frame
    mart = materialize(load_mart(spark, d))
    _, metrics, _ = models.train_selected(mart)
    return metrics_frame(spark, metrics)
