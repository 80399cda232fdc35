"""Training job: select and fit the propensity model, score and rank open
deals, explain the highest-risk ones, and write the artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import explain as explain_ops
from ..operators import models, scoring
from ..operators.mart import engagement_features
from ..operators.splits import with_holdout
from ..schemas import STAGE_ENGAGING, STALL_RULE, TOP_K_CONTRIBUTIONS, TOP_RISK_N
from ..session import materialize
from ..sources.sinks import save_bundle, write_metrics, write_table


def score_with_model(model, mart: DataFrame) -> DataFrame:
    """The 15-column score table for all open deals."""
    return scoring.score_open(models.score_open_deals(model, mart), mart)


def explain_top(model, scores: DataFrame, mart: DataFrame, n: int = TOP_RISK_N,
                k: int = TOP_K_CONTRIBUTIONS) -> DataFrame:
    """Top-k contributions for the n highest-risk deals, found by a semi-join on
    their n ids (adaptive execution broadcasts them if their bytes are few)."""
    ids = scoring.top_risk(scores, n).select("opportunity_id")
    rows = (engagement_features(scoring.open_deals(mart))
            .join(ids, "opportunity_id", "left_semi"))
    background = None
    if hasattr(model.estimator_model, "coefficients"):
        closed = with_holdout(models.model_frame(mart))
        background = closed.filter(F.col("split") == "train")
    return explain_ops.explain(model, rows, background=background, k=k)


def train_and_score(mart: DataFrame, out_dir: str, cutoff=None, n: int = TOP_RISK_N,
                    k: int = TOP_K_CONTRIBUTIONS) -> dict:
    spark = mart.sparkSession
    base = out_dir.rstrip("/")
    mart = materialize(mart)
    model, metrics, predictions = models.train_selected(mart, cutoff=cutoff)
    save_bundle(model, metrics, predictions, f"{base}/bundle")

    scores = materialize(score_with_model(model, mart))
    write_table(scores.orderBy(*scoring.risk_order()), f"{base}/open_deal_scores")
    write_table(explain_top(model, scores, mart, n, k), f"{base}/top_contributions")

    counts = scores.agg(F.count(F.lit(1)).alias("open"),
                        F.count_if(F.col("deal_stage") == STAGE_ENGAGING).alias("engaging"),
                        F.count_if(F.col("stalled")).alias("stalled")).first()
    metrics.update({"open_deals": counts["open"], "open_engaging_deals": counts["engaging"],
                    "stalled_deals": counts["stalled"], "stall_rule": STALL_RULE})
    write_metrics(spark, metrics, f"{base}/bundle/metrics")
    return metrics
