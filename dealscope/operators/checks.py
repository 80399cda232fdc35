"""Data-quality checks, each a Spark aggregate; results as (check, passed, observed).

All mart-level checks share one aggregation pass; key uniqueness is one
extra grouped count.  Only the small check table ever reaches the driver.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fixed
from ..schemas import LEAKAGE_FIELDS, MODEL_FEATURES, OPEN_STAGES, STAGES


class CheckFailed(AssertionError):
    pass


def _row(name: str, passed: Column, observed: Column) -> Column:
    return F.struct(F.lit(name).alias("check"), passed.alias("passed"),
                    observed.cast("string").alias("observed"))


def expected_counts(pipeline: DataFrame) -> DataFrame:
    """One row (rows, wins, losses) from the source fact, before any join can repeat rows."""
    stage = F.col("deal_stage")
    return pipeline.agg(F.count(F.lit(1)).alias("rows"), F.count_if(stage == "Won").alias("wins"),
                        F.count_if(stage == "Lost").alias("losses"))


def mart_checks(mart: DataFrame, scores: DataFrame, expected: DataFrame) -> DataFrame:
    """``expected``: one row with ``rows``, ``wins``, ``losses`` computed
    independently from the source tables."""
    stage = F.col("deal_stage")
    m = mart.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(stage == "Won").alias("won"),
        F.count_if(stage == "Lost").alias("lost"),
        F.count_if(stage.isin(*OPEN_STAGES)).alias("open_n"),
        F.count_if(F.coalesce(~stage.isin(*STAGES), F.lit(True))).alias("unexpected"),
        *[F.count_if(stage == s).alias(f"has_{i}") for i, s in enumerate(STAGES)],
        F.count_if((stage == "Lost") & F.col("engage_date").isNull()).alias("lost_no_engage"))
    dup = (mart.groupBy("opportunity_id").count()
           .agg(F.count_if(F.col("count") > 1).alias("dup_keys")))
    s = scores.agg(
        F.count(F.lit(1)).alias("scored"),
        F.count_if(F.col("propensity_to_close").isNull()).alias("unscored"),
        F.min("propensity_to_close").alias("p_min"), F.max("propensity_to_close").alias("p_max"),
        F.count_if(F.col("stalled")).alias("flagged"),
        F.min("stall_ratio").alias("ratio_min"))
    missing = sum((F.col(f"has_{i}") == 0).cast("int") for i in range(len(STAGES)))
    leak = sorted(set(MODEL_FEATURES) & set(LEAKAGE_FIELDS))
    rows = F.array(
        _row("row count equals expected", F.col("n") == F.col("rows"),
             F.concat_ws(" / ", F.col("n").cast("string"), F.col("rows").cast("string"))),
        _row("opportunity ids are unique", F.col("dup_keys") == 0,
             F.concat(F.lit("duplicated keys: "), F.col("dup_keys").cast("string"))),
        _row("stage domain matches", (F.col("unexpected") == 0) & (missing == 0),
             F.concat(F.lit("unexpected: "), F.col("unexpected").cast("string"),
                      F.lit("; missing: "), missing.cast("string"))),
        _row("won count equals expected", F.col("won") == F.col("wins"),
             F.concat_ws(" / ", F.col("won").cast("string"), F.col("wins").cast("string"))),
        _row("lost count equals expected", F.col("lost") == F.col("losses"),
             F.concat_ws(" / ", F.col("lost").cast("string"), F.col("losses").cast("string"))),
        _row("outcome fields excluded from predictors", F.lit(not leak),
             F.lit(",".join(leak) or "none")),
        _row("all open deals scored", (F.col("scored") == F.col("open_n")) & (F.col("unscored") == 0),
             F.concat_ws(" / ", F.col("scored").cast("string"), F.col("open_n").cast("string"))),
        _row("propensity scores are bounded",
             F.coalesce((F.col("p_min") >= 0) & (F.col("p_max") <= 1), F.lit(False)),
             F.concat_ws(" .. ", fixed(F.col("p_min"), 3), fixed(F.col("p_max"), 3))),
        _row("stalled-deal heuristic surfaces risk", F.col("flagged") > 0,
             F.col("flagged").cast("string")),
        _row("stall ratios are non-negative", F.coalesce(F.col("ratio_min") >= 0, F.lit(True)),
             F.coalesce(fixed(F.col("ratio_min"), 3), F.lit("none"))),
        _row("every closed loss has an engage date", F.col("lost_no_engage") == 0,
             F.col("lost_no_engage").cast("string")))
    # The other one-row aggregates join the mart row as scalar subqueries.
    extra = [(dup, ["dup_keys"]), (s, s.columns), (expected, ["rows", "wins", "losses"])]
    cols = []
    for frame, names in extra:
        packed = frame.select(F.struct(*names)).scalar()
        cols += [packed[n].alias(n) for n in names]
    return m.select("*", *cols).select(F.inline(rows))


def model_checks(metrics: Mapping, model: str | None = None,
                 lo: float = 0.50, hi: float = 0.65) -> list[tuple[str, bool, str]]:
    """Checks on the metrics row: selected model and a plausible CV AUC."""
    out = []
    if model is not None:
        out.append(("selected model", metrics["selected_model"] == model,
                    str(metrics["selected_model"])))
    sel = metrics["selected_model"]
    cv = metrics["cross_validation"][sel]["cv_auc_mean"]
    out.append(("model AUC plausible and non-leaky", cv is not None and lo <= cv <= hi, str(cv)))
    return out


def require_models(rows: list[tuple[str, bool, str]]) -> None:
    """Fail fast on the model checks."""
    failed = [f"{name} ({observed})" for name, passed, observed in rows if not passed]
    if failed:
        raise CheckFailed("; ".join(failed))


def require(checks: DataFrame) -> None:
    """Fail fast: collect the (small) failed-check table and raise."""
    failed = checks.filter(~F.col("passed")).collect()
    if failed:
        raise CheckFailed("; ".join(f"{r.check} ({r.observed})" for r in failed))
