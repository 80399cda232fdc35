import os

from dealscope.plans import run

from .conftest import SF_SMALL


def test_end_to_end_without_training(spark, scratch):
    out = os.path.join(scratch, "out")
    run.main(["--sf", SF_SMALL, "--out", out, "--skip-train"])
    checks = spark.read.option("header", True).csv(os.path.join(out, "checks")).collect()
    assert len(checks) == 11 and all(r.passed == "true" for r in checks)
    summary = spark.read.option("header", True).csv(os.path.join(out, "analysis_summary"))
    assert summary.count() == 6
    for name in ("mart_opportunities", "stalled_deals", "funnel_conversion"):
        assert os.path.isdir(os.path.join(out, "warehouse", name))


def test_checks_that_fail(spark):
    import pytest

    from dealscope.operators import checks, scoring
    from dealscope.plans.queries import load_mart
    mart = load_mart(spark, SF_SMALL)
    scores = scoring.score_open_standin(mart)
    expected = checks.expected_counts(mart)

    def failing(m=mart, s=scores, e=expected):
        return {r.check for r in checks.mart_checks(m, s, e).where("NOT passed").collect()}

    from pyspark.sql import functions as F
    assert failing() == set()
    one = mart.where("deal_stage = 'Won'").limit(1)
    assert failing(mart.unionByName(one)) == {"row count equals expected", "opportunity ids are unique", "won count equals expected"}
    lost = mart.where("deal_stage = 'Lost'").limit(1).withColumn("opportunity_id", F.lit("new")).withColumn("engage_date", F.lit(None).cast("date"))
    assert failing(mart.unionByName(lost)) == {"row count equals expected", "lost count equals expected", "every closed loss has an engage date"}
    null_stage = mart.withColumn("deal_stage", F.when(F.col("opportunity_id") != mart.where("deal_stage = 'Prospecting'").first().opportunity_id, F.col("deal_stage")))
    assert "stage domain matches" in failing(null_stage)
    assert "all open deals scored" in failing(s=scores.limit(3))
    assert "propensity scores are bounded" in failing(s=scores.withColumn("propensity_to_close", F.lit(1.5)))
    assert "stalled-deal heuristic surfaces risk" in failing(s=scores.withColumn("stalled", F.lit(False)))
    assert "stall ratios are non-negative" in failing(s=scores.withColumn("stall_ratio", F.lit(-1.0)))
    with pytest.raises(checks.CheckFailed):
        checks.require(checks.mart_checks(mart.unionByName(one), scores, expected))
    rows = checks.model_checks({"selected_model": "a", "cross_validation": {"a": {"cv_auc_mean": 0.9}}}, "b")
    assert [ok for _, ok, _ in rows] == [False, False]
    with pytest.raises(checks.CheckFailed, match="selected model"):
        checks.require_models(rows)
