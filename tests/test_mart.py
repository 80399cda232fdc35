import pytest
from pyspark.sql import functions as F

from dealscope.operators.joins import DuplicateKeyError
from dealscope.plans.warehouse import mart_from_sources

from .fixtures import TEAMS_ROWS, sources


def _by_id(df):
    return {r.opportunity_id: r for r in df.collect()}


def test_mart_cleaning_and_enrichment(spark):
    mart = mart_from_sources(sources(spark))
    rows = _by_id(mart)
    assert len(rows) == 8
    # product recode joins the product dimension
    assert rows["o1"].product == "GTX Pro" and rows["o1"].series == "GTX"
    assert rows["o1"].sales_price == 4821.0
    # sector recode; NULL account stays unmatched
    assert rows["o1"].sector == "technology" and rows["o2"].sector is None
    # unknown rep has no team
    assert rows["o3"].manager is None
    # bad date -> NULL, bad number -> NULL, '12.5' as int rounds like the database
    assert rows["o4"].engage_date is None
    assert rows["o5"].revenue is None and rows["o1"].employees == 13
    # closed with NULL close date: closed, cycle unknown
    assert rows["o5"].is_closed == 1 and rows["o5"].cycle_days is None
    # NULL stage: not closed, won NULL
    assert rows["o6"].is_closed == 0 and rows["o6"].won is None
    assert rows["o1"].won == 1 and rows["o2"].won == 0 and rows["o3"].won is None
    assert rows["o1"].cycle_days == 40
    # data-driven snapshot = latest close date (2017-02-10)
    assert rows["o3"].days_in_stage == -19 and rows["o8"].days_in_stage == -233
    assert list(mart.columns)[:5] == ["opportunity_id", "sales_agent", "product", "account",
                                      "deal_stage"]


def test_fixed_snapshot(spark):
    mart = mart_from_sources(sources(spark), snapshot="2017-12-31")
    rows = _by_id(mart)
    assert rows["o3"].days_in_stage == 305 and rows["o1"].days_in_stage is None


def test_duplicate_dimension_key(spark):
    dup = sources(spark, teams=TEAMS_ROWS + [("Rep A", "Mgr 9", "North")])
    assert mart_from_sources(dup).count() == 8 + 4      # silent fan-out (SQL semantics)
    with pytest.raises(DuplicateKeyError):
        mart_from_sources(dup, validate=True).count()


def test_engagement_features(spark):
    from dealscope.operators.mart import engagement_features
    mart = engagement_features(mart_from_sources(sources(spark)))
    r = mart.filter(F.col("opportunity_id") == "o1").first()
    assert (r.engage_month, r.engage_dow, r.account_age) == (1, 6, 27)   # 2017-01-01 is a Sunday
