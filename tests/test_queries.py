"""Registered queries against the DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

from .conftest import SF_SMALL

FAST = ["mart_opportunities", "segment_norms", "stalled_deals", "stalled_deals_fallback",
        "funnel_conversion", "win_rate_by_rep", "cycle_summary_rollup", "cycle_distribution",
        "attrition", "risk_score", "deal_summary_text", "prompt_text", "top_risk", "key_findings",
        "holdout_split", "mart_text_sources", "fold_sizes", "model_counts", "holdout_labels", "portfolio_metrics",
        "funnel_counts", "deal_lookup", "contributions_linear", "auc_rank", "average_precision", "topk_contributions", "quality_checks"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    if v is None:
        return None
    return str(v)[:10] if type(v).__name__ == "date" else str(v)


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_rows_only():
    import __spark_entry__ as E
    from dealscope.plans.queries import ORACLE, QUERIES
    assert set(E.oracle_sql()) <= set(E.queries()) and set(QUERIES) <= set(E.queries())
    assert set(QUERIES) - set(ORACLE) == {"cv_summary", "holdout_predictions", "fit_and_score",
                                          "contributions_tree", "model_metrics"}


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert _canon(sdf.columns, srows) == _canon(dcols, drows)


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "stall_ratio" in df.columns
