from pyspark.sql import functions as F

from dealscope.operators import cycle, stall, winrate

from .fixtures import mart_rows


def _closed(prod, region, days, won=1):
    return dict(opportunity_id=f"c-{prod}-{region}-{days}-{won}", product=prod,
                regional_office=region, deal_stage="Won" if won else "Lost", is_closed=1,
                won=won, cycle_days=days)


def _open(oid, prod, region, days):
    return dict(opportunity_id=oid, product=prod, regional_office=region,
                deal_stage="Engaging", is_closed=0, days_in_stage=days)


def norms_edge(spark):
    rows = [_closed("A", "East", d) for d in (1, 2, 4, 9)]           # P75 5.25
    rows += [_closed("Z", "East", 0), _closed("Z", "East", 0)]       # P75 0
    rows += [_closed(None, "West", 10), _closed(None, "West", 30)]   # NULL product key
    rows += [_open("e1", "A", "East", 11), _open("e2", "Z", "East", 5),
             _open("e3", "B", "East", 40), _open("e4", None, "West", 50),
             _open("e5", "A", "East", 10)]
    return mart_rows(spark, rows)


def test_quantile_small(spark):
    m = norms_edge(spark)
    n = {(r.product, r.regional_office): r.historical_stage_norm_days
         for r in stall.segment_norms(m).collect()}
    assert n[("A", "East")] == 5.25 and n[("Z", "East")] == 0.0 and n[(None, "West")] == 25.0
    med = stall.segment_norms(m, quantile=0.5).filter(F.col("product") == "A").first()
    assert med.historical_stage_norm_days == 3.0


def test_strict_stalled(spark):
    out = {r.opportunity_id: r for r in stall.stalled_deals(norms_edge(spark)).collect()}
    assert out["e1"].stalled is True and abs(out["e1"].stall_ratio - 11 / 5.25) < 1e-12
    assert out["e5"].stalled is False
    assert out["e2"].stall_ratio is None and out["e2"].stalled is None     # zero norm
    assert out["e3"].historical_stage_norm_days is None                    # no segment
    assert out["e4"].historical_stage_norm_days is None                    # NULL key never matches


def test_fallback_stalled(spark):
    m = norms_edge(spark)
    out = {r.opportunity_id: r for r in stall.stalled_deals(m, fallback="overall").collect()}
    overall = sorted([1, 2, 4, 9, 0, 0, 10, 30])
    pos = (len(overall) - 1) * 0.75
    lo = overall[int(pos)]
    expected = lo + (overall[int(pos) + 1] - lo) * (pos - int(pos))
    assert out["e3"].historical_stage_norm_days == expected               # overall P75
    assert out["e4"].historical_stage_norm_days == 20.0 * 1.25            # NULL matches NULL
    assert out["e2"].stall_ratio is None and out["e2"].stalled is False
    assert all(r.stalled is not None for r in out.values())


def test_cycle_bands(spark):
    days = [30, 31, 60, 61, 90, 91, 120, 121, None]
    rows = [dict(opportunity_id=str(i), deal_stage="Won", is_closed=1, won=1, cycle_days=d)
            for i, d in enumerate(days)]
    m = mart_rows(spark, rows)
    got = {r.cycle_bucket: r.deals for r in cycle.cycle_distribution(m).collect()}
    assert got == {"0–30 days": 1, "31–60 days": 2, "61–90 days": 2, "91–120 days": 2,
                   "121+ days": 2}
    order = [r.cycle_bucket for r in cycle.cycle_distribution(m).collect()]
    assert order[0] == "0–30 days"
    nb = {r.cycle_bucket for r in cycle.cycle_distribution(m, null_band="unknown").collect()}
    assert "unknown" in nb


def test_cycle_summary_quantiles_and_rollup(spark):
    rows = [dict(opportunity_id=str(i), deal_stage="Won", is_closed=1, won=1, cycle_days=d)
            for i, d in enumerate([1, 2, 4, 9])]
    rows += [dict(opportunity_id="x", deal_stage="Lost", is_closed=1, won=0, cycle_days=3)]
    out = {r.outcome: r for r in cycle.cycle_summary(mart_rows(spark, rows), total=True).collect()}
    assert out["Won"].p75_cycle_days == 5.25 and out["Won"].median_cycle_days == 3.0
    assert out["Won"].avg_cycle_days == 4.0 and out["All closed"].deals == 5


def test_min_support(spark):
    rows = [dict(opportunity_id=f"a{i}", sales_agent="A", is_closed=1, won=i % 2, close_value=1.0,
                 deal_stage="Won") for i in range(24)]
    rows += [dict(opportunity_id=f"b{i}", sales_agent="B", is_closed=1, won=1, close_value=2.0,
                  deal_stage="Won") for i in range(25)]
    m = mart_rows(spark, rows)
    out = winrate.win_rate_by_rep(m).collect()
    assert [r.sales_agent for r in out] == ["B"] and out[0].won_revenue == 50.0
