"""Plan-shape checks and the warehouse pipeline on fixtures."""

import contextlib
import io

from pyspark.sql import functions as F

from dealscope.operators import splits, stall
from dealscope.plans.queries import load_mart
from dealscope.plans.warehouse import ANALYSES, build_warehouse

from .conftest import SF_SMALL
from .fixtures import sources


def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_warehouse_writes_every_table(spark, scratch):
    tables = build_warehouse(spark, sources(spark), scratch)
    assert set(tables) == {"mart_opportunities", *[n for n, _ in ANALYSES]}
    assert tables["mart_opportunities"].count() == 8
    assert tables["funnel_conversion"].count() == 4


def _without_broadcast(spark):
    return spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


def test_one_exchange_on_the_line_items_and_one_join_per_dimension(spark):
    from dealscope.sources.snapshots import snapshot_mart
    _without_broadcast(spark)
    try:
        mart = snapshot_mart(spark, SF_SMALL, snapshot="2001-12-31")
        tree = mart._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = tree.splitlines()
    scan = next(i for i, ln in enumerate(lines) if "l_orderkey" in ln and "FileScan" in ln)
    depth = lines[scan].index("FileScan")
    above, exchanges = depth, 0
    for ln in reversed(lines[:scan]):
        at = len(ln) - len(ln.lstrip(" :+-"))
        if at < above:
            above = at
            if "SortMergeJoin" in ln:
                break
            exchanges += "Exchange hashpartitioning" in ln
    assert exchanges == 1
    assert sum("FileScan" in ln and "c_custkey" in ln and "c_acctbal" in ln for ln in lines) == 1
    assert "CartesianProduct" not in tree


def test_line_items_are_read_once_for_all_marts(spark):
    """Subqueries included, no mart plan scans the line items: they read the stored orders."""
    from dealscope.plans.queries import release_marts
    from dealscope.sources import snapshots
    release_marts()
    orders = snapshots.stored_orders(spark, SF_SMALL)
    for kw in ({}, {"snapshot": "2001-12-31"}):
        mart = snapshots.snapshot_mart(spark, SF_SMALL, orders=orders, **kw)
        plan = mart._jdf.queryExecution().executedPlan().toString()
        assert "l_orderkey" not in plan and plan.count("o_orderpriority") > 0
    fact = snapshots.snapshot_sources(spark, SF_SMALL)["sales_pipeline"]
    assert "l_orderkey" not in fact._jdf.queryExecution().executedPlan().toString()
    once = snapshots.orders_with_lines(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in ln and "l_orderkey" in ln for ln in once.splitlines()) == 1
    assert snapshots.stored_orders(spark, SF_SMALL) is orders
    assert orders.exceptAll(snapshots.orders_with_lines(spark, SF_SMALL)).isEmpty()


def test_a_task_meets_a_bounded_number_of_orders_and_lines(spark, scratch, monkeypatch):
    """Partitions follow the rows: neither the session's number nor adaptive merging makes a task's share grow."""
    import datetime as dt
    from dealscope.sources import snapshots
    day = dt.datetime(2001, 1, 1)
    orders = [(k, k % 7, "F", 1.0, day, "1-URGENT") for k in range(200)] + [(None, 1, "F", 1.0, day, "1-URGENT")]
    lines = [(k % 200, k, -k, day + dt.timedelta(days=k % 5 - 1)) for k in range(800)] + [(None, 5, 5, day)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                  "o_orderdate timestamp, o_orderpriority string").write.parquet(f"{scratch}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_shipdate timestamp").write.parquet(
        f"{scratch}/lineitem.parquet")
    assert snapshots.order_partitions(spark, scratch) == 2
    monkeypatch.setattr(snapshots, "ROWS_PER_TASK", 50)
    assert snapshots.order_partitions(spark, scratch) == 21
    found = snapshots.orders_with_lines(spark, scratch)
    assert found.rdd.getNumPartitions() == 21
    tree = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in tree and "hashpartitioning(o_orderkey" in tree and "ENSURE_REQUIREMENTS" not in tree
    got = {r["o_orderkey"]: (r["first_partkey"], r["first_suppkey"], r["first_ship_day"]) for r in found.collect()}
    want = {}
    for k in range(200):
        mine = [x for x in lines if x[0] == k]
        days = [x[3].date() for x in mine if x[3] >= day]
        want[k] = (min(x[1] for x in mine), min(x[2] for x in mine), min(days, default=None))
    assert got == {**want, None: (None, None, None)}


def test_scratch_is_deleted_after_its_block(spark):
    import os
    from dealscope.session import ensure_checkpoint_dir, scratch, written
    base = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(base))
    with scratch(spark):
        kept = written(spark.range(10).toDF("n"), "trial")
        assert kept.count() == 10 and len(set(os.listdir(base)) - before) == 1
    assert set(os.listdir(base)) <= before


def test_snapshot_mart_equals_the_name_joins(spark):
    from dealscope.operators.mart import build_mart
    from dealscope.sources.snapshots import snapshot_mart, snapshot_sources
    src = snapshot_sources(spark, SF_SMALL)
    by_name = build_mart(src["sales_pipeline"], src["sales_teams"], src["products"], src["accounts"])
    by_key = snapshot_mart(spark, SF_SMALL)
    assert by_name.columns == by_key.columns
    assert by_name.exceptAll(by_key).isEmpty() and by_key.exceptAll(by_name).isEmpty()


def test_skewed_account_is_split_by_adaptive_execution(spark):
    fact = spark.range(200_000).selectExpr("if(id % 3 = 0, 7, id) AS k", "id AS v", "repeat('x', 40) AS pad")
    dim = spark.range(200_000).selectExpr("id AS k", "id * 2 AS w")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = fact.join(dim, "k", "left").groupBy("w").agg(F.count("v").alias("n"), F.max("pad"))
        assert sum(r.n for r in df.collect()) == 200_000
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_stalled_plan_has_no_cartesian_product(spark):
    assert "CartesianProduct" not in plan_text(stall.stalled_deals(load_mart(spark, SF_SMALL)))


def test_derived_tables_keep_their_order(spark):
    from dealscope.operators import cycle, funnel, winrate
    mart = load_mart(spark, SF_SMALL)

    def keys(df, key):
        return [key(r) for r in df.collect()]

    for df in (funnel.funnel_conversion(mart), ):
        assert keys(df, lambda r: r.stage_order) == [1, 2, 3, 4]
    assert keys(funnel.funnel_counts(mart), lambda r: r.step) == [1, 2, 3, 4]
    for df in (winrate.win_rate_by_rep(mart, min_closed=1), winrate.win_rate_by_segment(mart), winrate.win_rate_by_product(mart)):
        found = keys(df, lambda r: (-r.win_rate, -r.closed_deals))
        assert len(found) > 1 and found == sorted(found)
    names = keys(cycle.cycle_summary(mart), lambda r: r.outcome)
    assert names == sorted(names) and len(names) == 2
    bands = keys(cycle.cycle_distribution(mart), lambda r: cycle.CYCLE_LABELS.index(r.cycle_bucket))
    assert len(bands) > 2 and bands == sorted(bands)
    ratios = keys(stall.worst_first(stall.stalled_deals(mart)), lambda r: (r.stall_ratio is None, -(r.stall_ratio or 0), r.opportunity_id))
    assert len(ratios) > 10 and ratios == sorted(ratios)


def test_adapter_scan_reads_only_needed_columns(spark):
    from dealscope.sources.snapshots import pipeline_fact
    text = plan_text(pipeline_fact(spark, SF_SMALL))
    line_schema = [ln for ln in text.splitlines() if "ReadSchema" in ln and "l_orderkey" in ln]
    assert line_schema and all("l_extendedprice" not in ln for ln in line_schema)


def test_rank_windows_are_partitioned(spark):
    from dealscope.functions.columns import md5_hash32
    from dealscope.operators import ranking
    closed = splits.closed_with_target(load_mart(spark, SF_SMALL)) \
        .withColumn("_h", md5_hash32(F.col("opportunity_id"), 42))
    text = plan_text(ranking.rank_within(closed, ["target"], "_h", "opportunity_id"))
    assert "SinglePartition" not in text
    windows = [ln for ln in text.splitlines() if ln.strip().startswith("Arguments") and "_rng" in ln]
    assert windows, "row-grain window must be partitioned by label and hash range"


def test_top_risk_is_take_ordered(spark):
    from dealscope.operators import scoring
    scores = scoring.score_open_standin(load_mart(spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan_text(scoring.top_risk(scores, 100))
    assert scores.filter(F.col("stalled")).count() > 0


def test_aggregations_combine_map_side(spark):
    from dealscope.operators import cycle, winrate
    mart = load_mart(spark, SF_SMALL)
    assert "partial_count" in plan_text(winrate.win_rate_by_rep(mart))
    assert "partial_percentile" in plan_text(stall.segment_norms(mart))
    assert "partial_percentile_approx" in plan_text(cycle.cycle_summary(mart, approx_accuracy=10000))


def test_hot_key_results_stay_whole(spark):
    """One account/segment holding a third of the rows: results are complete."""
    from dealscope.operators import winrate
    from .fixtures import mart_rows
    rows = [dict(opportunity_id=f"h{i}", sales_agent="Hot", product="P", regional_office="R",
                 deal_stage="Won" if i % 3 else "Lost", is_closed=1, won=1 if i % 3 else 0,
                 cycle_days=i % 50, close_value=1.0) for i in range(3000)]
    rows += [dict(opportunity_id=f"c{i}", sales_agent=f"Rep{i % 40}", product=f"P{i % 7}",
                  regional_office="R", deal_stage="Won", is_closed=1, won=1, cycle_days=i % 90,
                  close_value=2.0) for i in range(6000)]
    m = mart_rows(spark, rows)
    out = {r.sales_agent: r for r in winrate.win_rate_by_rep(m).collect()}
    assert out["Hot"].closed_deals == 3000 and out["Hot"].won_deals == 2000
    assert sum(r.closed_deals for r in out.values()) == 9000
    norms = {r.product: r.historical_stage_norm_days for r in stall.segment_norms(m).collect()}
    vals = sorted(i % 50 for i in range(3000))
    pos = (len(vals) - 1) * 0.75
    exp = vals[int(pos)] + (vals[int(pos) + 1] - vals[int(pos)]) * (pos - int(pos))
    assert norms["P"] == exp
