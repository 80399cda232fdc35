"""Registered queries: joins over time, sessions, streams, cubes, sketches, hierarchies, snapshot changes, samples."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import funnel_events, rollup, sampling, snapshots_diff, temporal
from ..operators import mart as mart_ops
from ..session import ensure_checkpoint_dir, keep_track
from ..sources.readers import read_source, read_table
from ..sources.sinks import write_csv, write_table
from ..streaming import events as streams
from . import oracle as O
from .queries import load_mart, register

SESSION_GAP_HOURS = 6
TRAILING_DAYS = 7
FUNNEL_DAYS = 7
NORM_MAX_AGE_DAYS = 400
SNAPSHOTS = ("1996-12-31", "1997-12-31")
ARCHIVE_DAYS = 365
SAMPLE_PER_REGION = 50
_HOUR = 3_600_000_000
_DAY = temporal.DAY_MICROS


# ---------------------------------------------------------------- as-of joins
@register("price_as_of", O.with_mart_and("""
shipped AS (
    SELECT p_type AS product, l_shipdate::DATE AS priced_on, max(l_extendedprice / l_quantity) AS unit_price
    FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY ALL)""", """
SELECT opportunity_id, mart.product, engage_date, priced_on, unit_price
FROM mart ASOF LEFT JOIN shipped ON shipped.product = mart.product AND shipped.priced_on <= mart.engage_date"""))
def q_price_as_of(spark, d):
    """Each deal's last known unit price of its product at its engage date."""
    part = read_table(spark, d, "part").select("p_partkey", F.col("p_type").alias("product"))
    lines = read_table(spark, d, "lineitem").select("l_partkey", F.to_date("l_shipdate").alias("priced_on"),
                                                    (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"))
    prices = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).groupBy("product", "priced_on").agg(F.max("unit_price").alias("unit_price"))
    deals = load_mart(spark, d).select("opportunity_id", "product", "engage_date")
    return temporal.asof_join(deals, prices, ["product"], "engage_date", "priced_on", ["unit_price"])


@register("norm_as_of", O.with_mart_and(f"""
monthly AS (
    SELECT product, regional_office, (date_trunc('month', close_date) + INTERVAL 1 MONTH)::DATE AS known_from,
           quantile_cont(cycle_days, 0.75) AS norm_days, count(*) AS deals
    FROM mart WHERE is_closed = 1 AND cycle_days IS NOT NULL GROUP BY ALL)""", f"""
SELECT opportunity_id, m.product, m.regional_office, engage_date, if(fresh, known_from, NULL) AS known_from, if(fresh, norm_days, NULL) AS norm_days, if(fresh, deals, NULL) AS deals
FROM (SELECT mart.*, known_from, norm_days, deals, known_from + {NORM_MAX_AGE_DAYS} >= engage_date AS fresh
      FROM mart ASOF LEFT JOIN monthly ON monthly.product = mart.product AND monthly.regional_office = mart.regional_office
                                      AND monthly.known_from <= mart.engage_date) m
WHERE deal_stage = 'Engaging'"""))
def q_norm_as_of(spark, d):
    """The duration norm of a deal's segment that was known when it was engaged: last month's, if not too old."""
    mart = load_mart(spark, d)
    known_from = F.add_months(F.trunc("close_date", "month"), 1).alias("known_from")
    monthly = (mart.where((F.col("is_closed") == 1) & F.col("cycle_days").isNotNull()).groupBy("product", "regional_office", known_from)
               .agg(F.percentile("cycle_days", 0.75).alias("norm_days"), F.count(F.lit(1)).alias("deals")))
    deals = mart.where("deal_stage = 'Engaging'").select("opportunity_id", "product", "regional_office", "engage_date")
    return temporal.asof_join(deals, monthly, ["product", "regional_office"], "engage_date", "known_from", ["norm_days", "deals"],
                              max_age_days=NORM_MAX_AGE_DAYS)


# ---------------------------------------------------------------- intervals
_SPANS = """
spans AS (
    SELECT opportunity_id, sales_agent, engage_date - DATE '1970-01-01' AS from_day, close_date - DATE '1970-01-01' AS to_day
    FROM mart WHERE is_closed = 1 AND engage_date < close_date AND sales_agent IS NOT NULL)"""


def _spans(spark, d):
    return (load_mart(spark, d).where("is_closed = 1")
            .select("opportunity_id", "sales_agent", F.unix_date("engage_date").alias("from_day"), F.unix_date("close_date").alias("to_day")))


@register("concurrent_deals", O.with_mart_and(_SPANS, """
SELECT a.opportunity_id, a.sales_agent, count(*) AS others, sum(least(a.to_day, b.to_day) - greatest(a.from_day, b.from_day))::BIGINT AS shared_days
FROM spans a JOIN spans b ON a.sales_agent = b.sales_agent AND a.opportunity_id <> b.opportunity_id AND a.from_day < b.to_day AND b.from_day < a.to_day
GROUP BY ALL"""))
def q_concurrent(spark, d):
    """For each closed deal the rep's other deals open at the same time, and the days shared with them."""
    spans = _spans(spark, d)
    pairs = temporal.overlap_join(spans, spans, ["sales_agent"], ("from_day", "to_day")).where("l.opportunity_id <> r.opportunity_id")
    return pairs.groupBy("l.opportunity_id", "l.sales_agent").agg(
        F.count(F.lit(1)).alias("others"), F.sum(F.col("to_") - F.col("from_")).cast("bigint").alias("shared_days"))


@register("peak_open_deals", O.with_mart_and(_SPANS + """,
steps AS (SELECT sales_agent, day, sum(step) AS step FROM (SELECT sales_agent, from_day AS day, 1 AS step FROM spans UNION ALL SELECT sales_agent, to_day, -1 FROM spans) GROUP BY ALL),
running AS (SELECT *, sum(step) OVER (PARTITION BY sales_agent ORDER BY day) AS open_deals FROM steps)""", """
SELECT sales_agent, max(open_deals)::BIGINT AS peak, arg_max(day, (open_deals, -day))::BIGINT AS peak_start FROM running GROUP BY sales_agent"""))
def q_peak(spark, d):
    found = temporal.peak_overlap(_spans(spark, d), ["sales_agent"], ("from_day", "to_day"))
    return found.select("sales_agent", "peak", F.col("peak_start").cast("bigint").alias("peak_start"))


# ---------------------------------------------------------------- events
def _events(spark, d):
    return read_table(spark, d, "events").withColumn("at", temporal.micros("ts"))


@register("event_sessions", f"""
WITH marked AS (
    SELECT *, epoch_us(ts) AS us, coalesce(epoch_us(ts) - lag(epoch_us(ts)) OVER w > {SESSION_GAP_HOURS * _HOUR}, true)::INT AS opens
    FROM events WHERE ts IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session FROM marked)
SELECT user_id, session::BIGINT AS session, min(us) AS first_at, max(us) AS last_at, count(*) AS n,
       count_if(event_type = 'purchase') AS purchases, round(sum(value), 4) AS value
FROM numbered GROUP BY user_id, session""")
def q_sessions(spark, d):
    values = {"purchases": F.count_if(F.col("event_type") == "purchase"), "value": F.round(F.sum("value"), 4)}
    return temporal.sessions(_events(spark, d), "user_id", "at", SESSION_GAP_HOURS * _HOUR, ["event_id"], values)


@register("event_trailing_week", f"""
SELECT event_id, user_id, count(*) OVER w AS week_n, round(sum(value) OVER w, 4) AS week_value, max(value) OVER w AS week_max
FROM events WHERE ts IS NOT NULL
WINDOW w AS (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL {TRAILING_DAYS} DAYS PRECEDING AND CURRENT ROW)""")
def q_trailing(spark, d):
    values = {"week_n": F.count(F.lit(1)), "week_value": F.sum("value"), "week_max": F.max("value")}
    found = temporal.trailing(_events(spark, d), "user_id", "at", TRAILING_DAYS * _DAY, values)
    return found.select("event_id", "user_id", "week_n", F.round("week_value", 4).alias("week_value"), "week_max")


@register("event_funnel", f"""
WITH steps AS (SELECT user_id, event_type, epoch_us(ts) AS at, event_id FROM events WHERE ts IS NOT NULL),
seen AS (
    SELECT v.user_id, v.event_id, count(c.event_id) > 0 AS clicked, count(p.event_id) > 0 AS bought
    FROM (SELECT * FROM steps WHERE event_type = 'view') v
    LEFT JOIN steps c ON c.user_id = v.user_id AND c.event_type = 'click' AND (c.at, c.event_id) > (v.at, v.event_id) AND c.at - v.at <= {FUNNEL_DAYS * _DAY}
    LEFT JOIN steps p ON p.user_id = v.user_id AND p.event_type = 'purchase' AND (p.at, p.event_id) > (c.at, c.event_id) AND p.at - v.at <= {FUNNEL_DAYS * _DAY}
    GROUP BY ALL),
users AS (SELECT user_id, bool_or(clicked) AS clicked, bool_or(bought) AS bought FROM seen GROUP BY user_id)
SELECT position::INTEGER AS position, step, users, users / nullif(max(users) OVER (), 0)::DOUBLE AS share
FROM (SELECT unnest([1, 2, 3]) AS position, unnest(['view', 'click', 'purchase']) AS step,
             unnest([count(*), count_if(clicked), count_if(bought)]) AS users FROM users)""")
def q_event_funnel(spark, d):
    """Users that viewed, then clicked, then bought, all within a week of the view."""
    reached = funnel_events.furthest_step(_events(spark, d), "user_id", "at", "event_type", FUNNEL_DAYS * _DAY, order=["event_id"])
    return funnel_events.step_counts(reached)


def _streamed(spark, d, build):
    """Run a stream over the table's files into a folder of its own; windows still open at the end are not in it."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    keep_track(spark, base)
    schema = spark.read.parquet(f"{d.rstrip('/')}/events.parquet").schema
    result = build(streams.event_stream(spark, f"{d.rstrip('/')}/event[s].parquet", schema))
    streams.drain(result, f"{base}/sink", f"{base}/state")
    return spark.read.schema(result.schema).parquet(f"{base}/sink")


@register("stream_daily_counts", """
SELECT event_type, strftime(day, '%Y-%m-%d %H:%M:%S.%f') AS window_start, strftime(day + INTERVAL 1 DAY, '%Y-%m-%d %H:%M:%S.%f') AS window_end, n, value
FROM (SELECT event_type, date_trunc('day', ts)::TIMESTAMP AS day, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL)
WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 HOURS FROM events)""")
def q_stream_daily(spark, d):
    return _streamed(spark, d, lambda events: streams.tumbling(events, "1 day", "2 hours"))


@register("stream_sessions", f"""
WITH marked AS (
    SELECT *, coalesce(ts - lag(ts) OVER w >= INTERVAL {SESSION_GAP_HOURS} HOURS, true)::INT AS opens FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM marked)
SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS window_start,
       strftime(max(ts) + INTERVAL {SESSION_GAP_HOURS} HOURS, '%Y-%m-%d %H:%M:%S.%f') AS window_end, count(*) AS n, round(sum(value), 4) AS value
FROM numbered GROUP BY user_id, session
HAVING max(ts) + INTERVAL {SESSION_GAP_HOURS} HOURS <= (SELECT max(ts) - INTERVAL 2 HOURS FROM events)""")
def q_stream_sessions(spark, d):
    return _streamed(spark, d, lambda events: streams.session_windows(events, f"{SESSION_GAP_HOURS} hours", "2 hours"))


# ---------------------------------------------------------------- sinks, read back
_ROUND_TRIP = ("opportunity_id", "sales_agent", "product", "account", "deal_stage", "engage_date", "close_date", "close_value")


@register("table_round_trip", O.with_mart(f"SELECT {', '.join(_ROUND_TRIP)}, cycle_days FROM mart"))
def q_table_round_trip(spark, d):
    """The mart as a derived table, replaced once (the first content must be gone), partitioned by stage and read back."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4().hex}"
    keep_track(spark, path)
    mart = load_mart(spark, d).select(*_ROUND_TRIP, "cycle_days")
    write_table(mart.limit(0), path)
    write_table(mart, path, partition_by=["deal_stage"])
    return spark.read.parquet(path).select(*mart.columns)


@register("csv_round_trip", O.with_mart(f"SELECT {', '.join(_ROUND_TRIP)} FROM mart"))
def q_csv_round_trip(spark, d):
    """The fact as a CSV table with quoted names, read back by its header and typed again."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    keep_track(spark, path)
    fact = load_mart(spark, d).select(*reversed(_ROUND_TRIP))       # another column order: the header counts
    quoted = F.concat(F.lit('"'), F.col("product"), F.lit('", "'), F.col("product"))
    write_csv(fact.withColumn("product", quoted), path)
    back = read_source(spark, "sales_pipeline", path, "csv")
    typed = back.select("opportunity_id", "sales_agent", "product", "account", "deal_stage", *mart_ops.typed_fact(back)[-3:])
    return typed.withColumn("product", F.regexp_extract("product", '^"(.*)", "\\1$', 1))


# ---------------------------------------------------------------- roll-ups
@register("outcome_cube", O.with_mart("""
SELECT grouping(regional_office, product, sector)::BIGINT AS level, regional_office, product, sector, count(*) AS deals, count_if(won = 1) AS won,
       count_if(won = 1) / count(*)::DOUBLE AS win_rate, count(DISTINCT account) AS accounts
FROM mart WHERE is_closed = 1 GROUP BY CUBE (regional_office, product, sector)"""))
def q_cube(spark, d):
    return rollup.outcome_cube(load_mart(spark, d))


@register("sketch_rollup", O.with_mart("""
SELECT regional_office, count(*) AS n, count(DISTINCT account)::BIGINT AS accounts,
       true AS accounts_within, true AS quartiles_within
FROM mart WHERE is_closed = 1 GROUP BY regional_office"""))
def q_sketches(spark, d):
    """Sketches per month and region merged per region, held against exact values: accounts within 5 %, quartiles
    of the cycle within ranks 5 points off."""
    deals = load_mart(spark, d).where("is_closed = 1").withColumn("month", F.trunc("close_date", "month"))
    monthly = rollup.sketch_table(deals, ["month", "regional_office"], "account", "cycle_days")
    merged = rollup.sketch_estimates(rollup.merge_sketches(monthly, ["regional_office"]), ["regional_office"])
    quartiles = ((0.25, "measure_p25"), (0.5, "measure_p50"), (0.75, "measure_p75"))
    exact = deals.groupBy(F.col("regional_office").alias("_region")).agg(
        F.count_distinct("account").alias("accounts"),
        *[F.percentile("cycle_days", q + side).alias(f"{name}_{edge}") for q, name in quartiles for side, edge in ((-0.05, "low"), (0.05, "high"))])
    near = F.lit(True)
    for _, name in quartiles:
        near &= F.coalesce(F.col(name).between(F.col(f"{name}_low"), F.col(f"{name}_high")), F.col(name).isNull() & F.col(f"{name}_low").isNull())
    close = (F.abs(F.col("members") - F.col("accounts")) <= 0.05 * F.col("accounts")) & (F.abs(F.col("members_hll") - F.col("accounts")) <= 0.05 * F.col("accounts"))
    return merged.join(exact, F.col("regional_office").eqNullSafe(F.col("_region"))).select(
        "regional_office", "n", F.col("accounts").cast("bigint").alias("accounts"), close.alias("accounts_within"), near.alias("quartiles_within"))


@register("account_groups", """
WITH RECURSIVE link AS (SELECT c_custkey AS child, if(c_custkey % 10 = 0, NULL, c_custkey // 3) AS parent FROM customer),
node AS (SELECT child, parent FROM link UNION ALL SELECT DISTINCT parent, NULL FROM link WHERE parent IS NOT NULL AND parent NOT IN (SELECT child FROM link)),
tree AS (SELECT child, child AS root, 0 AS depth FROM node WHERE parent IS NULL
         UNION ALL SELECT node.child, root, depth + 1 FROM node JOIN tree ON node.parent = tree.child),
spent AS (SELECT o_custkey, count(*) AS orders, sum(o_totalprice) AS value FROM orders GROUP BY o_custkey)
SELECT root, count(*) AS members, max(depth)::BIGINT AS deepest, sum(orders)::BIGINT AS orders, round(sum(value), 2) AS value
FROM tree LEFT JOIN spent ON o_custkey = child GROUP BY root""")
def q_account_groups(spark, d):
    """Orders rolled up to the top account of each group; parents are derived from the customer keys."""
    key = F.col("c_custkey")
    links = read_table(spark, d, "customer").select(key.alias("child"), F.when(key % 10 != 0, F.floor(key / 3)).alias("parent"))
    orders = read_table(spark, d, "orders").select(F.col("o_custkey").alias("child"), F.lit(1).alias("orders"), F.col("o_totalprice").alias("value"))
    totals = rollup.subtree_totals(links, orders, ["orders", "value"])
    return totals.select("root", "members", "deepest", "orders", F.round("value", 2).alias("value"))


# ---------------------------------------------------------------- snapshots and samples
def _state_sql(name: str, day: str) -> str:
    return f"""
{name} AS (
    SELECT opportunity_id, if(close_date <= DATE '{day}', deal_stage, 'Engaging') AS stage, if(close_date <= DATE '{day}', close_value, NULL) AS close_value
    FROM mart WHERE engage_date <= DATE '{day}' AND (close_date IS NULL OR close_date > DATE '{day}' - {ARCHIVE_DAYS}))"""


def deal_state(mart, day: str):
    """What a snapshot of the pipeline on ``day`` shows: engaged deals, those closed within the last year with
    their outcome, older ones archived."""
    known = F.col("close_date") <= F.lit(day).cast("date")
    rows = mart.where((F.col("engage_date") <= F.lit(day).cast("date"))
                      & (F.col("close_date").isNull() | (F.col("close_date") > F.date_sub(F.lit(day).cast("date"), ARCHIVE_DAYS))))
    return rows.select("opportunity_id", F.when(known, F.col("deal_stage")).otherwise(F.lit("Engaging")).alias("stage"),
                       F.when(known, F.col("close_value")).alias("close_value"))


@register("snapshot_changes", O.with_mart_and(",".join(_state_sql(n, s) for n, s in zip(("a", "b"), SNAPSHOTS)), """
SELECT coalesce(a.opportunity_id, b.opportunity_id) AS opportunity_id,
       CASE WHEN a.opportunity_id IS NULL THEN 'added' WHEN b.opportunity_id IS NULL THEN 'removed' ELSE 'changed' END AS change,
       a.stage AS old_stage, b.stage AS new_stage, a.close_value AS old_value, b.close_value AS new_value
FROM a FULL JOIN b ON a.opportunity_id = b.opportunity_id
WHERE (a.opportunity_id, a.stage, a.close_value) IS DISTINCT FROM (b.opportunity_id, b.stage, b.close_value)"""))
def q_changes(spark, d):
    old, new = (deal_state(load_mart(spark, d), day) for day in SNAPSHOTS)
    found = snapshots_diff.diff(old, new, "opportunity_id")
    return found.select("opportunity_id", "change", F.col("old.stage").alias("old_stage"), F.col("new.stage").alias("new_stage"),
                        F.col("old.close_value").alias("old_value"), F.col("new.close_value").alias("new_value"))


@register("deal_history", O.with_mart_and(",".join(_state_sql(n, s) for n, s in zip(("a", "b"), SNAPSHOTS)), f"""
SELECT a.opportunity_id, a.stage, a.close_value, DATE '{SNAPSHOTS[0]}' AS valid_from,
       if((a.stage, a.close_value) IS DISTINCT FROM (b.stage, b.close_value) OR b.opportunity_id IS NULL, DATE '{SNAPSHOTS[1]}', NULL) AS valid_to
FROM a LEFT JOIN b ON a.opportunity_id = b.opportunity_id
UNION ALL
SELECT b.opportunity_id, b.stage, b.close_value, DATE '{SNAPSHOTS[1]}', NULL
FROM b LEFT JOIN a ON a.opportunity_id = b.opportunity_id
WHERE a.opportunity_id IS NULL OR (a.stage, a.close_value) IS DISTINCT FROM (b.stage, b.close_value)"""))
def q_history(spark, d):
    old, new = (deal_state(load_mart(spark, d), day) for day in SNAPSHOTS)
    first = old.withColumn("valid_from", F.lit(SNAPSHOTS[0]).cast("date")).withColumn("valid_to", F.lit(None).cast("date"))
    return snapshots_diff.merge_history(first, new, "opportunity_id", SNAPSHOTS[1])


@register("weighted_sample", O.with_mart_and("""
keyed AS (
    SELECT *, -ln((('0x' || substr(md5(opportunity_id || '-42'), 1, 8))::BIGINT + 0.5) / 4294967296.0) / close_value AS k
    FROM mart WHERE close_value > 0)""", f"""
SELECT opportunity_id, regional_office, close_value FROM keyed
QUALIFY row_number() OVER (PARTITION BY regional_office ORDER BY k, opportunity_id) <= {SAMPLE_PER_REGION}"""))
def q_sample(spark, d):
    """Won deals drawn by value, a fixed number per region."""
    deals = load_mart(spark, d).select("opportunity_id", "regional_office", "close_value")
    return sampling.weighted_sample(deals, "regional_office", "close_value", "opportunity_id", SAMPLE_PER_REGION)
