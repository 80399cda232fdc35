"""Registered queries: funnel, win rates, cycle, attrition, scoring and report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import deal_prompt
from ..operators import attrition as attrition_ops
from ..operators import cycle, funnel, report, scoring, winrate
from ..schemas import (ATTRITION_INTERPRETATION, ATTRITION_POINT, CYCLE_EDGES, CYCLE_LABELS,
                       DEFAULT_PRODUCT_TEXT, DEFAULT_REP_TEXT, FUNNEL_COUNT_LABELS, FUNNEL_STEPS,
                       MIN_REP_SUPPORT, OPEN_STAGES, PROMPT_PREFIX, RISK_PROPENSITY_WEIGHT,
                       RISK_RATIO_CAP, RISK_STALL_WEIGHT, SEED, SEVERITY_ABOVE, SEVERITY_NEAR,
                       SEVERITY_WELL_BEYOND, STALL_RULE_TEXT, STALL_THRESHOLD)
from . import oracle as O
from .queries import DRIVER_SECTOR_RECODES, load_mart, register


def _rounded(df, digits: int, *cols: str):
    """Doubles that both engines sum in an order of their own, rounded for comparison."""
    return df.withColumns({c: F.round(c, digits) for c in cols})


# ---------------------------------------------------------------- funnel
_FUNNEL = f"""
SELECT stage_order, transition, below.deals AS denominator, above.deals AS numerator,
       above.deals / nullif(below.deals, 0)::DOUBLE AS conversion_rate
FROM {O.values(FUNNEL_STEPS, "stage_order, transition, den, num")}
JOIN tally AS below ON below.point = den JOIN tally AS above ON above.point = num"""


@register("funnel_conversion", O.with_mart_and(O.TALLY, _FUNNEL))
def q_funnel(spark, d):
    return funnel.funnel_conversion(load_mart(spark, d))


@register("funnel_counts", O.with_mart_and(O.TALLY, f"""
SELECT step, stage, deals FROM tally
JOIN {O.values([(k + 1, label, point) for k, (label, point) in
                enumerate(zip(FUNNEL_COUNT_LABELS, ("total", "reached", "closed", "won")))], "step, stage, spot")}
  ON spot = point"""))
def q_funnel_counts(spark, d):
    return funnel.funnel_counts(load_mart(spark, d))


# ---------------------------------------------------------------- win rates
def _win_sql(keys: str, extra: str, having: str = "", **kw) -> str:
    return O.with_mart(f"""
SELECT {keys}, count(*) AS closed_deals, sum(won)::BIGINT AS won_deals, avg(won) AS win_rate, {extra}
FROM mart WHERE is_closed = 1 GROUP BY ALL {having}""", **kw)


@register("win_rate_by_rep", _win_sql("sales_agent, manager, regional_office",
                                      "round(coalesce(sum(close_value) FILTER (won = 1), 0), 2) AS won_revenue",
                                      f"HAVING count(*) >= {MIN_REP_SUPPORT}"))
def q_win_rep(spark, d):
    return _rounded(winrate.win_rate_by_rep(load_mart(spark, d)), 2, "won_revenue")


@register("win_rate_by_segment", _win_sql("ifnull(sector, 'Unknown') AS sector", "round(avg(sales_price), 6) AS avg_list_price",
                                          sector_recodes=DRIVER_SECTOR_RECODES))
def q_win_segment(spark, d):
    return _rounded(winrate.win_rate_by_segment(load_mart(spark, d, sector_recodes=DRIVER_SECTOR_RECODES)), 6, "avg_list_price")


@register("win_rate_by_product", _win_sql("product, series", "round(avg(if(won = 1, close_value, NULL)), 6) AS avg_won_value"))
def q_win_product(spark, d):
    return _rounded(winrate.win_rate_by_product(load_mart(spark, d)), 6, "avg_won_value")


# ---------------------------------------------------------------- cycle
_CYCLE_NAMES = ("avg_cycle_days", *map(cycle.quantile_name, cycle.QUANTILES))


def _cycle_sql(outcome: str, grouping: str) -> str:
    quantiles = ", ".join(f"round(q[{k + 1}], 6) AS {cycle.quantile_name(x)}" for k, x in enumerate(cycle.QUANTILES))
    return O.with_mart(f"""
SELECT outcome, deals, round(mean, 6) AS avg_cycle_days, {quantiles}
FROM (SELECT {outcome} AS outcome, count(*) AS deals, avg(cycle_days) AS mean,
             quantile_cont(cycle_days, {list(cycle.QUANTILES)}) AS q
      FROM mart WHERE is_closed = 1 GROUP BY {grouping})""")


@register("cycle_summary", _cycle_sql("deal_stage", "deal_stage"))
def q_cycle(spark, d):
    return _rounded(cycle.cycle_summary(load_mart(spark, d)), 6, *_CYCLE_NAMES)


@register("cycle_summary_rollup", _cycle_sql(f"if(grouping(deal_stage) = 1, {O.text(cycle.TOTAL_LABEL)}, deal_stage)",
                                             "ROLLUP (deal_stage)"))
def q_cycle_rollup(spark, d):
    return _rounded(cycle.cycle_summary(load_mart(spark, d), total=True), 6, *_CYCLE_NAMES)


@register("cycle_distribution", O.with_mart(f"""
SELECT ({list(CYCLE_LABELS)})[1 + if(cycle_days IS NULL, {len(CYCLE_EDGES)},
           len(list_filter({list(CYCLE_EDGES)}, lambda edge: edge < cycle_days)))] AS cycle_bucket,
       count(*) AS deals, avg(won) AS win_rate
FROM mart WHERE is_closed = 1 GROUP BY ALL"""))
def q_cycle_dist(spark, d):
    return cycle.cycle_distribution(load_mart(spark, d))


# ---------------------------------------------------------------- attrition
@register("attrition", O.with_mart_and(O.BY_STAGE, f"""
SELECT {O.text(ATTRITION_POINT)} AS observed_attrition_point, {O.in_stage('Lost')} AS lost_deals, {O.in_stage('Won')} AS won_deals,
       lost_deals / nullif(lost_deals + won_deals, 0)::DOUBLE AS loss_rate_among_closed,
       {O.in_stage('Engaging')} AS unresolved_engaging, {O.in_stage('Prospecting')} AS unresolved_prospecting,
       {O.text(ATTRITION_INTERPRETATION)} AS interpretation
FROM by_stage"""))
def q_attrition(spark, d):
    return attrition_ops.attrition(load_mart(spark, d))


# ---------------------------------------------------------------- scoring (stand-in score)
def _whole(column: str) -> str:
    return f"trunc(coalesce({column}, 0)::DOUBLE)::BIGINT"


_SUMMARY_PARTS = (
    f"coalesce(sales_agent, {O.text(DEFAULT_REP_TEXT)})", O.text("'s "), f"coalesce(product, {O.text(DEFAULT_PRODUCT_TEXT)})",
    O.text(" opportunity has a "), "printf('%.0f', propensity_to_close * 100)", O.text("% close propensity and has spent "),
    _whole("days_in_stage"), O.text(" days in Engaging, "),
    f"({[SEVERITY_NEAR, SEVERITY_ABOVE, SEVERITY_WELL_BEYOND]})[1 + (ifnull(stall_ratio, 0) >= 2)::INT + (ifnull(stall_ratio, 0) >= 3)::INT]",
    O.text(" the "), _whole("historical_stage_norm_days"),
    O.text("-day historical norm; prioritize a next-step check before forecast review."))

SCORES_CTES = O.AGED + f""",
scores AS (
    SELECT opportunity_id, sales_agent, manager, regional_office, product, account, deal_stage, engage_date,
           (('0x' || md5(opportunity_id || '-{SEED}')[:8])::BIGINT % 1000)::DOUBLE / 1000.0::DOUBLE AS propensity_to_close,
           days_in_stage, if(deal_stage = 'Engaging', coalesce(segment, everywhere), NULL) AS historical_stage_norm_days,
           days_in_stage / nullif(historical_stage_norm_days, 0)::DOUBLE AS stall_ratio,
           ifnull(stall_ratio >= {STALL_THRESHOLD}, false) AS stalled,
           (1.0::DOUBLE - propensity_to_close) * {RISK_PROPENSITY_WEIGHT}::DOUBLE
             + greatest(least(ifnull(stall_ratio, 0.0::DOUBLE), {RISK_RATIO_CAP}::DOUBLE), 0.0::DOUBLE)
               / {RISK_RATIO_CAP}::DOUBLE * {RISK_STALL_WEIGHT}::DOUBLE AS risk_score,
           concat({', '.join(_SUMMARY_PARTS)}) AS deal_summary
    FROM aged WHERE deal_stage IN {OPEN_STAGES}
)"""


def load_scores(spark, d):
    return scoring.score_open_standin(load_mart(spark, d))


@register("risk_score", O.with_mart_and(SCORES_CTES, """
SELECT opportunity_id, deal_stage, propensity_to_close, historical_stage_norm_days, stall_ratio,
       stalled, risk_score FROM scores"""))
def q_risk(spark, d):
    return load_scores(spark, d).select(
        "opportunity_id", "deal_stage", "propensity_to_close", "historical_stage_norm_days",
        "stall_ratio", "stalled", "risk_score")


@register("deal_summary_text", O.with_mart_and(SCORES_CTES,
                                               "SELECT opportunity_id, deal_summary FROM scores"))
def q_summary(spark, d):
    return load_scores(spark, d).select("opportunity_id", "deal_summary")


_PROMPT_FACTS = (
    ("opportunity", "ifnull(opportunity_id, 'None')"), ("rep", "ifnull(sales_agent, 'None')"),
    ("product", "ifnull(product, 'None')"), ("account", "ifnull(account, 'None')"),
    ("close_propensity", "printf('%.3f', propensity_to_close)"), ("days_in_engaging", _whole("days_in_stage")),
    ("historical_norm_days", _whole("historical_stage_norm_days")), ("stall_ratio", "printf('%.2f', stall_ratio)"))


@register("prompt_text", O.with_mart_and(SCORES_CTES, f"""
SELECT opportunity_id,
       if(propensity_to_close + days_in_stage + historical_stage_norm_days + stall_ratio IS NULL, NULL,
          {O.text(PROMPT_PREFIX)} || concat_ws('; ', {', '.join(f"'{k}=' || {v}" for k, v in _PROMPT_FACTS)}) || '.') AS prompt
FROM scores"""))
def q_prompt(spark, d):
    return load_scores(spark, d).select(
        "opportunity_id",
        deal_prompt(F.col("opportunity_id"), F.col("sales_agent"), F.col("product"),
                    F.col("account"), F.col("propensity_to_close"), F.col("days_in_stage"),
                    F.col("historical_stage_norm_days"), F.col("stall_ratio")).alias("prompt"))


@register("top_risk", O.with_mart_and(SCORES_CTES, """
SELECT * FROM scores ORDER BY stalled DESC, risk_score DESC, opportunity_id LIMIT 100"""))
def q_top_risk(spark, d):
    return scoring.top_risk(load_scores(spark, d), 100)


PRIORITY_REGIONS = ("AMERICA", "EUROPE")


@register("prioritized_filtered", O.with_mart_and(SCORES_CTES, """
SELECT opportunity_id, sales_agent, regional_office, product, deal_stage, propensity_to_close,
       days_in_stage, stall_ratio, stalled, risk_score
FROM scores
WHERE regional_office IN ('AMERICA', 'EUROPE') AND deal_stage IN ('Engaging') AND stalled
ORDER BY stalled DESC, risk_score DESC, opportunity_id LIMIT 25"""))
def q_prioritized(spark, d):
    return report.prioritized(load_scores(spark, d), regions=PRIORITY_REGIONS,
                              stages=("Engaging",), stalled_only=True, n=25)


@register("deal_lookup", O.with_mart_and(SCORES_CTES + """,
top1 AS (SELECT opportunity_id FROM scores ORDER BY risk_score DESC, opportunity_id LIMIT 1)""", """
SELECT opportunity_id,
       printf('%.1f', propensity_to_close * 100) || '%' AS propensity_display,
       COALESCE(CAST(days_in_stage AS VARCHAR), '—') AS days_display,
       CASE WHEN stall_ratio IS NULL THEN '—' ELSE printf('%.2f', stall_ratio) || '×' END AS ratio_display,
       deal_summary
FROM scores WHERE opportunity_id = (SELECT opportunity_id FROM top1)"""))
def q_deal(spark, d):
    return report.deal(load_scores(spark, d))


@register("region_options", O.with_mart_and(SCORES_CTES, """
SELECT DISTINCT regional_office FROM scores WHERE regional_office IS NOT NULL"""))
def q_regions(spark, d):
    return report.options(load_scores(spark, d), "regional_office")


@register("portfolio_metrics", O.with_mart_and(SCORES_CTES + "," + O.BY_STAGE, f"""
SELECT (SELECT count(*) FROM mart) AS records_total, {O.in_stage('Won')} AS wins, {O.in_stage('Lost')} AS losses,
       wins + losses AS records_closed, wins / nullif(wins + losses, 0)::DOUBLE AS closed_win_rate,
       found.*
FROM by_stage, (SELECT count(*) AS open_deals, count_if(deal_stage = 'Engaging')::BIGINT AS open_engaging_deals,
                       count_if(stalled)::BIGINT AS stalled_deals FROM scores) AS found"""))
def q_portfolio(spark, d):
    mart = load_mart(spark, d)
    return report.portfolio_metrics(mart, scoring.score_open_standin(mart))


@register("key_findings", O.with_mart_and(O.TALLY + "," + O.AGED + "," + O.BY_STAGE, f"""
SELECT transition AS finding, printf('%.1f', conversion_rate * 100) || '%' AS value,
       format('{{:,}} of {{:,}} opportunities', numerator, denominator) AS detail
FROM ({_FUNNEL})
UNION ALL
SELECT 'Observed attrition point', {O.text(ATTRITION_POINT)}, format('{{:,}} recorded losses', {O.in_stage('Lost')}) FROM by_stage
UNION ALL
SELECT 'Stalled engaging deals', format('{{:,}}', count_if(stalled)::BIGINT), {O.text(STALL_RULE_TEXT)} FROM ({O.stalled('strict')})"""))
def q_findings(spark, d):
    return report.key_findings(load_mart(spark, d))
