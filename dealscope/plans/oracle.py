"""DuckDB SQL building blocks of the registered queries' oracles.

The mart is derived straight from the driver's tables by surrogate keys, independently of the
Spark operators.  Wording and limits come from ``dealscope.schemas``, so that each fixed value
is written once.
"""

from __future__ import annotations

from ..schemas import PRODUCT_RECODES, SECTOR_RECODES, STALL_QUANTILE, STALL_THRESHOLD


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("'", "''") + "'"


def values(rows, names: str) -> str:
    """A VALUES list as a table expression."""
    def cell(v):
        return text(v) if isinstance(v, str) else "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v)

    body = ", ".join("(" + ", ".join(map(cell, row)) + ")" for row in rows)
    return f"(VALUES {body}) AS v({names})"


def _respelled(column: str, mapping: dict[str, str]) -> str:
    if not mapping:
        return column
    pairs = ", ".join(f"{text(a)}: {text(b)}" for a, b in mapping.items())
    return f"coalesce(MAP {{{pairs}}}[{column}], {column})"


#: (order status, urgent priority) -> stage.
_STAGE_ROWS = [("P", True, "Prospecting"), ("P", False, "Prospecting"), ("O", True, "Engaging"), ("O", False, "Engaging"),
               ("F", True, "Won"), ("F", False, "Lost")]


def mart_ctes(product_recodes=None, sector_recodes=None, snapshot: str | None = None) -> str:
    """CTE list (without the leading WITH) that ends in ``mart``."""
    products = PRODUCT_RECODES if product_recodes is None else product_recodes
    sectors = SECTOR_RECODES if sector_recodes is None else sector_recodes
    today = f"DATE '{snapshot}'" if snapshot else "(SELECT max(close_date) FROM dated)"
    return f"""
parcel AS (
    SELECT l_orderkey, min(l_partkey) AS partkey, min(l_suppkey) AS suppkey, list(l_shipdate::DATE) AS days
    FROM lineitem GROUP BY l_orderkey
),
staged AS (
    SELECT orders.*, partkey, suppkey, days, deal_stage, MAP {{'Won': 1, 'Lost': 0}}[deal_stage] AS won
    FROM orders
    LEFT JOIN parcel ON l_orderkey = o_orderkey
    LEFT JOIN {values(_STAGE_ROWS, "status, urgent, deal_stage")}
           ON status = o_orderstatus AND urgent = coalesce(o_orderpriority[1] IN ('1', '2', '3'), false)
),
dated AS (
    SELECT *, if(deal_stage <> 'Prospecting', o_orderdate::DATE, NULL) AS engage_date,
           if(won IS NOT NULL, list_min(list_filter(days, lambda d: d >= o_orderdate::DATE)), NULL) AS close_date
    FROM staged
),
shelf AS (
    SELECT {_respelled('p_type', products)} AS product,
           mode() WITHIN GROUP (ORDER BY p_brand) AS series, min(p_retailprice)::DOUBLE AS sales_price
    FROM part GROUP BY p_type
),
home AS (SELECT n_nationkey, n_name, r_name FROM nation LEFT JOIN region ON r_regionkey = n_regionkey),
mart AS (
    SELECT o_orderkey::VARCHAR AS opportunity_id, s_name AS sales_agent, {_respelled('p_type', products)} AS product,
           c_name AS account, deal_stage, engage_date, close_date, won * o_totalprice AS close_value,
           desk.n_name AS manager, desk.r_name AS regional_office, series, sales_price,
           {_respelled('c_mktsegment', sectors)} AS sector, (1970 + c_custkey % 50)::INTEGER AS year_established,
           c_acctbal AS revenue, (10 * (1 + c_custkey % 100))::INTEGER AS employees,
           seat.n_name AS office_location, NULL::VARCHAR AS subsidiary_of,
           (won IS NOT NULL)::INTEGER AS is_closed, won,
           if(won IS NOT NULL, close_date - engage_date, NULL) AS cycle_days,
           if(deal_stage = 'Engaging', {today} - engage_date, NULL) AS days_in_stage
    FROM dated
    LEFT JOIN part ON p_partkey = partkey
    LEFT JOIN shelf ON shelf.product = {_respelled('p_type', products)}
    LEFT JOIN supplier ON s_suppkey = suppkey
    LEFT JOIN home AS desk ON desk.n_nationkey = s_nationkey
    LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN home AS seat ON seat.n_nationkey = c_nationkey
)"""


def with_mart(body: str, **kw) -> str:
    return "WITH " + mart_ctes(**kw) + "\n" + body


def with_mart_and(extra_ctes: str, body: str, **kw) -> str:
    return "WITH " + mart_ctes(**kw) + ",\n" + extra_ctes + "\n" + body


def _known_cycle(over: str, quantile: float = STALL_QUANTILE) -> str:
    return f"quantile_cont(cycle_days, {quantile}) FILTER (is_closed = 1) OVER ({over})"


#: Every mart row with its segment's and the overall duration norm (windows, no join).  Unlike
#: ``segment``, ``strict`` has no norm where a segment key is NULL.
AGED = f"""
aged AS (
    SELECT *, {_known_cycle('PARTITION BY product, regional_office')} AS segment, {_known_cycle('')} AS everywhere,
           if(product IS NULL OR regional_office IS NULL, NULL, segment) AS strict
    FROM mart
)"""


def stalled(norm: str) -> str:
    """Engaging deals with a norm, their age ratio and flag."""
    return f"""SELECT opportunity_id, sales_agent, manager, regional_office, product, account, engage_date, days_in_stage,
       {norm} AS historical_stage_norm_days, days_in_stage / nullif({norm}, 0)::DOUBLE AS stall_ratio,
       stall_ratio >= {STALL_THRESHOLD} AS stalled
FROM aged WHERE deal_stage = 'Engaging'"""


#: How many deals are at or past each point of the funnel, by the names that FUNNEL_STEPS uses.
TALLY = """
tally AS (
    SELECT unnest(['total', 'reached', 'closed', 'won']) AS point,
           unnest([count(*), count_if(deal_stage <> 'Prospecting'), sum(is_closed), count_if(won = 1)])::BIGINT AS deals
    FROM mart
)"""

#: Deals by stage as one map.
BY_STAGE = """
by_stage AS (
    SELECT map_from_entries(list((deal_stage, n))) AS n_of
    FROM (SELECT deal_stage, count(*) AS n FROM mart WHERE deal_stage IS NOT NULL GROUP BY deal_stage)
)"""


def in_stage(stage: str) -> str:
    return f"coalesce(n_of[{text(stage)}], 0)"
