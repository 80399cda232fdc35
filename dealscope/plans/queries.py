"""Registry of named queries: each reads the driver tables from ``sf_dir``,
builds the opportunity sources and mart, and applies one operator.

``QUERIES[name]`` is a ``(spark, sf_dir) -> DataFrame`` callable and
``ORACLE[name]`` the equivalent DuckDB SQL (absent for rows-only checks).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import mart as mart_ops
from ..operators import stall
from ..sources.readers import table_versions
from ..sources.snapshots import release_orders, snapshot_mart, snapshot_sources, stored_orders
from . import oracle as O

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# Parameters used by the registered queries (fixed values).
DRIVER_SECTOR_RECODES = {"AUTOMOBILE": "AUTOMOTIVE"}
FIXED_SNAPSHOT = "2001-12-31"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


_MARTS: dict[tuple, tuple] = {}
MART_TABLES = ("orders", "lineitem", "part", "supplier", "customer", "nation", "region")


def load_mart(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """The mart as a cached table: analyses of the same tables share one computation, as
    the derived tables of a warehouse would.  One entry per application, directory and mart
    parameters; an entry whose tables were rewritten is dropped and built again, and
    :func:`release_marts` drops all.  Lost cached blocks are recomputed from lineage."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"),
           tuple(sorted((k, repr(v)) for k, v in kw.items())))
    version = table_versions(spark, [f"{sf_dir.rstrip('/')}/{t}.parquet" for t in MART_TABLES])
    hit = _MARTS.get(key)
    if hit is not None and hit[1].sparkSession is spark and hit[0] == version:
        return hit[1]
    if hit is not None and hit[1].sparkSession is spark:
        hit[1].unpersist(blocking=False)
    mart = snapshot_mart(spark, sf_dir, orders=stored_orders(spark, sf_dir), **kw).persist(StorageLevel.MEMORY_AND_DISK)
    _MARTS[key] = (version, mart)
    return mart


def release_marts() -> None:
    """Drop every cached mart and forget the stored orders."""
    release_orders()
    while _MARTS:
        _MARTS.popitem()[1][1].unpersist(blocking=False)


# ---------------------------------------------------------------- mart
@register("mart_opportunities",
          O.with_mart("SELECT * FROM mart", sector_recodes=DRIVER_SECTOR_RECODES))
def q_mart(spark, d):
    return load_mart(spark, d, sector_recodes=DRIVER_SECTOR_RECODES)


@register("mart_fixed_snapshot",
          O.with_mart("SELECT opportunity_id, deal_stage, engage_date, days_in_stage FROM mart",
                      snapshot=FIXED_SNAPSHOT))
def q_mart_fixed(spark, d):
    return (load_mart(spark, d, snapshot=FIXED_SNAPSHOT)
            .select("opportunity_id", "deal_stage", "engage_date", "days_in_stage"))


# The same mart from untrusted text: every date and number goes through text, some of it
# malformed by a rule on the key, and every 11th of some product names is misspelt and recoded.
MISSPELT = ("STANDARD", "MEDIUM", "PROMO")


def _as_text(column: str, key: str, bad: dict[int, str]):
    """``column`` as text, replaced by a malformed or unusual spelling for some remainders of the key by 13."""
    k = F.pmod(F.col(key).cast("bigint"), F.lit(13))
    out = F.col(column).cast("string")
    for remainder, spelling in bad.items():
        out = F.when(k == remainder, F.expr(spelling.replace("?", column))).otherwise(out)
    return out.alias(column)


#: Remainder -> Spark SQL for the text of a date or number column (``?``).
BAD_DATES = {1: "'2017'", 2: "replace(string(?), '-', '/')", 3: "concat(string(?), ' 10:00:00')", 4: "concat(string(?), 'x')",
             5: "concat(' ', string(?), ' ')"}
BAD_NUMBERS = {1: "'12d'", 2: "concat(string(?), 'f')", 3: "'1_000'", 4: "concat(' ', string(?))", 6: "'n/a'"}
_TEXT_SQL_DATE = ("CASE opportunity_id::BIGINT % 13 WHEN 1 THEN '2017' WHEN 2 THEN replace(?::VARCHAR, '-', '/') "
                  "WHEN 3 THEN ?::VARCHAR || ' 10:00:00' WHEN 4 THEN ?::VARCHAR || 'x' WHEN 5 THEN ' ' || ?::VARCHAR || ' ' ELSE ?::VARCHAR END")
_TEXT_SQL_NUMBER = ("CASE opportunity_id::BIGINT % 13 WHEN 1 THEN '12d' WHEN 2 THEN ?::VARCHAR || 'f' WHEN 3 THEN '1_000' "
                    "WHEN 4 THEN ' ' || ?::VARCHAR WHEN 6 THEN 'n/a' ELSE ?::VARCHAR END")


def _text_sql() -> str:
    """The database's own TRY_CAST over the same texts."""
    def cast(column: str, kind: str, template: str) -> str:
        return f"TRY_CAST({template.replace('?', column)} AS {kind}) AS {column}"

    return O.with_mart(f"""
, texts AS (
    SELECT opportunity_id, product, deal_stage, {cast('engage_date', 'DATE', _TEXT_SQL_DATE)},
           {cast('close_date', 'DATE', _TEXT_SQL_DATE)},
           {cast('close_value', 'DOUBLE', _TEXT_SQL_NUMBER)}, series, won
    FROM mart)
SELECT opportunity_id, product, deal_stage, engage_date, close_date, close_value, series,
       if(won IS NOT NULL, close_date - engage_date, NULL) AS cycle_days,
       if(deal_stage = 'Engaging', (SELECT max(close_date) FROM texts) - engage_date, NULL) AS days_in_stage
FROM texts""")


@register("mart_text_sources", _text_sql())
def q_mart_text(spark, d):
    src = snapshot_sources(spark, d)
    fact = src["sales_pipeline"]
    misspelt = F.when((F.pmod(F.col("opportunity_id").cast("bigint"), F.lit(11)) == 0) & F.col("product").isin(*MISSPELT),
                      F.concat(F.col("product"), F.lit("??")))
    fact = fact.select(
        "opportunity_id", "sales_agent", F.coalesce(misspelt, F.col("product")).alias("product"), "account", "deal_stage",
        *[_as_text(c, "opportunity_id", BAD_DATES) for c in ("engage_date", "close_date")],
        _as_text("close_value", "opportunity_id", BAD_NUMBERS))
    mart = mart_ops.build_mart(fact, src["sales_teams"], src["products"], src["accounts"],
                               product_recodes={f"{n}??": n for n in MISSPELT})
    return mart.select("opportunity_id", "product", "deal_stage", "engage_date", "close_date", "close_value", "series",
                       "cycle_days", "days_in_stage")


@register("engagement_features", O.with_mart("""
SELECT opportunity_id, engage_date, year_established,
       CAST(month(engage_date) AS INTEGER) AS engage_month,
       CAST(isodow(engage_date) - 1 AS INTEGER) AS engage_dow,
       CAST(year(engage_date) - year_established AS INTEGER) AS account_age
FROM mart"""))
def q_engagement(spark, d):
    return (mart_ops.engagement_features(load_mart(spark, d))
            .select("opportunity_id", "engage_date", "year_established", "engage_month",
                    "engage_dow", "account_age"))


# ---------------------------------------------------------------- stalled deals
def _norms_sql(quantile: float) -> str:
    return O.with_mart(f"""
SELECT product, regional_office, quantile_cont(cycle_days, {quantile}) AS historical_stage_norm_days
FROM mart WHERE is_closed = 1 AND cycle_days IS NOT NULL GROUP BY ALL""")


@register("segment_norms", _norms_sql(0.75))
def q_segment_norms(spark, d):
    return stall.segment_norms(load_mart(spark, d))


@register("segment_norms_quantile", _norms_sql(0.5))
def q_segment_norms_q(spark, d):
    return stall.segment_norms(load_mart(spark, d), quantile=0.5)


@register("stalled_deals", O.with_mart_and(O.AGED, O.stalled("strict")))
def q_stalled(spark, d):
    return stall.stalled_deals(load_mart(spark, d))


@register("stalled_deals_fallback", O.with_mart_and(
    O.AGED, f"SELECT * REPLACE (coalesce(stalled, false) AS stalled) FROM ({O.stalled('coalesce(segment, everywhere)')})"))
def q_stalled_fallback(spark, d):
    return stall.stalled_deals(load_mart(spark, d), fallback="overall")


@register("stalled_count", O.with_mart_and(
    O.AGED, f"SELECT count_if(stalled)::BIGINT AS flagged FROM ({O.stalled('strict')})"))
def q_stalled_count(spark, d):
    return stall.stalled_count(stall.stalled_deals(load_mart(spark, d)))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stalled Engaging deals, worst first."""
    return stall.worst_first(stall.stalled_deals(load_mart(spark, sf_dir)))


# Further query groups register themselves on import.
from . import analytics_queries  # noqa: E402,F401
from . import model_queries  # noqa: E402,F401
from . import event_queries  # noqa: E402,F401
