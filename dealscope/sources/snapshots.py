"""Adapter: the driver's order tables -> opportunity snapshot sources.

Produces the four inputs the mart expects (fact + three dimensions) from the
parquet tables ``orders lineitem part supplier customer nation region``:

* one opportunity per order; ``deal_stage`` from order status (P -> Prospecting,
  O -> Engaging, F -> Won for priorities 1-3, Lost otherwise);
* ``engage_date`` = order date unless Prospecting; ``close_date`` (F only) =
  earliest ship date on or after the order date; ``close_value`` = total price
  when Won, 0 when Lost;
* rep = supplier of the order's smallest supplier key, product = type of the
  order's smallest part key, account = customer.

Scale notes: line items are read and dealt by order once; the reduction per (order, ship
day), the join with the orders and the final reduction per order all use that one
exchange, dealt by the number of rows so that no task's share grows with the tables.  The reduced orders are written to the shared scratch folder (``stored_orders``), from which the fact, the
data-driven snapshot date and every variant of the mart are read.  An order's lines thus meet in one task, which streams them into at most one
entry per day.  ``snapshot_mart`` joins each dimension once, by its surrogate key, with
the fact as the preserved (left) side, which AQE may split if a key is skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import recode
from ..operators import mart
from ..schemas import MART_COLUMNS, PIPELINE_SCHEMA, PRODUCT_RECODES
from ..session import written
from .readers import read_table, table_versions

# Orders and line items of one task: aggregates and sorts hold some 450 bytes for each line at once.
ROWS_PER_TASK = 250_000


def _stage(status, priority):
    top = F.substring(priority, 1, 1).isin("1", "2", "3")
    return (F.when(status == "P", F.lit("Prospecting"))
            .when(status == "O", F.lit("Engaging"))
            .when((status == "F") & top, F.lit("Won"))
            .when(status == "F", F.lit("Lost")))


def order_partitions(spark: SparkSession, sf_dir: str) -> int:
    """Number of partitions in which orders meet their lines: by rows (a count over the file footers),
    two at least."""
    rows = sum(read_table(spark, sf_dir, t).count() for t in ("orders", "lineitem"))
    return max(2, -(-rows // ROWS_PER_TASK))


def line_days(spark: SparkSession, sf_dir: str, partitions: int) -> DataFrame:
    """Line items dealt by order and reduced to one row per (order, ship day) with
    the smallest part and supplier keys.  Nearly all (order, day) pairs are single
    lines, so combining them before the exchange would save nothing."""
    return (read_table(spark, sf_dir, "lineitem")
            .select("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")
            .repartition(partitions, "l_orderkey")
            .groupBy("l_orderkey", F.to_date("l_shipdate").alias("ship_day"))
            .agg(F.min("l_partkey").alias("pk"), F.min("l_suppkey").alias("sk")))


def orders_with_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order with its smallest part key, smallest supplier key and
    the earliest ship day on or after the order day.  The aggregation after
    the join is keyed like the join, so it needs no further shuffle."""
    # Both sides are dealt into the same number of partitions, which adaptive execution leaves
    # alone: merged up to its advisory bytes, a task held some 20 bytes for each byte read.
    partitions = order_partitions(spark, sf_dir)
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority").repartition(partitions, "o_orderkey")
    # The (order, ship day) side is line-item sized, never a bounded dimension:
    # keep a sort-merge join (spills, and its partitioning serves the
    # aggregation) instead of letting a small sample demote it to a broadcast.
    days = line_days(spark, sf_dir, partitions).hint("merge")
    order_day = F.to_date("o_orderdate")
    # Grouping by the order's own columns (constant per order) keeps this a
    # hash aggregate; hash partitioning on o_orderkey satisfies the clustering.
    return (orders.join(days, orders.o_orderkey == days.l_orderkey, "left")
            .groupBy("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                     "o_orderdate", "o_orderpriority")
            .agg(F.min("pk").alias("first_partkey"),
                 F.min("sk").alias("first_suppkey"),
                 F.min(F.when(F.col("ship_day") >= order_day, F.col("ship_day")))
                  .alias("first_ship_day")))


_ORDERS: dict[tuple, tuple] = {}


def stored_orders(spark: SparkSession, sf_dir: str, version: tuple | None = None) -> DataFrame:
    """:func:`orders_with_lines` as a stored table, one per application, directory and version of its tables."""
    base = sf_dir.rstrip("/")
    version = version or table_versions(spark, [f"{base}/{t}.parquet" for t in ("orders", "lineitem")])
    key = (spark.sparkContext.applicationId, base)
    hit = _ORDERS.get(key)
    if hit is None or hit[0] != version or hit[1].sparkSession is not spark:
        hit = _ORDERS[key] = (version, written(orders_with_lines(spark, sf_dir), "orders"))
    return hit[1]


def release_orders() -> None:
    """Forget the stored orders (their folders go with ``session.drop_scratch``)."""
    _ORDERS.clear()


def _fact_columns() -> list:
    """Stage, dates and value of an order that carries its first ship day."""
    stage = _stage(F.col("o_orderstatus"), F.col("o_orderpriority"))
    return [F.col("o_orderkey").cast("string").alias("opportunity_id"),
            stage.alias("deal_stage"),
            F.when(F.col("o_orderstatus").isin("O", "F"), F.to_date("o_orderdate")).alias("engage_date"),
            F.when(F.col("o_orderstatus") == "F", F.col("first_ship_day")).alias("close_date"),
            F.when(stage == "Won", F.col("o_totalprice"))
             .when(stage == "Lost", F.lit(0.0)).alias("close_value")]


def pipeline_fact(spark: SparkSession, sf_dir: str, orders: DataFrame | None = None) -> DataFrame:
    orders = orders_with_lines(spark, sf_dir) if orders is None else orders
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return (orders
            .join(part, F.col("first_partkey") == part.p_partkey, "left")
            .join(supplier, F.col("first_suppkey") == supplier.s_suppkey, "left")
            .join(customer, orders.o_custkey == customer.c_custkey, "left")
            .select(*_fact_columns(), F.col("s_name").alias("sales_agent"),
                    F.col("p_type").alias("product"), F.col("c_name").alias("account"))
            .select(*[f.name for f in PIPELINE_SCHEMA]))


def snapshot_mart(spark: SparkSession, sf_dir: str, *, product_recodes=None, sector_recodes=None,
                  snapshot=None, orders: DataFrame | None = None) -> DataFrame:
    """The mart straight from the tables: each dimension is joined once, by surrogate key.  ``orders`` takes
    stored orders; the data-driven snapshot date, which reads them a second time, stores them by itself.

    Equals ``build_mart`` over ``snapshot_sources`` because names are unique per key.
    """
    recodes = PRODUCT_RECODES if product_recodes is None else product_recodes
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    reps = (supplier.join(sales_teams(spark, sf_dir), F.col("s_name") == F.col("sales_agent"), "left")
            .select("s_suppkey", F.col("s_name").alias("sales_agent"), *mart.team_columns()))
    prods = products(spark, sf_dir)
    part = read_table(spark, sf_dir, "part").select("p_partkey", recode(F.col("p_type"), recodes).alias("product"))
    parts = part.join(prods.select("product", *mart.product_columns(prods)), "product", "left")
    accts = accounts(spark, sf_dir)
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    custs = (customer.join(accts.select("account", *mart.account_columns(accts, sector_recodes)),
                           F.col("c_name") == F.col("account"), "left")
             .drop("account").withColumnRenamed("c_name", "account"))
    if orders is None:
        orders = orders_with_lines(spark, sf_dir) if snapshot is not None else stored_orders(spark, sf_dir)
    joined = (orders
              .join(parts, F.col("first_partkey") == F.col("p_partkey"), "left")
              .join(reps, F.col("first_suppkey") == F.col("s_suppkey"), "left")
              .join(custs, F.col("o_custkey") == F.col("c_custkey"), "left"))
    facts = _fact_columns()
    joined = joined.select(*facts, *[c for c in MART_COLUMNS[:18] if c in joined.columns])
    snap = (F.lit(snapshot).cast("date") if snapshot is not None
            else orders.select(*facts).select(F.max("close_date")).scalar())
    return mart.with_stage_columns(joined, snap)


def sales_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rep -> manager (supplier nation) and regional office (its region)."""
    supplier = read_table(spark, sf_dir, "supplier").select("s_name", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return (supplier
            .join(nation, supplier.s_nationkey == nation.n_nationkey, "left")
            .join(region, F.col("n_regionkey") == region.r_regionkey, "left")
            .select(F.col("s_name").alias("sales_agent"),
                    F.col("n_name").alias("manager"),
                    F.col("r_name").alias("regional_office")))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per product (part type): the most common brand as its series
    (ties -> smallest) and the lowest retail price as its list price."""
    return (read_table(spark, sf_dir, "part")
            .groupBy(F.col("p_type").alias("product"))
            .agg(F.mode("p_brand", True).alias("series"),
                 F.min("p_retailprice").alias("sales_price")))


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer firmographics; year and head-count are derived stand-ins."""
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (customer
            .join(nation, customer.c_nationkey == nation.n_nationkey, "left")
            .select(F.col("c_name").alias("account"),
                    F.col("c_mktsegment").alias("sector"),
                    (F.lit(1970) + F.col("c_custkey") % 50).cast("int").alias("year_established"),
                    F.col("c_acctbal").alias("revenue"),
                    (F.lit(10) * (F.lit(1) + F.col("c_custkey") % 100)).cast("int").alias("employees"),
                    F.col("n_name").alias("office_location"),
                    F.lit(None).cast("string").alias("subsidiary_of")))


def snapshot_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The mart's four sources; the fact reads the stored orders, since a mart and its checks read it several times."""
    return {
        "sales_pipeline": pipeline_fact(spark, sf_dir, stored_orders(spark, sf_dir)),
        "sales_teams": sales_teams(spark, sf_dir),
        "products": products(spark, sf_dir),
        "accounts": accounts(spark, sf_dir),
    }
