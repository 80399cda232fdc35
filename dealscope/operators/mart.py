"""Opportunity mart: clean, type, recode and enrich the fact table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import recode, typed
from ..schemas import (CLOSED_STAGES, MART_COLUMNS, PRODUCT_RECODES, SECTOR_RECODES,
                       STAGE_ENGAGING, STAGE_LOST, STAGE_WON)
from .joins import validated_left_join


def typed_fact(pipeline: DataFrame, product_recodes: Mapping[str, str] | None = None) -> list[Column]:
    """The fact's own columns: typed, the product spelled as in the dimension."""
    recodes = PRODUCT_RECODES if product_recodes is None else product_recodes
    return [F.col("opportunity_id").cast("string").alias("opportunity_id"), F.col("sales_agent"),
            recode(F.col("product"), recodes).alias("product"), F.col("account"), F.col("deal_stage"),
            typed(pipeline, "engage_date", "date").alias("engage_date"),
            typed(pipeline, "close_date", "date").alias("close_date"),
            typed(pipeline, "close_value", "double").alias("close_value")]


def team_columns() -> list[Column]:
    return [F.col("manager"), F.col("regional_office")]


def product_columns(products: DataFrame) -> list[Column]:
    return [F.col("series"), typed(products, "sales_price", "double").alias("sales_price")]


def account_columns(accounts: DataFrame, sector_recodes: Mapping[str, str] | None = None) -> list[Column]:
    recodes = SECTOR_RECODES if sector_recodes is None else sector_recodes
    return [recode(F.col("sector"), recodes).alias("sector"),
            typed(accounts, "year_established", "int").alias("year_established"),
            typed(accounts, "revenue", "double").alias("revenue"),
            typed(accounts, "employees", "int").alias("employees"),
            F.col("office_location"), F.col("subsidiary_of")]


def with_stage_columns(joined: DataFrame, snapshot: Column) -> DataFrame:
    """The mart from a typed fact that carries its dimension columns: outcome, cycle and age."""
    stage = F.col("deal_stage")
    closed = stage.isin(*CLOSED_STAGES)
    return joined.select(
        *MART_COLUMNS[:18],
        F.when(closed, F.lit(1)).otherwise(F.lit(0)).alias("is_closed"),
        F.when(stage == STAGE_WON, F.lit(1)).when(stage == STAGE_LOST, F.lit(0)).alias("won"),
        F.when(closed, F.date_diff("close_date", "engage_date")).cast("bigint").alias("cycle_days"),
        F.when(stage == STAGE_ENGAGING, F.date_diff(snapshot, F.col("engage_date")))
         .cast("bigint").alias("days_in_stage"))


def build_mart(pipeline: DataFrame, teams: DataFrame, products: DataFrame,
               accounts: DataFrame, *, product_recodes: Mapping[str, str] | None = None,
               sector_recodes: Mapping[str, str] | None = None,
               snapshot: dt.date | str | None = None, validate: bool = False) -> DataFrame:
    """Typed, recoded and enriched opportunity mart (one row per opportunity).

    ``snapshot=None`` measures Engaging age against the latest close date in the
    fact (a scalar subquery that reads that column only); a date gives the
    fixed-snapshot variant.  ``validate=True`` fails on a duplicated dimension key
    instead of fanning rows out.

    The three dimension joins are left equi-joins with the fact as the preserved
    side; adaptive execution broadcasts a dimension whose measured bytes are few,
    and splits skewed fact partitions otherwise.
    """
    fact = pipeline.select(*typed_fact(pipeline, product_recodes))
    team = teams.select("sales_agent", *team_columns())
    prod = products.select("product", *product_columns(products))
    acct = accounts.select("account", *account_columns(accounts, sector_recodes))
    join = validated_left_join if validate else (lambda left, right, on: left.join(right, on, "left"))
    joined = join(join(join(fact, team, "sales_agent"), prod, "product"), acct, "account")
    snap = F.lit(snapshot).cast("date") if snapshot is not None else fact.select(F.max("close_date")).scalar()
    return with_stage_columns(joined, snap)


def engagement_features(mart: DataFrame) -> DataFrame:
    """Calendar and age features observable at engagement: month (1-12),
    weekday (Monday = 0) and account age in years (may be negative)."""
    return mart.withColumns({
        "engage_month": F.month("engage_date"),
        "engage_dow": F.weekday("engage_date"),
        "account_age": (F.year("engage_date") - F.col("year_established")).cast("int"),
    })
