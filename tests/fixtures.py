"""Small in-line fixtures (edge cases) shared by the tests."""

from pyspark.sql import types as T

PIPELINE_ROWS = [
    # id, rep, product, account, stage, engage, close, value
    ("o1", "Rep A", "GTXPro", "Acme", "Won", "2017-01-01", "2017-02-10", "1000"),
    ("o2", "Rep A", "GTX Pro", None, "Lost", "2017-01-05", "2017-01-20", "0"),
    ("o3", "Rep Z", "MG Special", "Acme", "Engaging", "2017-03-01", None, None),
    ("o4", "Rep B", "MG Special", "Beta", "Engaging", "not a date", None, None),
    ("o5", "Rep B", "GTX Pro", "Beta", "Won", "2017-02-01", None, "500"),
    ("o6", "Rep B", "GTX Pro", "Beta", None, "2017-02-01", None, None),
    ("o7", "Rep A", "GTX Pro", "Acme", "Prospecting", None, None, None),
    ("o8", "Rep A", "GTX Pro", "Acme", "Engaging", "2017-10-01", None, None),
]
TEAMS_ROWS = [("Rep A", "Mgr 1", "East"), ("Rep B", "Mgr 2", "West")]
PRODUCTS_ROWS = [("GTX Pro", "GTX", "4821"), ("MG Special", "MG", "55")]
ACCOUNTS_ROWS = [
    ("Acme", "technolgy", "1990", "100.5", "12.5", "US", None),
    ("Beta", "retail", "2001", "bad", "40", "US", None),
]

STR = T.StringType()


def sources(spark, teams=TEAMS_ROWS, products=PRODUCTS_ROWS, accounts=ACCOUNTS_ROWS,
            pipeline=PIPELINE_ROWS):
    from dealscope.schemas import SOURCE_SCHEMAS
    return {
        "sales_pipeline": spark.createDataFrame(pipeline, SOURCE_SCHEMAS["sales_pipeline"]),
        "sales_teams": spark.createDataFrame(teams, SOURCE_SCHEMAS["sales_teams"]),
        "products": spark.createDataFrame(products, SOURCE_SCHEMAS["products"]),
        "accounts": spark.createDataFrame(accounts, SOURCE_SCHEMAS["accounts"]),
    }


MART_SCHEMA = ("opportunity_id string, sales_agent string, product string, account string, "
               "deal_stage string, regional_office string, manager string, is_closed int, "
               "won int, cycle_days bigint, days_in_stage bigint, engage_date date, "
               "close_date date, close_value double, sales_price double, sector string")


def mart_rows(spark, rows):
    """Mart-shaped frame from dicts (missing keys are NULL)."""
    cols = [c.split()[0] for c in MART_SCHEMA.split(", ")]
    data = [tuple(r.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(data, MART_SCHEMA)
