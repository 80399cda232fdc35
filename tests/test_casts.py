"""Untrusted text against the database's own safe casts."""

import duckdb
import pytest
from pyspark.sql import functions as F

from dealscope.functions.columns import date_of_text, double_of_text

DATES = ["2017", "2017-05", "2017/05/03", "2017-5-3", "2017-05-03 10:00:00", " 2017-05-03 ", "17-05-03", "2017-13-01",
         "2017-05/03", "20170503", "2017-05-03T00:00:00", "2017.05.03", "2017 05 03", "0001-01-01", "2017-05-03x",
         "2017-02-29", "2016-02-29", "2017-005-03", "+2017-05-03", "", None]
NUMBERS = ["1_000", "1e5", "1E+5", ".5", "5.", "+5", "-5", "inf", "nan", "Infinity", "-inf", "12d", "12f", " 12 ", "1,000",
           "1_000.5", "1__0", "_1", "1_", "1e", "-", "", "1.5e-3", "1 2", "1.0_1", "+ 5", "12.5", None]


@pytest.mark.parametrize("texts, kind, ours", [(DATES, "DATE", date_of_text), (NUMBERS, "DOUBLE", double_of_text)])
def test_casts(spark, texts, kind, ours):
    con = duckdb.connect()
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", ours(F.col("t")).alias("v")).collect()
    for r in rows:
        want = con.execute(f"SELECT TRY_CAST(? AS {kind})", [r.t]).fetchone()[0]
        assert str(r.v) == str(want), r.t
