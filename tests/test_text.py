import math
import random

from pyspark.sql import functions as F

from dealscope.functions.text import deal_prompt, deal_summary, fixed, percent


def test_fixed_matches_python_half_even(spark):
    random.seed(3)
    vals = [0.125, 0.135, 2.675, 12.5, 0.5, 1.5, 2.5, 0.0, 99.995, 1.005, 107 / 40, -2.675]
    vals += [random.random() * 10 ** random.randint(-3, 4) for _ in range(400)]
    vals += [random.randint(0, 100000) / 1000 for _ in range(400)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    out = df.select("x", *[fixed(F.col("x"), d).alias(f"f{d}") for d in range(4)],
                    percent(F.col("x"), 0).alias("p0"), percent(F.col("x"), 1).alias("p1")).collect()
    for r in out:
        assert [r.f0, r.f1, r.f2, r.f3] == [f"{r.x:.{d}f}" for d in range(4)], r.x
        assert r.p0 == f"{r.x:.0%}" and r.p1 == f"{r.x:.1%}", r.x


def _summary_row(spark, **kw):
    cols = dict(sales_agent=None, product=None, propensity_to_close=None, days_in_stage=None,
                historical_stage_norm_days=None, stall_ratio=None)
    cols.update(kw)
    df = spark.createDataFrame(
        [tuple(cols.values())],
        "sales_agent string, product string, propensity_to_close double, days_in_stage double, "
        "historical_stage_norm_days double, stall_ratio double")
    return df.select(deal_summary(F.col("sales_agent"), F.col("product"),
                                  F.col("propensity_to_close"), F.col("days_in_stage"),
                                  F.col("historical_stage_norm_days"),
                                  F.col("stall_ratio")).alias("s")).first().s


def test_summary_wording(spark):
    text = _summary_row(spark, sales_agent="Ada", product="MG Special", propensity_to_close=0.073, days_in_stage=41.0,
                        historical_stage_norm_days=96.5, stall_ratio=0.42)
    assert text == ("Ada's MG Special opportunity has a 7% close propensity and has spent 41 days in Engaging, "
                    "near the 96-day historical norm; prioritize a next-step check before forecast review.")


def test_fixed_outside_the_usual_range(spark):
    rng = random.Random(8)
    vals = [-0.0, -0.001, float("nan"), float("inf"), float("-inf"), 9007199254740994.0, 1e17, -1e17, 2.0 ** 50 + 0.25,
            2.0 ** 51 + 0.5, 572888770885057.1, 1.2345678901234567e25, 9.9e37]
    vals += [rng.uniform(-1, 1) * 10 ** rng.randrange(10, 37) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for r in df.select("x", *[fixed(F.col("x"), d).alias(f"f{d}") for d in range(4)]).collect():
        assert [r.f0, r.f1, r.f2, r.f3] == [f"{r.x:.{d}f}" for d in range(4)], r.x
    odd = spark.createDataFrame([(None,), (1e39,)], "x double").select(fixed(F.col("x"), 2).alias("t")).collect()
    assert [r.t for r in odd] == [None, None]


def test_summary_edges(spark):
    assert "12% close" in _summary_row(spark, propensity_to_close=0.125)   # half-even
    assert "14% close" in _summary_row(spark, propensity_to_close=0.135)
    t = _summary_row(spark, propensity_to_close=float("nan"), stall_ratio=None)
    assert t.startswith("the assigned rep's this product opportunity has a 0% close")
    assert "near the 0-day" in t
    assert "above the" in _summary_row(spark, stall_ratio=2.0)
    assert "well beyond the" in _summary_row(spark, stall_ratio=3.0)
    assert "spent 85 days" in _summary_row(spark, days_in_stage=85.9)          # truncation


def test_prompt_formats_and_missing(spark):
    df = spark.createDataFrame(
        [("1", "R", "P", "A", 0.4235, 10.0, 80.5, 2.675), ("2", None, None, None, 0.5, None, 1.0, 1.0)],
        "id string, rep string, product string, account string, p double, d double, n double, r double")
    rows = df.select("id", deal_prompt(F.col("id"), F.col("rep"), F.col("product"), F.col("account"),
                                       F.col("p"), F.col("d"), F.col("n"), F.col("r")).alias("t")) \
        .orderBy("id").collect()
    assert rows[0].t.endswith("opportunity=1; rep=R; product=P; account=A; close_propensity=0.423; "
                              "days_in_engaging=10; historical_norm_days=80; stall_ratio=2.67.")
    assert rows[1].t is None
    assert math.isclose(2.675, 2.675)
