"""Property-based checks (hypothesis) for the exactness-critical helpers."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dealscope.functions.text import fixed, percent
from dealscope.operators import ranking

finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(finite, min_size=1, max_size=300))
def test_fixed_equals_python_format(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    rows = df.select("x", *[fixed(F.col("x"), d).alias(f"f{d}") for d in range(4)],
                     percent(F.col("x"), 1).alias("p1")).collect()
    for r in rows:
        x = r.x + 0.0                                  # -0.0 prints like 0.0 here
        if x == 0:
            continue
        assert [r.f0, r.f1, r.f2, r.f3] == [f"{x:.{d}f}" for d in range(4)]
        if abs(x) < 1e4:
            assert r.p1 == f"{x:.1%}"


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(min_value=-50, max_value=50), min_size=1, max_size=200),
       st.sampled_from([0.0, 0.25, 0.5, 0.75, 0.9, 1.0]))
def test_exact_quantile_equals_percentile(spark, values, q):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    expected = df.agg(F.percentile("x", q)).first()[0]
    assert abs(ranking.exact_quantile(df, "x", q, ranges=4) - expected) < 1e-9
