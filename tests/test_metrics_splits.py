import random

from pyspark.sql import functions as F

from dealscope.operators import metrics, ranking, splits


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    if not pos or not neg:
        return None
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def brute_ap(rows):
    P = sum(y for y, _ in rows)
    ap, tp, fp = 0.0, 0, 0
    for s in sorted({s for _, s in rows}, reverse=True):
        grp = [y for y, t in rows if t == s]
        tp += sum(grp)
        fp += len(grp) - sum(grp)
        ap += (sum(grp) / P) * tp / (tp + fp)
    return ap


def test_auc_ap_with_ties(spark):
    random.seed(5)
    rows = [(random.randint(0, 1), random.randint(0, 20) / 20) for _ in range(400)]
    df = spark.createDataFrame(rows, "target int, score double")
    assert abs(metrics.auc(df).first().auc - brute_auc(rows)) < 1e-12
    assert abs(metrics.average_precision(df).first().average_precision - brute_ap(rows)) < 1e-9


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.7)], "target int, score double")
    assert metrics.auc(df).first().auc is None


def test_accuracy_brier(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.2), (1, 0.4), (0, 0.9)], "target int, score double")
    r = metrics.accuracy_brier(df).first()
    assert r.accuracy == 0.5
    assert abs(r.brier - (0.25 + 0.04 + 0.36 + 0.81) / 4) < 1e-10


def test_running_sums_match_cumsum(spark):
    random.seed(2)
    vals = random.sample(range(100000), 3000)
    df = spark.createDataFrame([(float(v), 1.0, float(v % 7)) for v in vals], "k double, a double, b double")
    out = ranking.running_sums(df, "k", ["a", "b"], ranges=16).orderBy("k").collect()
    ca = cb = 0.0
    for r in out:
        ca += r.a
        cb += r.b
        assert r.cum_a == ca and r.cum_b == cb
    desc = ranking.running_sums(df, "k", ["a"], descending=True, ranges=16).orderBy(F.desc("k")).collect()
    assert [r.cum_a for r in desc] == [float(i + 1) for i in range(len(desc))]


def test_rank_within_exact_and_keeps_nulls(spark):
    random.seed(4)
    rows = [(f"id{i}", i % 3 == 0, random.getrandbits(32)) for i in range(2000)]
    rows += [(None, True, None), ("x", None, 7), (None, None, None), ("y", False, None)]
    df = spark.createDataFrame(rows, "id string, label boolean, h bigint")
    for bits in (6, None):
        out = ranking.rank_within(df, ["label"], "h", "id", bits=bits).collect()
        assert len(out) == len(rows)
        for lab in (True, False, None):
            mine = sorted((r._rank, r.id) for r in out if r.label == lab)
            ref = sorted(((-1 if h is None else h, i or "") for i, label, h in rows if label == lab))
            assert [i or "" for _, i in mine] == [i for _, i in ref]
            assert [rk for rk, _ in mine] == list(range(len(ref)))
            assert {r._size for r in out if r.label == lab} == {len(ref)}


def test_splits_keep_rows_without_id_or_label(spark):
    rows = [(f"o{i}", i % 2) for i in range(20)] + [(None, 1), ("z", None)]
    df = spark.createDataFrame(rows, "opportunity_id string, target int")
    assert splits.with_holdout(df).count() == 22 and splits.with_folds(df).count() == 22


def test_splits_are_stratified_and_disjoint(spark):
    rows = [(f"o{i}", 1 if i % 3 else 0) for i in range(999)]
    df = spark.createDataFrame(rows, "opportunity_id string, target int")
    h = splits.with_holdout(df).collect()
    for lab in (0, 1):
        n = sum(1 for r in h if r.target == lab)
        t = sum(1 for r in h if r.target == lab and r.split == "test")
        assert t == -(-n // 4)                      # ceil(n / 4)
    f = splits.with_folds(df).collect()
    for lab in (0, 1):
        sizes = [sum(1 for r in f if r.target == lab and r.fold == k) for k in range(5)]
        assert max(sizes) - min(sizes) <= 1
    assert len({r.opportunity_id for r in f}) == 999


def test_temporal_split(spark):
    df = spark.createDataFrame([("a", "2017-01-01"), ("b", "2017-06-01"), ("c", "2017-10-01"),
                                ("d", "2017-12-01"), ("e", None)], "opportunity_id string, d string") \
        .withColumn("close_date", F.to_date("d"))
    out = {r.opportunity_id: r.split for r in splits.with_temporal(df, "2017-10-01").collect()}
    assert out == {"a": "train", "b": "train", "c": "test", "d": "test", "e": None}


def test_exact_quantile_matches_percentile(spark):
    random.seed(9)
    vals = [float(random.randint(0, 40)) for _ in range(700)] + [random.random() * 100 for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for q in (0.0, 0.25, 0.5, 0.75, 0.9, 1.0):
        exact = df.agg(F.percentile("x", q)).first()[0]
        got = ranking.exact_quantile(df, "x", q, ranges=8)
        assert abs(got - exact) < 1e-9, (q, got, exact)
    assert ranking.exact_quantile(df.limit(0), "x", 0.5) is None


def test_medians_of_several_columns(spark):
    from dealscope.operators import features
    df = spark.createDataFrame([(1.0, 5.0, None), (2.0, 5.0, None), (4.0, 6.0, None), (9.0, None, None)], "a double, b double, c double")
    assert features.medians(df, ["a", "b", "c"]) == {"a": 3.0, "b": 5.0, "c": None}


def test_all_metrics_agree_with_the_single_ones(spark):
    random.seed(6)
    rows = [(random.randint(0, 1), random.randint(0, 9) / 9) for _ in range(200)]
    df = spark.createDataFrame(rows, "target int, score double")
    m = metrics.all_metrics(df).first()
    assert m.auc == metrics.auc(df).first().auc
    assert m.average_precision == metrics.average_precision(df).first().average_precision
    single = metrics.accuracy_brier(df).first()
    assert m.accuracy == single.accuracy and abs(m.brier - single.brier) < 1e-12


def test_auc_equals_spark_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    random.seed(11)
    rows = [(float(random.randint(0, 1)), random.randint(0, 30) / 30) for _ in range(500)]
    df = spark.createDataFrame(rows, "target double, score double")
    ours = metrics.auc(df).first().auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="target",
                                       metricName="areaUnderROC", numBins=0).evaluate(df)
    assert abs(ours - ev) < 1e-12


def test_auc_by_part_equals_each_part_alone(spark):
    rows = [(p, i % 2, None if i % 11 == 0 else float((i * 7 + p) % 13)) for p in range(3) for i in range(40)] + [(3, 1, None), (4, 1, 0.5)]
    df = spark.createDataFrame(rows, "part int, target int, score double")
    found = {r["part"]: r["auc"] for r in metrics.auc_by(df, ["part"], "target", "score").collect()}
    assert found == {p: metrics.auc(df.where(f"part = {p}"), "target", "score").first()["auc"] for p in (0, 1, 2, 4)} and found[4] is None
