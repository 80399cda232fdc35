"""CSV sources with explicit schema, derived-table sinks and the model bundle."""

import csv
import os

from pyspark.sql import functions as F

from dealscope.operators import models, splits
from dealscope.plans.queries import load_mart
from dealscope.plans.warehouse import build_warehouse
from dealscope.sources.readers import read_sources
from dealscope.sources.sinks import load_bundle, read_metrics, save_bundle, write_csv, write_metrics

from .conftest import SF_SMALL
from .fixtures import ACCOUNTS_ROWS, PIPELINE_ROWS, PRODUCTS_ROWS, TEAMS_ROWS

HEADERS = {
    "sales_pipeline": ["opportunity_id", "sales_agent", "product", "account", "deal_stage",
                       "engage_date", "close_date", "close_value"],
    "accounts": ["account", "sector", "year_established", "revenue", "employees",
                 "office_location", "subsidiary_of"],
    "products": ["product", "series", "sales_price"],
    "sales_teams": ["sales_agent", "manager", "regional_office"],
}


def _write(path, header, rows):
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        for r in rows:
            w.writerow(["" if v is None else v for v in r])


def test_csv_sources_to_warehouse(spark, scratch):
    rows = {"sales_pipeline": PIPELINE_ROWS, "accounts": ACCOUNTS_ROWS,
            "products": PRODUCTS_ROWS, "sales_teams": TEAMS_ROWS}
    paths = {}
    for name, data in rows.items():
        paths[name] = os.path.join(scratch, f"{name}.csv")
        _write(paths[name], HEADERS[name], data)
    sources = read_sources(spark, paths)
    assert sources["sales_pipeline"].schema["engage_date"].dataType.simpleString() == "string"
    tables = build_warehouse(spark, sources, os.path.join(scratch, "wh"))
    mart = {r.opportunity_id: r for r in tables["mart_opportunities"].collect()}
    assert mart["o4"].engage_date is None and mart["o7"].account == "Acme"
    assert mart["o2"].account is None                      # empty CSV field -> NULL
    stalled = tables["stalled_deals"].collect()
    assert {r.opportunity_id for r in stalled} == {"o3", "o4", "o8"}


def test_csv_columns_go_by_name_and_quotes_by_the_book(spark, scratch):
    import pytest

    from dealscope.sources.readers import MissingColumnError, read_source
    path = os.path.join(scratch, "products.csv")
    with open(path, "w", newline="") as fh:
        fh.write('series,extra,product,sales_price\r\nGTX,x,"GTX ""Pro"", X",12\r\nMG,y,"two\nlines",\r\n')
    rows = read_source(spark, "products", path).collect()
    assert [tuple(r) for r in rows] == [('GTX "Pro", X', "GTX", "12"), ("two\nlines", "MG", None)]
    write_csv(read_source(spark, "products", path), os.path.join(scratch, "again"))
    assert read_source(spark, "products", os.path.join(scratch, "again")).collect() == rows
    with open(path, "w") as fh:
        fh.write("product,series\na,b\n")
    with pytest.raises(MissingColumnError, match="sales_price"):
        read_source(spark, "products", path)


def test_metrics_json_is_nested(spark, scratch):
    import glob
    import json
    write_metrics(spark, {"cross_validation": {"m": {"mean": 0.5}}}, os.path.join(scratch, "n"))
    with open(glob.glob(os.path.join(scratch, "n", "part-*"))[0]) as fh:
        assert json.loads(fh.read()) == {"cross_validation": {"m": {"mean": 0.5}}}


def test_rewritten_table_is_read_again(spark, scratch):
    from dealscope.sources.readers import read_table
    for n in (3, 5):
        spark.range(n).write.mode("overwrite").parquet(os.path.join(scratch, "t.parquet"))
        assert read_table(spark, scratch, "t").count() == n


def test_versions_see_nested_files(spark, scratch):
    """A file rewritten deep inside a partitioned folder gives another version, whatever the folder's own time."""
    from dealscope.sources.readers import table_versions
    path = os.path.join(scratch, "t.parquet")
    spark.range(6).selectExpr("id", "id % 2 AS k").write.partitionBy("k").parquet(path)
    stamp = os.stat(path)
    before = table_versions(spark, [path])
    assert table_versions(spark, [path]) == before
    spark.range(9).select("id").write.mode("overwrite").parquet(os.path.join(path, "k=1"))
    os.utime(path, ns=(stamp.st_atime_ns, stamp.st_mtime_ns))
    assert table_versions(spark, [path]) != before


def test_metrics_round_trip(spark, scratch):
    m = {"a": 1, "b": 0.5, "c": "x", "nested": {"k": {"v": 1.5}}}
    write_metrics(spark, m, os.path.join(scratch, "m"))
    assert read_metrics(spark, os.path.join(scratch, "m")) == m


def test_bundle_round_trip(spark, scratch):
    mart = load_mart(spark, SF_SMALL)
    closed = splits.with_holdout(models.model_frame(mart))
    train = closed.filter(F.col("split") == "train")
    test = closed.filter(F.col("split") == "test")
    model = models.fit(train, models.LOGISTIC)
    preds = model.score(test).select("opportunity_id", F.col("target").alias("actual_won"),
                                     "propensity_to_close")
    save_bundle(model, {"selected_model": models.LOGISTIC}, preds, os.path.join(scratch, "b"))
    back = load_bundle(spark, os.path.join(scratch, "b"))
    assert back["feature_names"] == model.feature_names()
    assert back["metrics"]["selected_model"] == models.LOGISTIC
    again = back["model"].transform(test).select("opportunity_id", "probability").collect()
    orig = {r.opportunity_id: r.propensity_to_close for r in preds.collect()}
    assert all(abs(r.probability[1] - orig[r.opportunity_id]) < 1e-12 for r in again)
    assert back["test_predictions"].count() == len(orig)


def test_artifact_reader(spark, scratch):
    from dealscope.operators import scoring
    from dealscope.sources.sinks import read_artifacts, write_table
    scores = scoring.score_open_standin(load_mart(spark, SF_SMALL))
    write_table(scores, os.path.join(scratch, "open_deal_scores"))
    write_table(scores.select("opportunity_id").limit(3), os.path.join(scratch, "top_contributions"))
    write_metrics(spark, {"selected_model": "x"}, os.path.join(scratch, "bundle", "metrics"))
    art = read_artifacts(spark, scratch)
    assert art["scores"].count() == scores.count()
    assert art["metrics"].first().selected_model == "x"
