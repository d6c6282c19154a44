"""Reading, checking, caching and writing tables."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallycast.sources import inputs, sinks
from tallycast.sources.schemas import schema_of, table_names
from tallycast.sources.tables import read_csv_table, read_parquet_table

D = dt.date


def test_csv_tables_are_typed_by_name(spark, tmp_path):
    (tmp_path / "promotions.csv").write_text(
        "promo_id,promo_name,promo_type,discount_value,start_date,end_date,applicable_category,"
        "promo_channel,stackable_flag,min_order_value,extra\n"
        "P1,Spring,percentage,12.0,2013-03-18,2013-04-17,,email,1,0,x\n"
        "P2,Mid,fixed,NaN,2013-06-23 00:00:00,n/a,Outdoor,online,0,50000,y\n")
    df = read_csv_table(spark, str(tmp_path), "promotions")
    assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in schema_of("promotions")]
    first, second = df.orderBy("promo_id").collect()
    assert (first.discount_value, first.start_date, first.applicable_category) == (12.0, D(2013, 3, 18), None)
    assert (second.discount_value, second.start_date, second.end_date, second.min_order_value) == (
        None, D(2013, 6, 23), None, 50000)
    assert len(table_names()) == 11


def test_parquet_dates(spark):
    df = read_parquet_table(spark, "/root/testdata/sf0.001", "orders", dates=["o_orderdate"])
    assert dict(df.dtypes)["o_orderdate"] == "date"


def test_missing_inputs_are_named(spark, tmp_path):
    for name in ("orders", "sales"):
        (tmp_path / f"{name}.csv").write_text("a\n")
    absent = inputs.missing_inputs(spark, str(tmp_path), tables=("orders", "sales", "returns"))
    assert [r.file for r in absent.collect()] == ["returns.csv"]
    inputs.require_inputs(spark, str(tmp_path), tables=("orders",))
    with pytest.raises(FileNotFoundError, match="geography.csv"):
        inputs.require_inputs(spark, str(tmp_path))
    assert inputs.missing_inputs(spark, str(tmp_path / "none"), tables=("orders",)).count() == 1


def test_cached_table_is_reused_unless_forced(spark, tmp_path):
    path, built = str(tmp_path / "cache"), []

    def build(n):
        built.append(n)
        return spark.range(n)

    assert inputs.cached_table(spark, path, lambda: build(3)).count() == 3
    assert inputs.cached_table(spark, path, lambda: build(5)).count() == 3
    assert inputs.cached_table(spark, path, lambda: build(5), force=True).count() == 5
    assert built == [3, 5]


def test_parameters_are_optional(spark, tmp_path):
    path = tmp_path / "params"
    assert inputs.read_parameters(spark, str(path)) == {}
    path.mkdir()
    rows = [{"target": "Revenue", "model": "deep", "params": {"step": 0.1}, "score": 0.3},
            {"target": "Revenue", "model": "deep", "params": {"step": 0.2}, "score": 0.2}]
    (path / "p.json").write_text("\n".join(map(json.dumps, rows)))
    assert inputs.read_parameters(spark, str(path)) == {("Revenue", "deep"): {"step": 0.2}}


def test_forecast_files(spark, tmp_path):
    df = spark.createDataFrame(
        [("default", D(2023, 1, 2), -1.0, 2.125), ("default", D(2023, 1, 1), 1.375, None),
         ("global", D(2023, 1, 1), 5.0, 6.0)], "variant string, Date date, Revenue double, COGS double")
    rows = sinks.publish_variant(df).orderBy("Date").collect()
    assert [tuple(r) for r in rows] == [("2023-01-01", 1.38, None), ("2023-01-02", 0.0, 2.12)]
    sinks.write_forecasts(df, str(tmp_path / "out"))
    again = spark.read.option("header", True).csv(str(tmp_path / "out"))
    assert sorted((r.variant, r.Date) for r in again.collect()) == [
        ("default", "2023-01-01"), ("default", "2023-01-02"), ("global", "2023-01-01")]
    texts = [p.read_text().split() for p in sorted((tmp_path / "out" / "variant=default").glob("*.csv"))]
    assert [line.split(",")[0] for text in texts for line in text[1:]] == ["2023-01-01", "2023-01-02"]


def test_metadata_and_importance_round_trip(spark, tmp_path):
    record = sinks.run_metadata(
        spark, numbers={"n": 88.0}, labels={"best": "per_q"}, scores={"Revenue": {"mae": 1.5}})
    sinks.write_metadata(record, str(tmp_path / "meta"))
    back = spark.read.json(str(tmp_path / "meta")).first()
    assert (back.numbers.n, back.labels.best, back.scores.Revenue.mae) == (88.0, "per_q", 1.5)
    table = spark.createDataFrame([("m", "f", 0.25)], "model string, feature string, importance double")
    sinks.write_importance(table.select("feature", "model", "importance"), str(tmp_path / "imp"))
    assert sinks.read_importance(spark, str(tmp_path / "imp")).select(
        "model", "feature", "importance").collect() == table.collect()
    wide = table.select("feature", F.col("importance").alias("a"), F.col("importance").alias("total"))
    sinks.write_importance(wide, str(tmp_path / "wide"))
    assert sinks.read_importance(spark, str(tmp_path / "wide")).first().total == 0.25
