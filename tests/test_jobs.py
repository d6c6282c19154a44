"""All stages on a small folder of CSV tables."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tallycast.models.boosted import TreeSpec
from tallycast.plans import jobs

D = dt.date
PERIOD = jobs.Period(
    holdout_after=D(2021, 9, 30), forecast_first=D(2022, 1, 1), forecast_last=D(2022, 1, 20),
    warmup_end=D(2021, 2, 1), stable_years=(2020, 2021), full_years=(2020, 2021), base_year=2021)
SPECS = [TreeSpec("squared", "squared", 0.4, 2, min_leaf=5, rounds=1)]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("retail")
    days = [D(2020, 1, 1) + dt.timedelta(days=i) for i in range(731)]
    revenue = [1000 + 200 * math.sin(i / 58) + 50 * (d.weekday() > 4) for i, d in enumerate(days)]
    tables = {
        "sales": ["Date,Revenue,COGS"] + [f"{d},{r:.2f},{r * 0.8:.2f}" for d, r in zip(days, revenue)],
        "promotions": ["promo_id,promo_name,promo_type,discount_value,start_date,end_date,"
                       "applicable_category,promo_channel,stackable_flag,min_order_value",
                       "P1,Spring,percentage,12.0,2020-03-18,2020-04-17,,email,1,0"],
        "orders": ["order_id,order_date,customer_id,zip,order_status,payment_method"] + [
            f"{i},{d},{i % 5},z{i % 2},{'cancelled' if i % 9 == 0 else 'delivered'},card" for i, d in enumerate(days)],
        "order_items": ["order_id,product_id,quantity,unit_price,discount_amount,promo_id"] + [
            f"{i},{i % 3},2,{r / 2:.2f},,{'P1' if i % 4 == 0 else ''}" for i, r in enumerate(revenue)],
        "products": ["product_id,category,segment,size,price,cogs", "0,Streetwear,Std,S,10,5",
                     "1,Outdoor,Std,M,10,8", "2,Streetwear,Pro,L,20,5"],
        "customers": ["customer_id,age_group", "0,55+", "1,55+", "2,25-34", "3,", "4,25-34"],
        "returns": ["product_id,return_reason", "0,late", "0,wrong_size", "2,wrong_size", "1,late"],
        "web_traffic": ["traffic_source,bounce_rate", "email,0.2", "ads,0.4", "ads,0.6"],
        "payments": ["installments,payment_value", "1,10", "6,30", "6,50"],
        "geography": ["zip,region", "z0,East", "z1,West"],
    }
    for name, lines in tables.items():
        (path / f"{name}.csv").write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def out(tmp_path_factory):
    return str(tmp_path_factory.mktemp("out"))


def published(spark, path):
    return spark.read.option("header", True).csv(path).orderBy("Date").collect()


def test_answers(spark, folder):
    got = {name: [tuple(r) for r in df.collect()] for name, df in jobs.answers(spark, folder).items()}
    assert got["median_order_gap"] == [(5.0,)]
    assert got["margin_by_segment"] == [("Pro", 0.75), ("Std", pytest.approx(0.35))]
    assert got["return_reasons"] == [("wrong_size", 2), ("late", 1)]
    assert got["bounce_by_source"] == [("email", 0.2), ("ads", 0.5)]
    assert got["promo_share"] == [(pytest.approx(183 / 731),)]
    assert [g for g, _ in got["orders_per_customer"]] == ["55+", "25-34"]
    # No line has a discount value, so no revenue is known.
    assert got["revenue_by_region"] == [("East", 0.0), ("West", 0.0)]
    assert got["payment_counts"] == [("card", 82)]
    assert got["return_rate_by_size"][0] == ("S", pytest.approx(2 / 244))
    assert got["payment_by_installments"] == [(6, 40.0), (1, 10.0)]


def test_analyze(spark, folder):
    got = {name: df.collect() for name, df in jobs.analyze(spark, folder).items()}
    assert (got["summary"][0].rows, got["summary"][0].first_date) == (731, D(2020, 1, 1))
    assert [r.days for r in sorted(got["yearly"], key=lambda r: r.year)] == [366, 365]
    assert {r.weekday for r in got["by_weekday"]} == {"Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"}
    assert len(got["top_days"]) == 10 and [tuple(r) for r in got["promo_months"]] == [(3, 1)]
    assert {r.period for r in got["events_seen"]} == {"TRAIN", "TEST"}


def test_features_of_the_folder(spark, folder):
    data = jobs.prepare(spark, folder, PERIOD)
    assert len(data.features) == 88 and data.history.count() == 731 and data.future.count() == 20
    assert len(jobs.prepare(spark, folder, PERIOD, lunar_lag=True).features) == 90


def test_search_explanation_and_training_hand_over_files(spark, folder, out):
    space = {"squared": {"step": ("real", 0.3, 0.4), "rounds": ("int", 1, 1), "depth": ("int", 2, 2)}}
    best = jobs.tune(spark, folder, out, period=PERIOD, specs=SPECS, targets=["Revenue"], trials=1, spaces=space)
    assert best.count() == 1
    report = jobs.explain(
        spark, folder, out, period=PERIOD, specs=SPECS, targets=["Revenue"]).collect()
    assert [r["rank"] for r in sorted(report, key=lambda r: r["rank"])] == list(range(1, 16))
    both = {"Revenue": {"squared": 1.0}, "COGS": {"squared": 1.0}}
    run = jobs.train(spark, folder, out, period=PERIOD, specs=SPECS, weights=both, top_n=6)
    assert run.future.count() == 40
    rows = published(spark, f"{out}/published")
    assert len(rows) == 20 and rows[0].Date == "2022-01-01" and float(rows[0].COGS) > 0
    assert spark.read.option("header", True).csv(f"{out}/forecasts").select("variant").distinct().count() == 3
    record = spark.read.json(f"{out}/metadata").first()
    assert record.labels.published_variant == "default" and record.numbers.n_features == 6.0


def test_other_forecasts(spark, folder, tmp_path):
    out = str(tmp_path)
    parts = jobs.forecast_components(
        spark, folder, out, period=PERIOD, specs=SPECS, seeds=(1,), anchor=2000.0)
    assert parts.agg(F.avg("Revenue")).first()[0] == pytest.approx(2000.0)
    walk = jobs.forecast_recursively(spark, folder, out, period=PERIOD, anchors={"Revenue": 900.0, "COGS": 900.0})
    assert walk.where(F.col("COGS") > F.col("Revenue") * 0.98 + 1e-9).count() == 0
    base = jobs.forecast_baseline(spark, folder, out, period=PERIOD)
    assert base.count() == 20
    for name in ("components", "recursive", "baseline"):
        assert len(published(spark, f"{out}/{name}")) == 20


def test_jobs_take_a_panel(spark, folder, tmp_path):
    for name in ("promotions", "order_items"):
        (tmp_path / f"{name}.csv").write_text(open(f"{folder}/{name}.csv").read())
    sales = open(f"{folder}/sales.csv").read().splitlines()
    (tmp_path / "sales.csv").write_text("\n".join(
        [sales[0] + ",series"] + [f"{line},{s}" for s in ("north", "south") for line in sales[1:]] + ["2021-01-01,1,1,"]) + "\n")
    orders = open(f"{folder}/orders.csv").read().splitlines()
    (tmp_path / "orders.csv").write_text("\n".join(
        [orders[0] + ",series"] + [f"{line},{'north' if k % 2 else 'south'}" for k, line in enumerate(orders[1:])]) + "\n")
    out = str(tmp_path / "out")
    parts = jobs.forecast_components(spark, str(tmp_path), out, period=PERIOD, specs=SPECS, seeds=(1,), anchor=2000.0)
    means = {r["series"]: r["m"] for r in parts.groupBy("series").agg(F.avg("Revenue").alias("m")).collect()}
    assert means == {"north": pytest.approx(2000.0), "south": pytest.approx(2000.0)}
    base = jobs.forecast_baseline(spark, str(tmp_path), out, period=PERIOD)
    assert base.groupBy("series").count().collect() and base.count() == 40
    walk = jobs.forecast_recursively(
        spark, str(tmp_path), out, period=PERIOD, anchors={"Revenue": 900.0, "COGS": 700.0}, trees=SPECS[0])
    assert walk.count() == 40 and spark.read.json(f"{out}/recursive_metadata").first().labels.model == "squared"
