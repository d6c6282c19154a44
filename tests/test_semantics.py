"""Null, tie and rounding rules on inline rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallycast.functions import scalars
from tallycast.operators import aggregates, blend, metrics, panel, ranking, reshape
from tallycast.operators.intervals import active_by_day, nearest_event_offset
from tallycast.plans import dashboard, diagnostics, questions

D = dt.date


def one(df):
    (row,) = df.collect()
    return row


def values(spark, column, source="0.0"):
    return [r[0] for r in spark.sql(f"SELECT explode(array({source})) AS v").select(column).collect()]


def test_clip_and_cap_keep_null(spark):
    df = spark.createDataFrame([(None, 1.0), (-2.0, 1.0), (3.0, None), (3.0, 2.0)], "a double, b double")
    rows = df.select(scalars.at_least(F.col("a"), 0.0).alias("low"),
                     scalars.at_most(F.col("a"), F.col("b")).alias("cap")).collect()
    assert [r.low for r in rows] == [None, 0.0, 3.0, 3.0]
    assert [r.cap for r in rows] == [None, -2.0, None, 2.0]


def test_rounding_goes_to_the_even_digit(spark):
    got = values(spark, scalars.round_half_even(F.col("v"), 0), "0.5D, 1.5D, 2.5D, -0.5D, -1.5D")
    assert got == [0.0, 2.0, 2.0, 0.0, -2.0]
    assert values(spark, scalars.round_half_even(F.col("v"), 2), "0.125D, 0.375D") == [0.12, 0.38]


def test_ratio_differs_and_dates(spark):
    df = spark.createDataFrame([("cancelled", "2023-02-29"), (None, "2024-02-29"), ("x", "n/a")], "s string, d string")
    kept = df.where(scalars.differs(F.col("s"), "cancelled"))
    assert [r.s for r in kept.collect()] == [None, "x"]
    assert [r[0] for r in df.select(scalars.parse_date(F.col("d"))).collect()] == [None, D(2024, 2, 29), None]
    assert values(spark, scalars.ratio(F.lit(1.0), F.col("v")), "0.0D, 4.0D") == [None, 0.25]
    assert values(spark, scalars.label_for(F.col("v"), {"a": "A"}, "-"), "'a', 'b', null") == ["A", "-", "-"]


def test_unknown_discount_differs_between_the_two_revenues(spark):
    df = spark.createDataFrame([(2, 5.0, None), (2, 5.0, 1.0)], "q int, p double, d double")
    cols = [F.col(c) for c in "qpd"]
    assert [r[0] for r in df.select(scalars.line_revenue(*cols)).collect()] == [None, 9.0]
    assert [r[0] for r in df.select(scalars.line_revenue_filled(*cols)).collect()] == [10.0, 9.0]


def test_order_gaps_count_same_day_orders_as_zero(spark):
    rows = [(1, D(2020, 1, 1)), (1, D(2020, 1, 1)), (1, D(2020, 1, 11)), (2, D(2020, 1, 1)),
            (None, D(2020, 1, 5)), (2, None), (2, D(2020, 1, 4))]
    orders = spark.createDataFrame(rows, "customer_id bigint, order_date date")
    # gaps: 0, 10 (customer 1), 3 (customer 2)
    assert one(questions.median_order_gap(orders)).median_gap == 3.0


def test_questions_skip_missing_keys_and_keep_missing_sides(spark):
    products = spark.createDataFrame(
        [(1, "Streetwear", "Std", "S", 10.0, 5.0), (2, "Outdoor", None, "M", 10.0, 8.0),
         (3, "Streetwear", "Std", "L", 0.0, 1.0)],
        "product_id bigint, category string, segment string, size string, price double, cogs double")
    assert [tuple(r) for r in questions.margin_by_segment(products).collect()] == [("Std", 0.5)]
    items = spark.createDataFrame([(1,), (1,), (2,), (None,)], "product_id bigint")
    returns = spark.createDataFrame(
        [(1, "late"), (3, "late"), (3, "broken"), (None, "late"), (2, "late")], "product_id bigint, return_reason string")
    rates = questions.return_rate_by_size(items, returns, products).collect()
    assert [tuple(r) for r in rates] == [("M", 1.0), ("S", 0.5), ("L", None)]
    reasons = questions.return_reasons(returns, products, "Streetwear").collect()
    assert [tuple(r) for r in reasons] == [("late", 2), ("broken", 1)]
    sold = questions.return_rate_by_size(items, returns.where("product_id = 1"), products).collect()
    assert {r.size: r.return_rate for r in sold} == {"S": 0.5, "M": None}


def test_revenue_by_region_without_known_discount_is_zero(spark):
    orders = spark.createDataFrame(
        [(1, "delivered", "z1"), (2, "delivered", "z2"), (3, "cancelled", "z1"), (4, "delivered", None)],
        "order_id bigint, order_status string, zip string")
    items = spark.createDataFrame(
        [(1, 2, 5.0, 1.0), (1, 1, 4.0, None), (2, 1, 9.0, None), (3, 1, 99.0, 0.0), (4, 1, 7.0, 0.0)],
        "order_id bigint, quantity int, unit_price double, discount_amount double")
    geo = spark.createDataFrame([("z1", "East"), ("z2", "West"), (None, "Null")], "zip string, region string")
    got = questions.revenue_by_region(orders, items, geo).collect()
    assert [tuple(r) for r in got] == [("East", 9.0), ("West", 0.0)]


def test_sums_by_dimension_counts_repeated_dimension_keys(spark):
    fact = spark.createDataFrame([(1, 2.0), (1, 3.0), (None, 9.0)], "k bigint, v double")
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k bigint, g string")
    got = aggregates.sums_by_dimension(fact, dim, on="k", by="g", measures={"v": F.col("v")})
    assert sorted(map(tuple, got.collect())) == [("a", 5.0), ("b", 5.0)]


def test_orders_and_promo_shares(spark):
    orders = spark.createDataFrame([(1, 7), (2, 7), (3, 8), (4, None)], "order_id bigint, customer_id bigint")
    people = spark.createDataFrame([(7, "old"), (8, "old"), (9, None)], "customer_id bigint, age_group string")
    assert one(questions.orders_per_customer(orders, people)).orders_per_customer == 1.5
    items = spark.createDataFrame([("p",), (None,), (None,), (None,)], "promo_id string")
    assert one(questions.promo_share(items)).promo_share == 0.25


def test_daily_components_keep_unknown_status_and_drop_days_without_lines(spark):
    orders = spark.createDataFrame(
        [(1, None, D(2020, 1, 1)), (2, "cancelled", D(2020, 1, 1)), (3, "ok", D(2020, 1, 1)),
         (4, "ok", D(2020, 1, 2))], "order_id bigint, order_status string, order_date date")
    items = spark.createDataFrame(
        [(1, 2, 5.0, None), (2, 1, 100.0, 0.0)],
        "order_id bigint, quantity int, unit_price double, discount_amount double")
    row = one(panel.daily_components(orders, items))
    assert (row.Date, row.n_orders, row.rev_recon, row.aov) == (D(2020, 1, 1), 2, 10.0, 5.0)


def test_components_through_a_dimension_equal_the_direct_ones(spark):
    orders = spark.createDataFrame(
        [(i, i % 7, "ok", D(2020, 1, 1 + i % 5)) for i in range(200)],
        "order_id bigint, customer_id bigint, order_status string, order_date date")
    items = spark.createDataFrame(
        [(i % 180, 1, float(i), 0.0) for i in range(500)],
        "order_id bigint, quantity int, unit_price double, discount_amount double")
    people = spark.createDataFrame([(c, "ab"[c % 2]) for c in range(7)], "customer_id bigint, series string")
    direct = panel.daily_components(orders.join(people, "customer_id"), items, keys=["series"])
    through = panel.daily_components(orders, items, keys=["series"], dimension=people, on="customer_id")
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, through.collect()))


def test_densify_fills_gaps_and_extends(spark):
    df = spark.createDataFrame([("a", D(2020, 2, 27), 1.0), ("a", D(2020, 3, 1), 2.0), ("b", D(2020, 1, 1), 3.0)],
                               "series string, Date date, y double")
    got = sorted(map(tuple, panel.densify(df, keys=["series"], fill={"y": 0.0}).collect()))
    assert got == [("a", D(2020, 2, 27), 1.0), ("a", D(2020, 2, 28), 0.0), ("a", D(2020, 2, 29), 0.0),
                   ("a", D(2020, 3, 1), 2.0), ("b", D(2020, 1, 1), 3.0)]
    longer = panel.densify(df, keys=["series"], fill={"y": 0.0}, until=D(2020, 3, 3))
    assert longer.where("series = 'a'").count() == 6


def test_active_intervals_are_inclusive_and_clipped(spark):
    days = spark.sql("SELECT explode(sequence(date'2019-12-30', date'2020-01-04')) AS Date")
    promos = spark.createDataFrame([
        (D(2019, 12, 1), D(2019, 12, 31), 10.0, "Streetwear"), (D(2019, 12, 31), D(2019, 12, 31), 5.0, None),
        (D(2020, 1, 3), D(2021, 1, 1), 7.5, "Outdoor"), (D(2020, 1, 2), D(2020, 1, 1), 99.0, "Outdoor"),
        (D(2020, 1, 1), None, 99.0, "Outdoor")],
        "start_date date, end_date date, discount_value double, applicable_category string")
    got = {r.Date.day: tuple(r)[1:] for r in active_by_day(days, promos).collect()}
    assert got == {30: (1, 10.0, 1, 0), 31: (2, 15.0, 1, 0), 1: (0, 0.0, 0, 0), 2: (0, 0.0, 0, 0),
                   3: (1, 7.5, 0, 1), 4: (1, 7.5, 0, 1)}


def test_nearest_event_prefers_the_earlier_on_equal_distance(spark):
    days = spark.createDataFrame([(D(2020, 1, 11),), (D(2020, 1, 12),), (D(2020, 6, 1),)], "Date date")
    events = spark.createDataFrame([(D(2020, 1, 1),), (D(2020, 1, 21),)], "event_date date")
    got = {r.Date: r.tet_days_diff for r in nearest_event_offset(days, events).collect()}
    assert got == {D(2020, 1, 11): 10, D(2020, 1, 12): -9, D(2020, 6, 1): 999}


def test_ranking_ties_samples_and_names(spark):
    df = spark.createDataFrame([("m", "b", 2.0), ("m", "a", 2.0), ("m", "c", 1.0), ("n", "z", None)],
                               "model string, feature string, v double")
    assert [r.feature for r in ranking.top_rows(df, "v", 2, "feature").collect()] == ["a", "b"]
    top = ranking.ranked(df, "v", 2, within=["model"], ties=["feature"]).collect()
    assert sorted((r.model, r["rank"], r.feature) for r in top) == [("m", 1, "a"), ("m", 2, "b"), ("n", 1, "z")]
    assert [r.feature for r in aggregates.value_counts(df, "feature").collect()] == ["a", "b", "c", "z"]
    many = spark.range(5000)
    first = ranking.fixed_sample(many.repartition(7), 100, keys=["id"]).collect()
    again = ranking.fixed_sample(many.coalesce(1), 100, keys=["id"]).collect()
    assert first == again and len(set(first)) == 100
    kept = df.where("v = 2")
    assert sorted(r.feature for r in reshape.names_not_in(df, kept, "feature").collect()) == ["c", "z"]
    wide = reshape.to_wide(df.where("model = 'm'"), key="feature", column="model", values=["m", "n"], value="v")
    assert {r.feature: (r.m, r.n, r.total) for r in wide.collect()}["a"] == (2.0, 0.0, 2.0)


def test_blends_and_anchors(spark):
    assert blend.usable_weights({"a": 0.3, "b": 0.3, "c": 0.15, "d": 0.25}, ["a", "b", "c"]) == {
        "a": 0.55, "b": 0.3, "c": 0.15}
    assert blend.usable_weights({"a": 0.5, "b": 0.0, "c": 0.5}, ["a", "b", "c"]) == {"a": 0.5, "c": 0.5}
    df = spark.createDataFrame([("s", D(2020, 1, i), float(i), 9.0) for i in (1, 2, 3)],
                               "series string, Date date, Revenue double, COGS double")
    anchored = blend.anchor_to_mean(df, {"Revenue": 100.0}, keys=["series"])
    assert one(anchored.agg(F.avg("Revenue")))[0] == pytest.approx(100.0)
    assert [r.COGS for r in blend.cap_cogs(df).orderBy("Date").collect()] == [0.98, 1.96, 2.94]
    same = blend.blend_tables(df, df, share=0.7, keys=["series", "Date"])
    assert [r.Revenue for r in same.orderBy("Date").collect()] == pytest.approx([1.0, 2.0, 3.0])
    missing = df.withColumn("Revenue", F.lit(None).cast("double"))
    assert {r.COGS for r in blend.cap_cogs(missing).collect()} == {None}


def test_metrics_formulas_and_ties(spark):
    df = spark.createDataFrame([("v", 1.0, 2.0), ("v", 2.0, 2.0), ("v", 4.0, 1.0), ("v", 0.0, 0.0)],
                               "variant string, y double, yhat double")
    row = one(metrics.regression_metrics(df, keys=["variant"]))
    assert (row.mae, row.rmse) == (1.0, pytest.approx(2.5 ** 0.5))
    assert row.r2 == pytest.approx(1 - 10.0 / 8.75)
    assert one(metrics.mape(df, keys=["variant"])).mape == pytest.approx((1 + 0 + 0.75) / 3 * 100)
    scores = spark.createDataFrame([("b", "x", 1.0), ("a", "x", 1.0), ("c", "x", 2.0)],
                                   "variant string, target string, mae double")
    assert one(metrics.best_variant(scores)).variant == "a"


def test_diagnostics_round_before_margin_and_growth(spark):
    sales = spark.createDataFrame(
        [("s", D(2020, 1, 1), 100.4, 40.0), ("s", D(2021, 1, 1), 150.6, 75.4), ("s", D(2021, 1, 2), None, 75.4)],
        "series string, Date date, Revenue double, COGS double")
    rows = {r.year: r for r in diagnostics.yearly(sales, keys=["series"]).collect()}
    assert (rows[2020].rev_mean, rows[2020].margin_pct, rows[2020].yoy_growth_pct) == (100.0, 60.0, None)
    assert (rows[2021].days, rows[2021].rev_total, rows[2021].yoy_growth_pct) == (1, 151.0, 51.0)
    ratio = one(diagnostics.cost_ratio(sales, keys=["series"]))
    assert ratio.days_above == 0 and ratio["count"] == 2


def test_stock_rates(spark):
    stock = spark.createDataFrame([(10, 8, 0), (10, 10, 5)], "demanded int, filled int, on_hand int")
    row = one(dashboard.stock_rates(stock))
    assert (row.fill_rate, row.stockout_rate) == (0.9, 0.5)
