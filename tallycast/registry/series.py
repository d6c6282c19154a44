"""Registered scans, diagnostics and daily-panel queries with their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.functions.scalars import (
    at_least, at_most, date_text, from_log, round_half_even, to_log,
)
from tallycast.operators import panel, ranking, reshape
from tallycast.operators.aggregates import condition_share
from tallycast.plans import diagnostics
from tallycast.registry import driver
from tallycast.registry.common import COMPONENTS_SQL, DAILY_SQL, LUNAR_SQL, PANEL_SQL, rounded, rounded_off_ties
from tallycast.session import cut_lineage
from tallycast.sources.dimensions import spine_of
from tallycast.sources.tables import read_parquet_table

KEYS = driver.KEYS


def scan_tables(spark, sf):
    """Rows and date range of each table with a date column."""
    dated = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}
    parts = []
    for name, date in dated.items():
        df = read_parquet_table(spark, sf, name, dates=[date])
        parts.append(df.agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"),
            F.min(date).alias("first_date"), F.max(date).alias("last_date")))
    return reduce(DataFrame.unionByName, parts)


def date_spine(spark, sf):
    return spine_of(driver.orders(spark, sf).select(F.col("order_date").alias("Date")))


def daily_components(spark, sf):
    daily = driver.components(spark, sf)
    return rounded_off_ties(rounded(daily, 4, "rev_recon"), "aov")


def dense_panel(spark, sf):
    return rounded(driver.panel(spark, sf), 4, "Revenue", "COGS")


def diag_summary(spark, sf):
    result = diagnostics.summary(driver.daily_sales(spark, sf), keys=KEYS)
    means = rounded_off_ties(result, "mean_revenue", "mean_cogs")
    return rounded(rounded(means, 4, "min_revenue", "max_revenue"), 8, "mean_margin")


def diag_yearly(spark, sf):
    return diagnostics.yearly(driver.daily_sales(spark, sf), keys=KEYS)


def diag_dow(spark, sf):
    return diagnostics.by_weekday(driver.daily_sales(spark, sf), keys=KEYS)


def diag_month(spark, sf):
    return diagnostics.by_month(driver.daily_sales(spark, sf), keys=KEYS)


def diag_ratio(spark, sf):
    result = diagnostics.cost_ratio(driver.daily_sales(spark, sf), keys=KEYS)
    return rounded(result, 8, "mean", "std", "min", "p25", "p50", "p75", "max", "pct_above")


def diag_top10(spark, sf):
    return rounded(diagnostics.top_days(driver.daily_totals(spark, sf), 10), 4, "Revenue", "COGS")


def diag_weight_share(spark, sf):
    result = diagnostics.weight_share(
        driver.daily_sales(spark, sf), years=driver.STABLE_YEARS, keys=KEYS)
    return rounded(result, 9, "stable_share")


def diag_promo_months(spark, sf):
    return diagnostics.promo_months(driver.promotions(spark, sf))


def diag_events_seen(spark, sf):
    sales = driver.orders(spark, sf).select(F.col("order_date").alias("Date"))
    return diagnostics.events_seen(driver.lunar_events(spark), sales).select("event_date", "period")


def cogs_ratio(spark, sf):
    return rounded(panel.cogs_ratio(driver.daily_sales(spark, sf), keys=KEYS), 9, "cogs_ratio")


def clip_cap_round(spark, sf):
    """Clip, cap, half-even rounding and date text on every line."""
    lines = driver.order_items(spark, sf)
    return lines.groupBy(date_text(F.col("ship_date")).alias("ship_day")).agg(
        F.sum(at_least(F.col("unit_price"), 20000.0)).alias("clipped"),
        F.sum(at_most(F.col("cogs"), F.col("revenue") * 0.98)).alias("capped"),
        F.count_if(round_half_even(F.col("unit_price") / 1000, 0) % 2 == 0).alias("even"),
    ).select("ship_day", F.round("clipped", 4).alias("clipped"),
             F.round("capped", 6).alias("capped"), "even")


def log_transform(spark, sf):
    """Mean log sales per segment and the value they stand for."""
    logs = driver.panel(spark, sf).groupBy("series").agg(
        F.avg(to_log(F.col("Revenue"))).alias("mean_log"))
    both = logs.withColumn("typical", from_log(F.col("mean_log")))
    return rounded(rounded(both, 9, "mean_log"), 3, "typical")


def fill_median(spark, sf):
    """Average order value with gaps between days filled by the segment's median."""
    dense = panel.densify(driver.components(spark, sf), keys=KEYS, fill={"n_orders": 0, "aov": None})
    return rounded_off_ties(panel.fill_with_median(dense, "aov", keys=KEYS), "aov")


def date_filter(spark, sf):
    """Revenue after the hold-out cut-off, by month."""
    sales = driver.daily_sales(spark, sf).where(F.col("Date") > F.lit(driver.HOLDOUT_AFTER))
    return sales.groupBy(F.date_format("Date", "yyyy-MM").alias("month")).agg(
        F.round(F.sum("Revenue"), 1).alias("revenue"),
        F.round(condition_share(F.col("COGS") > F.col("Revenue")), 9).alias("loss_share"))


def head_tail(spark, sf):
    """The first and last five days of the total series."""
    total = cut_lineage(driver.daily_totals(spark, sf).select("Date", "Revenue"))
    ends = ranking.first_rows(total, 5, "Date").unionByName(ranking.last_rows(total, 5, "Date"))
    return rounded(ends, 4, "Revenue")


def future_rows(spark, sf):
    """History plus one week of unknown days per segment."""
    sales = driver.sales_once(spark, sf).select("series", "Date", "Revenue")
    last = sales.groupBy("series").agg(F.max("Date").alias("last"))
    future = last.select("series", F.explode(F.sequence(
        F.date_add("last", 1), F.date_add("last", 7), F.expr("interval 1 day"))).alias("Date"))
    return rounded(reshape.append_future(sales, future), 4, "Revenue")


def order_sample(spark, sf):
    """1,500 orders, the same for any partitioning."""
    orders = driver.orders(spark, sf).select("order_id", "customer_id", "order_date")
    return ranking.fixed_sample(orders, 1500, keys=["order_id"])


QUERIES = {fn.__name__: fn for fn in (
    scan_tables, date_spine, daily_components, dense_panel, diag_summary, diag_yearly, diag_dow,
    diag_month, diag_ratio, diag_top10, diag_weight_share, diag_promo_months, diag_events_seen,
    cogs_ratio, clip_cap_round, log_transform, fill_median, date_filter, head_tail, future_rows,
    order_sample,
)}

ORACLE = {
    "scan_tables": """
SELECT 'orders' AS table_name, count(*) AS n, CAST(min(o_orderdate) AS DATE) AS first_date,
       CAST(max(o_orderdate) AS DATE) AS last_date FROM orders
UNION ALL SELECT 'lineitem', count(*), CAST(min(l_shipdate) AS DATE), CAST(max(l_shipdate) AS DATE) FROM lineitem
UNION ALL SELECT 'events', count(*), CAST(min(ts) AS DATE), CAST(max(ts) AS DATE) FROM events""",
    "date_spine": """
SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS DATE) AS "Date"
FROM orders""",
    "daily_components": f"""
WITH {COMPONENTS_SQL}
SELECT series, "Date", n_orders, round(rev_recon, 4) AS rev_recon, CAST(round(CAST(aov AS DECIMAL(38,8)), 4) AS DOUBLE) AS aov FROM comp""",
    "dense_panel": f"""
WITH {PANEL_SQL}
SELECT series, "Date", round("Revenue", 4) AS "Revenue", round("COGS", 4) AS "COGS" FROM panel""",
    "diag_summary": f"""
WITH {DAILY_SQL}
SELECT series, count(*) AS rows, min("Date") AS first_date, max("Date") AS last_date,
       CAST(round(CAST(avg("Revenue") AS DECIMAL(38,8)), 4) AS DOUBLE) AS mean_revenue, round(min("Revenue"), 4) AS min_revenue,
       round(max("Revenue"), 4) AS max_revenue, CAST(round(CAST(avg("COGS") AS DECIMAL(38,8)), 4) AS DOUBLE) AS mean_cogs,
       round(1 - avg("COGS" / greatest("Revenue", 1)), 8) AS mean_margin
FROM daily GROUP BY series""",
    "diag_yearly": f"""
WITH {DAILY_SQL},
y AS (SELECT series, CAST(year("Date") AS INTEGER) AS year, count("Revenue") AS days,
             round_even(avg("Revenue"), 0) AS rev_mean, round_even(sum("Revenue"), 0) AS rev_total,
             round_even(avg("COGS"), 0) AS cogs_mean FROM daily GROUP BY 1, 2)
SELECT *, round_even((rev_mean - cogs_mean) / rev_mean * 100, 2) AS margin_pct,
       round_even((rev_total / lag(rev_total) OVER (PARTITION BY series ORDER BY year) - 1) * 100, 1)
       AS yoy_growth_pct FROM y""",
    "diag_dow": f"""
WITH {DAILY_SQL}
SELECT series, CAST(isodow("Date") - 1 AS INTEGER) AS dow, strftime(min("Date"), '%a') AS weekday,
       round_even(avg("Revenue"), 0) AS rev_mean
FROM daily GROUP BY series, isodow("Date")""",
    "diag_month": f"""
WITH {DAILY_SQL}
SELECT series, CAST(month("Date") AS INTEGER) AS month, round_even(avg("Revenue"), 0) AS rev_mean
FROM daily GROUP BY 1, 2""",
    "diag_ratio": f"""
WITH {DAILY_SQL}, x AS (SELECT series, "COGS" / greatest("Revenue", 1) AS v FROM daily)
SELECT series, count(v) AS count, round(avg(v), 8) AS mean, round(stddev_samp(v), 8) AS std,
       round(min(v), 8) AS min, round(quantile_cont(v, 0.25), 8) AS p25,
       round(quantile_cont(v, 0.5), 8) AS p50, round(quantile_cont(v, 0.75), 8) AS p75,
       round(max(v), 8) AS max, count(*) FILTER (v > 1) AS days_above,
       round(avg(CASE WHEN v > 1 THEN 1.0::DOUBLE ELSE 0 END) * 100, 8) AS pct_above
FROM x GROUP BY series""",
    "diag_top10": f"""
WITH {DAILY_SQL}, t AS (SELECT "Date", sum("Revenue") AS r, sum("COGS") AS c FROM daily GROUP BY 1)
SELECT "Date", round(r, 4) AS "Revenue", round(c, 4) AS "COGS" FROM t ORDER BY r DESC, "Date" LIMIT 10""",
    "diag_weight_share": f"""
WITH {DAILY_SQL}, x AS (SELECT series, year("Date") BETWEEN 1996 AND 1999 AS s FROM daily)
SELECT series, count(*) FILTER (s) AS stable_days, count(*) FILTER (NOT s) AS other_days,
       round(count(*) FILTER (s) / (count(*) FILTER (s) + count(*) FILTER (NOT s) * 0.01::DOUBLE), 9)
       AS stable_share FROM x GROUP BY series""",
    "diag_promo_months": """
SELECT CAST(month(l_shipdate) AS INTEGER) AS month, count(*) AS n FROM lineitem
WHERE l_discount > 0 GROUP BY 1""",
    "diag_events_seen": f"""
WITH {LUNAR_SQL}
SELECT event AS event_date, CASE WHEN event <= (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)
       THEN 'TRAIN' ELSE 'TEST' END AS period FROM lunar""",
    "cogs_ratio": f"""
WITH {DAILY_SQL}
SELECT series, round(median("COGS" / greatest("Revenue", 1)), 9) AS cogs_ratio FROM daily GROUP BY 1""",
    "clip_cap_round": """
SELECT strftime(l_shipdate, '%Y-%m-%d') AS ship_day,
       round(sum(greatest(l_extendedprice, 20000)), 4) AS clipped,
       round(sum(least(l_extendedprice * 0.95::DOUBLE, l_extendedprice * (1 - l_discount) * 0.98::DOUBLE)), 6) AS capped,
       count(*) FILTER (round_even(l_extendedprice / 1000, 0) % 2 = 0) AS even
FROM lineitem GROUP BY 1""",
    "log_transform": f"""
WITH {PANEL_SQL}, m AS (SELECT series, avg(ln(1 + "Revenue")) AS v FROM panel GROUP BY 1)
SELECT series, round(v, 9) AS mean_log, round(exp(v) - 1, 3) AS typical FROM m""",
    "fill_median": f"""
WITH {COMPONENTS_SQL},
spine AS (SELECT series, CAST(unnest(generate_series(min("Date")::TIMESTAMP, max("Date")::TIMESTAMP,
          INTERVAL 1 DAY)) AS DATE) AS "Date" FROM comp GROUP BY series),
med AS (SELECT series, median(aov) AS m FROM comp GROUP BY series)
SELECT s.series, s."Date", coalesce(n_orders, 0) AS n_orders, CAST(round(CAST(coalesce(aov, m) AS DECIMAL(38,8)), 4) AS DOUBLE) AS aov
FROM spine s JOIN med ON med.series = s.series
LEFT JOIN comp c ON c.series = s.series AND c."Date" = s."Date" """,
    "date_filter": f"""
WITH {DAILY_SQL}
SELECT strftime("Date", '%Y-%m') AS month, round(sum("Revenue"), 1) AS revenue,
       round(avg(CASE WHEN "COGS" > "Revenue" THEN 1.0::DOUBLE ELSE 0 END), 9) AS loss_share
FROM daily WHERE "Date" > DATE '2001-01-31' GROUP BY 1""",
    "head_tail": f"""
WITH {DAILY_SQL}, t AS (SELECT "Date", round(sum("Revenue"), 4) AS "Revenue" FROM daily GROUP BY 1)
(SELECT * FROM t ORDER BY "Date" LIMIT 5) UNION ALL (SELECT * FROM t ORDER BY "Date" DESC LIMIT 5)""",
    "order_sample": """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date FROM orders
ORDER BY md5(o_orderkey::VARCHAR || '|42'), o_orderkey LIMIT 1500""",
    "future_rows": f"""
WITH {DAILY_SQL}
SELECT series, "Date", round("Revenue", 4) AS "Revenue" FROM daily
UNION ALL
SELECT series, CAST(max("Date") + CAST(k AS INTEGER) AS DATE), NULL FROM daily, range(1, 8) t(k) GROUP BY series, k""",
}
