"""Registered queries that write tables and read them back, and checks of inputs."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallycast.functions.scalars import parse_date
from tallycast.models import importance, ridge
from tallycast.operators import metrics, quantiles, sketches
from tallycast.operators.dynamic import dynamic_names
from tallycast.plans import recursive as recursive_plan
from tallycast.registry import driver
from tallycast.registry.common import COMPONENTS_SQL, DAILY_SQL, PANEL_SQL, rounded, rounded_off_ties
from tallycast.session import cut_lineage, ensure_checkpoint_dir
from tallycast.sources import inputs, sinks
from tallycast.sources.tables import read_csv_table, unreadable_cells

KEYS = driver.KEYS
# Columns of the moments query and the units they are measured in.
_LINE_COLUMNS = {"l_quantity": 100.0, "l_extendedprice": 100_000.0, "l_discount": 1.0, "l_tax": 1.0}


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder beside the checkpoints, which all executors see."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def csv_sales(spark, sf):
    """Daily sales written as CSV and read with the fixed schema."""
    folder = _scratch(spark, "csv")
    driver.daily_totals(spark, sf).select(
        "COGS", F.lit("x").alias("note"), F.col("Date").cast("string").alias("Date"), "Revenue").write.option(
            "header", True).csv(f"{folder}/sales.csv")
    return rounded(read_csv_table(spark, folder, "sales"), 4, "Revenue", "COGS")


def csv_unreadable(spark, sf):
    """Cells of written web traffic that are no number, per column."""
    folder = _scratch(spark, "csv")
    lines = driver.table(spark, sf, "lineitem").select(
        F.col("l_linestatus").alias("traffic_source"),
        F.when(F.col("l_returnflag") == "R", "n/a").otherwise(F.col("l_discount").cast("string")).alias("bounce_rate"))
    lines.write.option("header", True).csv(f"{folder}/web_traffic.csv")
    return unreadable_cells(spark, folder, "web_traffic")


def cached_components(spark, sf):
    """Daily components built once, then read from the stored table."""
    path = f"{_scratch(spark, 'components')}/daily"
    inputs.cached_table(spark, path, lambda: driver.components(spark, sf))

    def never():
        raise RuntimeError("the stored table was not used")

    stored = inputs.cached_table(spark, path, never)
    return rounded_off_ties(rounded(stored, 4, "rev_recon"), "aov")


def parameter_file(spark, sf):
    """Parameters per brand and type size, the best of several, written and read back."""
    path = f"{_scratch(spark, 'parameters')}/best"
    rows = driver.products(spark, sf).groupBy("category", (F.col("size") % 3).alias("third")).agg(
        F.max("size").cast("double").alias("depth"), (F.min("price") * 1000 + F.max("size")).alias("score"))
    sinks.write_metadata(rows.select(
        F.col("category").alias("target"), F.lit("trees").alias("model"),
        F.create_map(F.lit("depth"), F.col("depth")).alias("params"), "score"), path)
    found = inputs.read_parameters(spark, path)
    return spark.createDataFrame(
        [(target, model, params["depth"]) for (target, model), params in found.items()],
        "target string, model string, depth double")


def importance_file(spark, sf):
    """Importances written as CSV and read back for a top list."""
    from tallycast.registry.models import SLOPES, line_attribution

    path = f"{_scratch(spark, 'importance')}/table"
    sinks.write_importance(importance.combined_importance(line_attribution(spark, sf), list(SLOPES)), path)
    return rounded(sinks.read_importance(spark, path), 6, *SLOPES, "total")


def text_dates(spark, sf):
    """Order dates as text, some of them spoiled, as dates again."""
    text = F.when(F.col("o_orderkey") % 7 == 0, F.date_format("o_orderdate", "yyyy/MM/dd")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd"))
    parsed = driver.table(spark, sf, "orders").select(parse_date(text).alias("day"))
    return parsed.groupBy(F.year("day").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.count("day").alias("known"), F.max("day").alias("last_day"))


def column_moments(spark, sf):
    """Mean and population deviation of line columns, in one pass over vectors."""
    lines = driver.table(spark, sf, "lineitem").select(array_to_vector(F.array(*[
        F.col(name).cast("double") / unit for name, unit in _LINE_COLUMNS.items()])).alias("features"))
    found = ridge.column_moments(lines)
    rows = [(name, int(found.n), float(found.means[k]), float(found.scales[k])) for k, name in enumerate(_LINE_COLUMNS)]
    return rounded(spark.createDataFrame(rows, "feature string, n long, mean double, scale double"), 9, "mean", "scale")


def warmup_rows(spark, sf):
    """Rows that are left for training after the warm-up, per segment."""
    panel = driver.panel_once(spark, sf)
    days = panel.select("Date").distinct().withColumn("dow", F.weekday("Date"))
    frame = recursive_plan.training_frame(panel, days, "Revenue", keys=KEYS, warmup_end=driver.WARMUP_END)
    return frame.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.min("Date").alias("first_date"), F.max("Date").alias("last_date"),
        F.count(dynamic_names("Revenue")[10]).alias("n_year_lags"))


def run_scores(spark, sf):
    """Metadata of a run that forecasts yesterday's revenue, written and read back."""
    path = f"{_scratch(spark, 'run')}/metadata"
    panel = driver.panel_once(spark, sf)
    before = panel.select("series", F.date_add("Date", 1).alias("Date"), F.col("Revenue").alias("yhat"))
    scores = metrics.regression_metrics(panel.join(before, ["series", "Date"]).select(
        F.lit("Revenue").alias("target"), F.col("Revenue").alias("y"), "yhat"), keys=["target"]).first()
    sinks.write_metadata(sinks.run_metadata(
        spark, numbers={"n_features": 1.0}, labels={"model": "yesterday"},
        scores={"Revenue": {name: scores[name] for name in ("mae", "rmse", "r2")}}), path)
    schema = "numbers map<string, double>, labels map<string, string>, scores map<string, map<string, double>>"
    row = spark.read.schema(schema).json(path)
    own = F.col("scores")["Revenue"]
    return rounded(row.select(
        F.col("numbers")["n_features"].alias("n_features"), F.col("labels")["model"].alias("model"),
        own["mae"].alias("mae"), own["rmse"].alias("rmse"), own["r2"].alias("r2")), 4, "mae", "rmse", "r2")


def distinct_customers(spark, sf):
    """Customers with an order per quarter: exact, and whether the union of daily sketches
    comes within four standard errors."""
    orders = driver.orders(spark, sf)
    quarter = F.date_trunc("quarter", "Date").cast("date")
    about = sketches.distinct_in(
        sketches.daily_sketches(orders, "customer_id", date="order_date"), quarter, name="n_about")
    exact = orders.where("order_date is not null").groupBy(
        F.date_trunc("quarter", "order_date").cast("date").alias("period")).agg(
            F.count_distinct("customer_id").alias("n_customers"))
    near = F.abs(F.col("n_about") - F.col("n_customers")) <= 1 + 4 * sketches.standard_error() * F.col("n_customers")
    return exact.join(about, "period").select("period", "n_customers", near.alias("near"))


def price_quantiles(spark, sf):
    """Median and deciles of the line price over all lines as one group, and per return flag."""
    lines = driver.table(spark, sf, "lineitem")
    parts = []
    for share in (0.1, 0.5, 0.9):
        # A limit far below the group's size, so that ranges are narrowed down.
        whole = quantiles.group_quantiles(lines, "l_extendedprice", share, limit=1 << 12)
        parts.append(whole.select(F.lit("all").alias("flag"), F.lit(share).alias("share"), "quantile"))
        flags = quantiles.group_quantiles(lines, "l_extendedprice", share, keys=["l_returnflag"], limit=1 << 12)
        parts.append(flags.select(F.col("l_returnflag").alias("flag"), F.lit(share).alias("share"), "quantile"))
    return rounded(reduce(DataFrame.unionByName, parts), 6, "quantile")


QUERIES = {fn.__name__: fn for fn in (
    distinct_customers, price_quantiles, csv_sales, csv_unreadable, cached_components, parameter_file, importance_file, text_dates, column_moments, warmup_rows,
    run_scores,
)}



def _importance_sql() -> str:
    from tallycast.registry.models import SLOPES

    parts = [
        f"SELECT '{model}' AS model, '{name}' AS feature, round(avg(abs({slope!r}::DOUBLE * "
        f"({name} - (SELECT avg({name}) FROM lineitem)))), 4) AS importance FROM lineitem"
        for model, slopes in SLOPES.items() for name, slope in slopes.items()]
    return "WITH imp AS (" + " UNION ALL ".join(parts) + """),
share AS (SELECT model, feature, importance / sum(importance) OVER (PARTITION BY model) AS share FROM imp)
SELECT feature, round(max(share) FILTER (model = 'model_a'), 6) AS model_a,
       round(max(share) FILTER (model = 'model_b'), 6) AS model_b, round(sum(share), 6) AS total FROM share GROUP BY 1"""


ORACLE = {
    "distinct_customers": """
SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS period, count(DISTINCT o_custkey) AS n_customers, true AS near
FROM orders GROUP BY 1""",
    "price_quantiles": " UNION ALL ".join(
        f"SELECT {flag} AS flag, {share}::DOUBLE AS share, round(quantile_cont(l_extendedprice, {share}), 6) AS quantile "
        f"FROM lineitem {group}" for share in (0.1, 0.5, 0.9)
        for flag, group in (("'all'", ""), ("l_returnflag", "GROUP BY l_returnflag"))),
    "csv_sales": f"""WITH {DAILY_SQL}
SELECT "Date", round(sum("Revenue"), 4) AS "Revenue", round(sum("COGS"), 4) AS "COGS" FROM daily GROUP BY 1""",
    "csv_unreadable": """
SELECT 'bounce_rate' AS "column", count(*) FILTER (l_returnflag = 'R') AS unreadable, count(*) AS cells FROM lineitem
UNION ALL SELECT 'traffic_source', 0, count(*) FROM lineitem""",
    "cached_components": f"""
WITH {COMPONENTS_SQL}
SELECT series, "Date", n_orders, round(rev_recon, 4) AS rev_recon, CAST(round(CAST(aov AS DECIMAL(38,8)), 4) AS DOUBLE) AS aov FROM comp""",
    "parameter_file": """
WITH t AS (SELECT p_brand AS target, CAST(max(p_size) AS DOUBLE) AS depth, min(p_retailprice) * 1000 + max(p_size) AS score
           FROM part GROUP BY p_brand, p_size % 3)
SELECT target, 'trees' AS model, arg_min(depth, score) AS depth FROM t GROUP BY 1""",
    "importance_file": _importance_sql(),
    "text_dates": """
WITH d AS (SELECT CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day FROM orders)
SELECT CAST(year(day) AS INTEGER) AS year, count(*) AS n, count(day) AS known, max(day) AS last_day FROM d GROUP BY 1""",
    "column_moments": " UNION ALL ".join(
        f"SELECT '{name}' AS feature, count(*) AS n, round(avg({name}::DOUBLE / {unit!r}::DOUBLE), 9) AS mean, "
        f"round(stddev_pop({name}::DOUBLE / {unit!r}::DOUBLE), 9) AS scale FROM lineitem"
        for name, unit in _LINE_COLUMNS.items()),
    "warmup_rows": f"""WITH {PANEL_SQL},
n AS (SELECT series, "Date", row_number() OVER (PARTITION BY series ORDER BY "Date") AS k FROM panel)
SELECT series, count(*) AS n, min("Date") AS first_date, max("Date") AS last_date, count(*) FILTER (k > 366) AS n_year_lags
FROM n WHERE "Date" >= DATE '{driver.WARMUP_END}' GROUP BY 1""",
    "run_scores": f"""WITH {PANEL_SQL},
x AS (SELECT p."Revenue" AS y, b."Revenue" AS f FROM panel p JOIN panel b ON p.series = b.series AND b."Date" + 1 = p."Date")
SELECT 1.0::DOUBLE AS n_features, 'yesterday' AS model, round(avg(abs(y - f)), 4) AS mae, round(sqrt(avg((y - f) ** 2)), 4) AS rmse,
       round(1 - sum((y - f) ** 2) / (sum(y * y) - count(*) * avg(y) ** 2), 4) AS r2 FROM x""",
}
