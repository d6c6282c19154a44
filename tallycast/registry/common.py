"""Shared pieces of the registered queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    """Round floating results so that summation order does not show."""
    return df.withColumns({name: F.round(F.col(name), digits) for name in columns})


def exactly_rounded(value: Column, digits: int = 4) -> Column:
    """Rounded as a decimal: means of amounts can end on a rounding tie, where the
    last bit of a sum would decide; eight digits hold the tie itself."""
    return F.round(value.cast("decimal(38,8)"), digits).cast("double")


def exactly_rounded_sql(value: str, digits: int = 4) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def rounded_off_ties(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({name: exactly_rounded(F.col(name)) for name in columns})


# Revenue and COGS per segment and day, and the same with every day present.
DAILY_SQL = """
daily AS (
  SELECT c.c_mktsegment AS series, CAST(o.o_orderdate AS DATE) AS "Date",
         sum(l.l_extendedprice * (1 - l.l_discount)) AS "Revenue",
         sum(l.l_extendedprice * CAST(0.95 AS DOUBLE)) AS "COGS"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  GROUP BY 1, 2
)"""
PANEL_SQL = DAILY_SQL + """,
spine AS (
  SELECT series, CAST(unnest(generate_series(min("Date")::TIMESTAMP, max("Date")::TIMESTAMP,
         INTERVAL 1 DAY)) AS DATE) AS "Date" FROM daily GROUP BY series
),
panel AS (
  SELECT s.series, s."Date", coalesce(d."Revenue", 0.0) AS "Revenue",
         coalesce(d."COGS", 0.0) AS "COGS"
  FROM spine s LEFT JOIN daily d ON s.series = d.series AND s."Date" = d."Date"
)"""
# Daily orders, revenue and order value per segment.
COMPONENTS_SQL = """
o AS (SELECT c_mktsegment AS series, CAST(o_orderdate AS DATE) AS "Date", o_orderkey AS k
      FROM orders JOIN customer ON o_custkey = c_custkey
      WHERE o_orderstatus IS DISTINCT FROM 'P'),
n AS (SELECT series, "Date", count(DISTINCT k) AS n_orders FROM o GROUP BY ALL),
r AS (SELECT series, "Date", sum(l_extendedprice - coalesce(l_extendedprice * l_discount, 0)) AS rev_recon
      FROM lineitem JOIN o ON l_orderkey = k GROUP BY ALL),
comp AS (SELECT n.series, n."Date", n_orders, rev_recon, rev_recon / greatest(n_orders, 1) AS aov
         FROM n JOIN r ON n.series = r.series AND n."Date" = r."Date")"""
# Every day of the order calendar with its number of orders.
DAYS_SQL = """
counted AS (
  SELECT CAST(o_orderdate AS DATE) AS "Date", count(*) AS n FROM orders GROUP BY 1
),
days AS (
  SELECT g."Date", coalesce(c.n, 0) AS n_orders
  FROM (SELECT CAST(unnest(generate_series(min("Date")::TIMESTAMP, max("Date")::TIMESTAMP,
        INTERVAL 1 DAY)) AS DATE) AS "Date" FROM counted) g
  LEFT JOIN counted c ON g."Date" = c."Date"
)"""
LUNAR_SQL = """
lunar(year, event) AS (VALUES
  (1995, DATE '1995-01-31'), (1996, DATE '1996-02-19'), (1997, DATE '1997-02-07'),
  (1998, DATE '1998-01-28'), (1999, DATE '1999-02-16'), (2000, DATE '2000-02-05'),
  (2001, DATE '2001-01-24'), (2002, DATE '2002-02-12'))"""
