"""Registered feature queries with their SQL."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tallycast import constants
from tallycast.operators import dynamic, features, rolling, windows
from tallycast.operators.intervals import active_by_day
from tallycast.registry import driver
from tallycast.registry.common import DAYS_SQL, LUNAR_SQL, PANEL_SQL, exactly_rounded, exactly_rounded_sql, rounded, rounded_off_ties

KEYS = driver.KEYS


def _calendar():
    return features.calendar_columns(
        F.col("Date"), origin=driver.TREND_ORIGIN, regime_year=driver.REGIME_YEAR)


def feat_calendar(spark, sf):
    days = driver.order_days(spark, sf)
    return rounded(days.withColumns(_calendar()), 10, "t_years")


def feat_fourier(spark, sf):
    columns = features.fourier_columns(F.col("Date"))
    return rounded(driver.order_days(spark, sf).withColumns(columns), 10, *columns)


def feat_holidays(spark, sf):
    return driver.order_days(spark, sf).withColumns(features.holiday_columns(F.col("Date")))


def feat_lunar(spark, sf):
    return features.with_lunar(driver.order_days(spark, sf), driver.lunar_events(spark))


def feat_promo_windows(spark, sf):
    return features.with_promo_windows(driver.order_days(spark, sf))


def feat_promo_active(spark, sf):
    return rounded(active_by_day(
        driver.order_days_once(spark, sf), driver.promotions(spark, sf),
        category_flags=driver.PROMO_FLAGS), 4, "sum_discount_active")


def feat_lunar_lag(spark, sf):
    sales = driver.sales_once(spark, sf)
    asked = sales.select("series", "Date")
    result = features.lunar_aligned_lag(
        asked, sales, keys=KEYS, lunar=driver.LUNAR_NEW_YEAR, last_known_year=2001)
    return rounded(result, 4, "rev_tet_aligned_lag", "cogs_tet_aligned_lag")


def feature_table(spark, sf):
    """The calendar feature table of the given orders, without the order count."""
    return features.build_features(
        driver.order_days_once(spark, sf).select("Date"),
        promotions=driver.promotions(spark, sf).withColumn(
            "applicable_category", F.when(F.col("applicable_category") == "R", "Streetwear").when(
                F.col("applicable_category") == "A", "Outdoor")),
        lunar_events=driver.lunar_events(spark),
        origin=driver.TREND_ORIGIN, regime_year=driver.REGIME_YEAR)


def feat_matrix(spark, sf):
    """All 88 features as column sums per year."""
    table = feature_table(spark, sf)
    names = features.feature_names(table)
    return table.groupBy(F.col("year").alias("y")).agg(
        F.lit(len(names)).alias("n_features"),
        *[F.round(F.sum(F.col(n).cast("double")), 4).alias(n) for n in names])


def feat_lags(spark, sf):
    rows = windows.by_date(KEYS)
    columns = windows.lag_columns("Revenue", rows)
    df = driver.panel(spark, sf).select("series", "Date", "Revenue").withColumns(columns)
    return rounded_off_ties(df, "Revenue", *columns)


def feat_rolling(spark, sf):
    df = driver.panel(spark, sf).select("series", "Date", "Revenue")
    result = rolling.with_rolling(df, "Revenue", KEYS)
    return rounded_off_ties(result, "Revenue", *rolling.rolling_names("Revenue"))


def feat_ewm(spark, sf):
    df = driver.panel(spark, sf).select("series", "Date", "Revenue")
    result = windows.with_ewm(df, "Revenue", KEYS)
    return rounded_off_ties(result, "Revenue", "Revenue_ewm_7", "Revenue_ewm_28")


def feat_change(spark, sf):
    """Day-over-day change of revenue."""
    change = windows.change_from_previous(F.col("Revenue"), windows.by_date(KEYS))
    df = driver.panel(spark, sf).select("series", "Date", change.alias("change"))
    return rounded(df, 7, "change")


def feat_dynamic(spark, sf):
    """All past-value features of both targets as sums per segment and year."""
    df = driver.panel(spark, sf)
    for target in constants.TARGETS:
        df = dynamic.with_dynamic_features(df, target, keys=KEYS)
    names = [n for target in constants.TARGETS for n in dynamic.dynamic_names(target)]
    return df.groupBy("series", F.year("Date").alias("year")).agg(
        *[exactly_rounded(F.avg(n)).alias(n) for n in names])


QUERIES = {fn.__name__: fn for fn in (
    feat_calendar, feat_fourier, feat_holidays, feat_lunar, feat_promo_windows, feat_promo_active,
    feat_lunar_lag, feat_matrix, feat_lags, feat_rolling, feat_ewm, feat_change, feat_dynamic,
)}


def _int(expression: str, name: str) -> str:
    return f'CAST({expression} AS INTEGER) AS "{name}"'


_D = '"Date"'
_DIM = f"day(last_day({_D}))"
_CAL = [
    _int(f"year({_D})", "year"), _int(f"month({_D})", "month"), _int(f"day({_D})", "day"),
    _int(f"isodow({_D}) - 1", "dow"), _int(f"dayofyear({_D})", "doy"),
    _int(f"quarter({_D})", "quarter"), _int(_DIM, "dim"), _int(f"isodow({_D}) IN (6, 7)", "is_weekend"),
    _int(f"{_DIM} - day({_D})", "days_to_eom"), _int(f"day({_D}) - 1", "days_from_som"),
    *[_int(f"{_DIM} - day({_D}) <= {k - 1}", f"is_last{k}") for k in (1, 2, 3)],
    *[_int(f"day({_D}) <= {k}", f"is_first{k}") for k in (1, 2, 3)],
    _int(f"day({_D}) IN (1, 15)", "is_payday"), _int(f"day({_D}) >= 28", "is_month_end_zone"),
    _int(f"{_D} - DATE '1998-01-01'", "t_days"),
    f"round(({_D} - DATE '1998-01-01') / 365.25::DOUBLE, 10) AS t_years",
    _int(f"year({_D}) <= 1997", "regime_pre2019"), _int(f"year({_D}) = 1998", "regime_2019"),
    _int(f"year({_D}) >= 1999", "regime_post2019"), _int(f"year({_D}) % 2", "is_odd_year"),
]
_FOURIER = [
    f"round({fn}(2 * pi() * {k} * {phase}), 10) AS {fn}_{cycle}{k}"
    for cycle, phase, count in (
        ("y", f"dayofyear({_D}) / 365.25::DOUBLE", 5),
        ("w", f"(isodow({_D}) - 1) / 7::DOUBLE", 2),
        ("m", f"(day({_D}) - 1) / {_DIM}::DOUBLE", 2))
    for k in range(1, count + 1) for fn in ("sin", "cos")
]
_HOLIDAYS = [
    _int(f"strftime({_D}, '%m-%d') = '{m:02d}-{d:02d}'", f"hol_{name}")
    for m, d, name in constants.FIXED_HOLIDAYS
] + [_int(f"month({_D}) = 11 AND isodow({_D}) = 5 AND day({_D}) BETWEEN 24 AND 30", "hol_black_friday")]

_LUNAR_CTE = LUNAR_SQL + f""",
near AS (SELECT d.{_D}, d.n_orders,
    coalesce((SELECT arg_min(CAST(d.{_D} - event AS INTEGER), abs(d.{_D} - event) * 10000 + year)
              FROM lunar WHERE abs(d.{_D} - event) <= 60), 999) AS t FROM days d)"""
_LUNAR = [
    'CAST(t AS INTEGER) AS tet_days_diff',
    *[_int(f"abs(t) <= {k}", f"tet_in_{k}") for k in (7, 14, 21)],
    _int("t >= -7 AND t < 0", "tet_before_7"), _int("t > 0 AND t <= 7", "tet_after_7"),
    _int("t = 0", "tet_on"),
]


def _window_sql() -> str:
    """One row per day and schedule entry with the start of the window that covers it."""
    entries = ", ".join(
        f"('{n}', {m}, {d}, {length}, {disc}::DOUBLE, '{rule}')"
        for n, m, d, length, disc, rule in constants.PROMO_SCHEDULE)
    return f"""
sched(name, m, d, len, disc, rule) AS (VALUES {entries}),
opened AS (
  SELECT name, len, disc, make_date(y, m, d) AS start
  FROM sched, (SELECT unnest(range(1990, 2010)) AS y)
  WHERE rule <> 'odd' OR y % 2 = 1),
inside AS (
  SELECT d.{_D}, o.name, d.{_D} - o.start AS since, o.start + CAST(o.len AS INTEGER) - d.{_D} AS until, o.disc
  FROM days d JOIN opened o ON d.{_D} BETWEEN o.start AND o.start + CAST(o.len AS INTEGER))"""


def _window_columns() -> list[str]:
    columns = []
    for name, *_ in constants.PROMO_SCHEDULE:
        pick = f"FILTER (i.name = '{name}')"
        columns += [
            f"CAST(count(*) {pick} AS INTEGER) AS promo_{name}",
            f"coalesce(max(since) {pick}, -1)::DOUBLE AS promo_{name}_since",
            f"coalesce(max(until) {pick}, -1)::DOUBLE AS promo_{name}_until",
            f"coalesce(max(disc) {pick}, 0)::DOUBLE AS promo_{name}_disc",
        ]
    return columns


def _active_sql(flags: dict[str, str]) -> str:
    flag_columns = ", ".join(
        f"CAST(coalesce(max(CASE WHEN l_returnflag = '{code}' THEN 1 ELSE 0 END), 0) AS INTEGER) AS {name}"
        for code, name in flags.items())
    return f"""
SELECT d.{_D}, d.n_orders, CAST(count(l_orderkey) AS INTEGER) AS n_active_promos,
       round(coalesce(sum(l_discount * 100), 0), 4) AS sum_discount_active, {flag_columns}
FROM days d LEFT JOIN (SELECT * FROM lineitem WHERE l_discount > 0) l
  ON d.{_D} >= CAST(l_shipdate AS DATE)
 AND d.{_D} <= CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER)
GROUP BY d.{_D}, d.n_orders"""


def _plain(columns: list[str]) -> str:
    return f'SELECT {_D}, n_orders, {", ".join(columns)} FROM days'


_SQL = {
    "feat_calendar": f"WITH {DAYS_SQL} {_plain(_CAL)}",
    "feat_fourier": f"WITH {DAYS_SQL} {_plain(_FOURIER)}",
    "feat_holidays": f"WITH {DAYS_SQL} {_plain(_HOLIDAYS)}",
    "feat_lunar": f"WITH {DAYS_SQL}, {_LUNAR_CTE} SELECT {_D}, n_orders, {', '.join(_LUNAR)} FROM near",
    "feat_promo_windows": f"""WITH {DAYS_SQL}, {_window_sql()}
SELECT d.{_D}, d.n_orders, {', '.join(_window_columns())}
FROM days d LEFT JOIN inside i ON d.{_D} = i.{_D} GROUP BY d.{_D}, d.n_orders""",
    "feat_promo_active": f"WITH {DAYS_SQL} {_active_sql(driver.PROMO_FLAGS)}",
}


def _matrix_sql() -> str:
    parts = {
        "a": _plain(_CAL), "b": _plain(_FOURIER).replace("n_orders, ", ""),
        "c": _plain(_HOLIDAYS).replace("n_orders, ", ""),
        "e": f"SELECT {_D}, {', '.join(_LUNAR)} FROM near",
        "f": f"SELECT d.{_D}, {', '.join(_window_columns())} FROM days d "
             f"LEFT JOIN inside i ON d.{_D} = i.{_D} GROUP BY d.{_D}",
        "g": _active_sql({"R": "has_streetwear_promo", "A": "has_outdoor_promo"}).replace(
            ", d.n_orders", ""),
    }
    ctes = ", ".join(f"{name} AS ({sql})" for name, sql in parts.items())
    joined = "a " + " ".join(f"JOIN {name} USING ({_D})" for name in list(parts)[1:])
    names = [c.rsplit(" AS ", 1)[1].strip('"') for c in _CAL + _FOURIER + _HOLIDAYS + _LUNAR]
    names += [c.rsplit(" AS ", 1)[1] for c in _window_columns()]
    names += ["n_active_promos", "sum_discount_active", "has_streetwear_promo", "has_outdoor_promo"]
    sums = ", ".join(f'round(sum(CAST({n} AS DOUBLE)), 4) AS {n}' for n in names)
    return (f"WITH {DAYS_SQL}, {_LUNAR_CTE}, {_window_sql()}, {ctes} "
            f"SELECT CAST(year({_D}) AS INTEGER) AS y, {len(names)} AS n_features, {sums} FROM {joined} GROUP BY 1")


def _rolling_sql(target: str) -> list[str]:
    columns = []
    for n in constants.ROLLING_WINDOWS:
        frame = f'OVER (PARTITION BY series ORDER BY {_D} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)'
        enough = f'count("{target}") {frame} >= {max(2, n // 3)}'
        columns.append(f'CASE WHEN {enough} THEN avg("{target}") {frame} END AS {target}_roll_mean_{n}')
        columns.append(f'CASE WHEN {enough} THEN stddev_samp("{target}") {frame} END AS {target}_roll_std_{n}')
    return columns


def _lag_sql(target: str) -> list[str]:
    return [f'lag("{target}", {k}) OVER (PARTITION BY series ORDER BY {_D}) AS {target}_lag_{k}'
            for k in constants.LAGS]


def _ewm_sql(target: str) -> list[str]:
    frame = f"OVER (PARTITION BY series ORDER BY {_D} ROWS BETWEEN {{n}} PRECEDING AND 1 PRECEDING)"
    columns = []
    for span in constants.EWM_SPANS:
        # Weights beyond the frame are below 1e-20; the first value of a frame seeds it.
        rows = math.ceil(math.log(1e-20) / math.log(1 - 2 / (span + 1)))
        decay, share = f"{1 - 2 / (span + 1)!r}::DOUBLE", f"{2 / (span + 1)!r}::DOUBLE"
        window = frame.format(n=rows)
        columns.append(
            f'CASE WHEN count(*) {window} >= 3 THEN list_reduce(list("{target}") {window}, '
            f'lambda a, x: a * {decay} + x * {share}) END AS {target}_ewm_{span}')
    return columns


def _rounded_sql(columns: list[str], keep: str = f"series, {_D}, ") -> str:
    names = [c.rsplit(" AS ", 1)[1] for c in columns]
    return keep + ", ".join(f"{exactly_rounded_sql(n)} AS {n}" for n in names)


_REVENUE = '"Revenue"'


def _panel_query(columns: list[str]) -> str:
    inner = f'SELECT series, {_D}, "Revenue", {", ".join(columns)} FROM panel'
    return (f"WITH {PANEL_SQL}, x AS ({inner}) "
            f'SELECT {_rounded_sql(columns)}, {exactly_rounded_sql(_REVENUE)} AS "Revenue" FROM x')


def _lunar_lag_sql() -> str:
    return f"""WITH {PANEL_SQL.split(',' + chr(10) + 'spine')[0]}, {LUNAR_SQL},
x AS (SELECT series, {_D},
        (SELECT max(event) FROM lunar r WHERE r.year < year(daily.{_D}) AND r.year <= 2001)
        + CAST(coalesce({_D} - (SELECT event FROM lunar o WHERE o.year = year(daily.{_D})), 0) AS INTEGER) AS ref
      FROM daily)
SELECT x.series, x.{_D}, round(p."Revenue", 4) AS rev_tet_aligned_lag, round(p."COGS", 4) AS cogs_tet_aligned_lag
FROM x LEFT JOIN daily p ON p.series = x.series AND p.{_D} = x.ref"""


def _dynamic_sql() -> str:
    columns = [c for t in constants.TARGETS for c in _lag_sql(t) + _rolling_sql(t) + _ewm_sql(t)]
    names = [c.rsplit(" AS ", 1)[1] for c in columns]
    means = ", ".join(f"{exactly_rounded_sql(f'avg({n})')} AS {n}" for n in names)
    return (f"WITH {PANEL_SQL}, x AS (SELECT series, {_D}, {', '.join(columns)} FROM panel) "
            f"SELECT series, CAST(year({_D}) AS INTEGER) AS year, {means} FROM x GROUP BY 1, 2")


ORACLE = _SQL | {
    "feat_matrix": _matrix_sql(),
    "feat_lunar_lag": _lunar_lag_sql(),
    "feat_lags": _panel_query(_lag_sql("Revenue")),
    "feat_rolling": _panel_query(_rolling_sql("Revenue")),
    "feat_ewm": _panel_query(_ewm_sql("Revenue")),
    "feat_change": f"""WITH {PANEL_SQL}
SELECT series, {_D}, round("Revenue" / nullif(lag("Revenue") OVER (PARTITION BY series ORDER BY {_D}), 0) - 1, 7)
AS change FROM panel""",
    "feat_dynamic": _dynamic_sql(),
}
