"""Published parameter values of the forecasting method.

Fixed values: every table and number below must equal the published method
for results to agree, so they are stated as they are.  Each operator takes
them as arguments; these are only the defaults.
"""

from __future__ import annotations

import datetime as dt

SEED = 42
TARGETS = ("Revenue", "COGS")

# Calendar ranges of the published series.
TRAIN_START = dt.date(2012, 7, 4)
TRAIN_END = dt.date(2022, 12, 31)
FORECAST_START = dt.date(2023, 1, 1)
FORECAST_END = dt.date(2024, 7, 1)
HOLDOUT_AFTER = dt.date(2022, 7, 4)
WARMUP_END = dt.date(2014, 7, 4)

# Training weights.
STABLE_YEARS = (2014, 2018)
OTHER_YEAR_WEIGHT = 0.01
QUARTER_BOOST = 2.0
DECAY_HALF_LIFE_DAYS = 730

# Blending.
SPECIALIST_SHARE = 0.60
RIDGE_SHARE = 0.20
RIDGE_ALPHA = 3.0
BOOSTER_WEIGHTS = {
    "Revenue": {"squared": 0.30, "absolute": 0.30, "deep": 0.15, "median": 0.25},
    "COGS": {"squared": 0.45, "absolute": 0.20, "deep": 0.15, "median": 0.20},
}
COMPONENT_SEEDS = (42, 123, 777, 2026, 314)

# Calibration.
FIXED_CALIBRATION = {"Revenue": 1.26, "COGS": 1.32}
CALIBRATION_GRID = (0.80, 1.60, 0.005)
COARSE_CALIBRATION_GRID = (0.80, 1.50, 0.01)

# Level anchors and the cap of COGS relative to Revenue.
RECURSIVE_ANCHOR = {"Revenue": 4_250_000.0, "COGS": 3_750_000.0}
COMPONENT_ANCHOR = 4_400_000.0
COGS_CAP = 0.98

# Calendar features.
TREND_ORIGIN = dt.date(2020, 1, 1)
YEAR_LENGTH = 365.25
REGIME_YEAR = 2019
PAYDAYS = (1, 15)
MONTH_END_ZONE_FROM = 28
FOURIER_HARMONICS = {"y": 5, "w": 2, "m": 2}

# Features built from past values.
LAGS = (1, 2, 3, 7, 14, 28, 56, 91, 182, 365, 366)
ROLLING_WINDOWS = (7, 14, 28, 56, 91, 182, 365)
EWM_SPANS = (7, 28)

# Lunar new year.
EVENT_REACH_DAYS = 60
EVENT_FAR = 999
LUNAR_NEW_YEAR = {
    2012: dt.date(2012, 1, 23),
    2013: dt.date(2013, 2, 10),
    2014: dt.date(2014, 1, 31),
    2015: dt.date(2015, 2, 19),
    2016: dt.date(2016, 2, 8),
    2017: dt.date(2017, 1, 28),
    2018: dt.date(2018, 2, 16),
    2019: dt.date(2019, 2, 5),
    2020: dt.date(2020, 1, 25),
    2021: dt.date(2021, 2, 12),
    2022: dt.date(2022, 2, 1),
    2023: dt.date(2023, 1, 22),
    2024: dt.date(2024, 2, 10),
}

# (month, day, name)
FIXED_HOLIDAYS = (
    (1, 1, "new_year"),
    (3, 8, "womens_day"),
    (4, 30, "reunification"),
    (5, 1, "labor_day"),
    (9, 2, "national_day"),
    (10, 20, "vn_womens_day"),
    (11, 11, "dd_1111"),
    (12, 12, "dd_1212"),
    (12, 24, "christmas_eve"),
    (12, 25, "christmas"),
)

# (name, start month, start day, days after the start, discount, years)
PROMO_SCHEDULE = (
    ("spring_sale", 3, 18, 30, 12.0, "yearly"),
    ("mid_year", 6, 23, 29, 18.0, "yearly"),
    ("fall_launch", 8, 30, 32, 10.0, "yearly"),
    ("year_end", 11, 18, 45, 20.0, "yearly"),
    ("urban_blowout", 7, 30, 33, 50.0, "odd"),
    ("rural_special", 1, 30, 30, 15.0, "odd"),
)

# Categories of running promotions that get a flag of their own.
PROMO_CATEGORY_FLAGS = {"Streetwear": "has_streetwear_promo", "Outdoor": "has_outdoor_promo"}

# How each feature is built, printed next to ranked features; others get UNKNOWN_MEANING.
UNKNOWN_MEANING = "—"
FEATURE_MEANINGS = {
    "year": "calendar year of the day",
    "t_days": "days between the trend origin and the day",
    "t_years": "trend days divided by the length of a year",
    "month": "calendar month, 1 to 12",
    "day": "place of the day in its month",
    "doy": "place of the day in its year",
    "quarter": "calendar quarter, 1 to 4",
    "dow": "weekday, Monday is 0",
    "is_weekend": "1 on Saturday and Sunday",
    "regime_pre2019": "1 before the regime year",
    "regime_2019": "1 in the regime year",
    "regime_post2019": "1 after the regime year",
    "tet_days_diff": "signed days to the nearest lunar new year within reach",
    "tet_in_7": "1 up to seven days from the lunar new year",
    "tet_in_14": "1 up to fourteen days from the lunar new year",
    "tet_on": "1 on the lunar new year",
    "is_payday": "1 on the listed pay days of a month",
    "is_month_end_zone": "1 on the closing days of a month",
    "is_last1": "1 on the final day of a month",
    "promo_year_end": "1 inside the yearly window named year_end",
    "promo_mid_year": "1 inside the yearly window named mid_year",
    "promo_spring_sale": "1 inside the yearly window named spring_sale",
    "n_active_promos": "number of intervals that cover the day",
    "sum_discount_active": "sum of the values of the intervals that cover the day",
    "hol_black_friday": "1 on the last Friday of November",
    "hol_dd_1111": "1 on 11 November",
    "hol_dd_1212": "1 on 12 December",
}

# Files a complete run expects.
REQUIRED_TABLES = (
    "sales", "sample_submission", "promotions", "orders", "order_items",
    "products", "customers", "returns", "web_traffic", "payments",
    "geography", "inventory", "reviews", "shipments",
)
