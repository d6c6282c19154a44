"""Lag, rolling and exponentially weighted features of a target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tallycast import constants
from tallycast.operators.rolling import rolling_names, with_rolling
from tallycast.operators.windows import by_date, lag_columns, with_ewm


def dynamic_names(
    target: str,
    lags: Sequence[int] = constants.LAGS,
    windows: Sequence[int] = constants.ROLLING_WINDOWS,
    spans: Sequence[int] = constants.EWM_SPANS,
) -> list[str]:
    """Names in the order the features enter a model."""
    return [
        *[f"{target}_lag_{k}" for k in lags],
        *rolling_names(target, windows),
        *[f"{target}_ewm_{span}" for span in spans],
    ]


def with_dynamic_features(
    panel: DataFrame,
    target: str,
    *,
    keys: Sequence[str],
    lags: Sequence[int] = constants.LAGS,
    windows: Sequence[int] = constants.ROLLING_WINDOWS,
    spans: Sequence[int] = constants.EWM_SPANS,
) -> DataFrame:
    """All past-value features with a single shuffle by series."""
    lagged = panel.withColumns(lag_columns(target, by_date(keys), lags))
    return with_rolling(with_ewm(lagged, target, keys, spans), target, keys, windows)
