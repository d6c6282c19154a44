"""Recursive forecasts: each day is predicted from the days predicted before it.

The model is linear or a forest.  Calendar features are the same for every series:
a linear model's share of them is evaluated once per day, a forest gets them as one
row per day.  Past values are kept up to date in one pass over the series, many
series at a time, on the last values of each.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycast import constants
from tallycast.models.forest import NamedForest
from tallycast.models.ridge import RidgeModel
from tallycast.operators.dynamic import dynamic_names
from tallycast.operators.rolling import fewest_values, mean_and_deviation
from tallycast.operators.windows import with_ewm

SERIES_PER_STEP = 1000


def series_state(
    history: DataFrame, target: str, *, keys: Sequence[str],
    memory: int, spans: Sequence[int] = constants.EWM_SPANS,
) -> DataFrame:
    """One row per series: its last ``memory`` values, its length and running means."""
    means = with_ewm(
        history.select(*keys, "Date", F.col(target).cast("double").alias("y")), "y", keys, spans, 1)
    current = {
        f"ewm_{span}": F.coalesce(
            F.col("y") * (2.0 / (span + 1)) + F.col(f"y_ewm_{span}") * (1.0 - 2.0 / (span + 1)),
            F.col("y"))
        for span in spans
    }
    newest_first = Window.partitionBy(*keys).orderBy(F.desc("Date"))
    numbered = means.select(*keys, "Date", "y", *[e.alias(n) for n, e in current.items()]).withColumns({
        "age": F.row_number().over(newest_first),
        "length": F.count(F.lit(1)).over(Window.partitionBy(*keys)),
    })
    return numbered.where(F.col("age") <= memory).groupBy(*keys).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("Date", "y"))), lambda r: r["y"]).alias("tail"),
        F.max("length").alias("length"),
        *[F.max_by(name, "Date").alias(name) for name in current],
    )


def recursive_forecast(
    history: DataFrame,
    days: DataFrame,
    model: RidgeModel | NamedForest,
    target: str,
    *,
    keys: Sequence[str],
    lags: Sequence[int] = constants.LAGS,
    windows: Sequence[int] = constants.ROLLING_WINDOWS,
    spans: Sequence[int] = constants.EWM_SPANS,
) -> DataFrame:
    """Forecast the days for every series: keys, Date, target.

    ``history`` is dense and ends the day before ``days``; ``days`` has one row
    per forecast day with the model's calendar features.  The model predicts
    log1p of the target; missing inputs count as 0 and results below 0 as 0.
    """
    own = dynamic_names(target, lags, windows, spans)
    calendar = [name for name in model.features if name not in own]
    missing = [name for name in calendar if name not in days.columns]
    if missing:
        raise ValueError(f"model features without a source: {missing}")
    dates, predictor = _stepper(model, days, calendar, own)
    if len(dates):
        _no_gap(history, keys, dates[0].astype("datetime64[D]").astype(object))
    memory = max(*lags, *windows)
    state = series_state(history, target, keys=keys, memory=memory, spans=spans)

    def advance(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), SERIES_PER_STEP):
                chunk = batch.iloc[start:start + SERIES_PER_STEP]
                paths = roll_forward(
                    [np.asarray(tail, dtype=float) for tail in chunk["tail"]],
                    chunk["length"].to_numpy(),
                    {span: chunk[f"ewm_{span}"].to_numpy(dtype=float) for span in spans},
                    len(dates), predictor, memory, lags, windows)
                repeated = {key: np.repeat(chunk[key].to_numpy(), len(dates)) for key in keys}
                yield pd.DataFrame(repeated | {
                    "Date": np.tile(dates, len(chunk)), target: paths.ravel()})

    schema = T.StructType([
        *[history.schema[key] for key in keys],
        T.StructField("Date", T.DateType()), T.StructField(target, T.DoubleType())])
    return state.mapInPandas(advance, schema)


def _no_gap(history: DataFrame, keys: Sequence[str], first: dt.date) -> None:
    """A history that does not end the day before the forecast would shift every lag."""
    late = history.groupBy(*keys).agg(F.max("Date").alias("last")).where(
        F.date_add("last", 1) != F.lit(first)).limit(1).collect()
    if late:
        raise ValueError(f"history ends {late[0]['last']}, the forecast starts {first}")


def _stepper(
    model: RidgeModel | NamedForest, days: DataFrame, calendar: Sequence[str], own: Sequence[str],
) -> tuple[np.ndarray, Callable[[int, np.ndarray], np.ndarray]]:
    """The forecast days, and the model as a function of the step and the past values.

    What reaches the driver has one row per forecast day: bounded by the horizon.
    """
    if isinstance(model, RidgeModel):
        terms = days.select(
            "Date", (F.lit(model.origin) + model.term(calendar)).alias("term")).orderBy("Date").collect()
        base = np.array([row.term for row in terms])
        slopes = np.array([model.slopes.get(name, 0.0) for name in own])
        return (np.array([row.Date for row in terms], dtype="datetime64[ns]"),
                lambda step, inputs: base[step] + inputs @ slopes)
    rows = days.select("Date", F.array(*[
        F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for name in calendar]).cast("array<double>").alias("x")
    ).orderBy("Date").collect()
    fixed = np.array([row.x for row in rows], dtype=float).reshape(len(rows), len(calendar))
    place = {name: k for k, name in enumerate([*calendar, *own])}
    order = np.array([place[name] for name in model.features], dtype=int)

    def predicted(step: int, inputs: np.ndarray) -> np.ndarray:
        both = np.hstack([np.broadcast_to(fixed[step], (len(inputs), fixed.shape[1])), inputs])
        return model.forest.predict(both[:, order])

    return np.array([row.Date for row in rows], dtype="datetime64[ns]"), predicted


def roll_forward(
    tails: list[np.ndarray], lengths: np.ndarray, means: dict[int, np.ndarray],
    horizon: int, predictor: Callable[[int, np.ndarray], np.ndarray], memory: int,
    lags: Sequence[int], windows: Sequence[int],
) -> np.ndarray:
    """Predicted paths, one row per series and one column per day."""
    values = np.full((len(tails), memory + horizon), np.nan)
    for row, tail in enumerate(tails):
        values[row, memory - len(tail):memory] = tail
    means = {span: value.copy() for span, value in means.items()}
    for step in range(horizon):
        now = memory + step
        columns = [values[:, now - lag] for lag in lags]
        for width in windows:
            columns += mean_and_deviation(values[:, now - width:now], fewest_values(width))
        columns += [np.where(lengths + step >= 3, mean, np.nan) for mean in means.values()]
        inputs = np.nan_to_num(np.column_stack(columns), nan=0.0)
        predicted = np.maximum(np.expm1(predictor(step, inputs)), 0.0)
        values[:, now] = predicted
        for span, mean in means.items():
            share = 2.0 / (span + 1)
            means[span] = predicted * share + mean * (1.0 - share)
    return values[:, memory:]
