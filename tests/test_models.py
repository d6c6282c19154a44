"""Fitted models against closed forms, brute force and simple properties."""

import datetime as dt
import itertools
import math
from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tallycast import constants as C
from tallycast.functions.scalars import to_log
from tallycast.models import boosted, forest, importance, ridge, search
from tallycast.models.recursive import recursive_forecast
from tallycast.operators import features
from tallycast.operators.dynamic import dynamic_names, with_dynamic_features
from tallycast.plans import components, training, variants
from tallycast.sources.dimensions import date_spine

D = dt.date
AFTER = D(2021, 3, 1)
CALENDAR = ["dow", "month", "is_weekend", "t_days", "sin_y1", "cos_y1"]


@pytest.fixture(scope="module")
def days(spark):
    date = F.col("Date")
    spine = date_spine(spark, D(2019, 7, 1), D(2021, 8, 31))
    return spine.withColumns(features.calendar_columns(date) | features.fourier_columns(date)).select(
        "Date", *CALENDAR).cache()


@pytest.fixture(scope="module")
def panel(spark):
    random = np.random.default_rng(11)
    parts = []
    for series, level in (("a", 1000.0), ("b", 300.0)):
        date = pd.date_range("2019-07-01", "2021-06-30")
        wave = 1 + 0.3 * np.sin(2 * np.pi * date.dayofyear / 365.25) + 0.2 * (date.dayofweek >= 5)
        y = level * wave * random.lognormal(0, 0.05, len(date))
        parts.append(pd.DataFrame({"series": series, "Date": date.date, "Revenue": y, "COGS": y * 0.8}))
    return spark.createDataFrame(
        pd.concat(parts), "series string, Date date, Revenue double, COGS double").cache()


@pytest.fixture(scope="module")
def history(panel, days):
    return panel.join(days, "Date").cache()


@pytest.fixture(scope="module")
def future(panel, days):
    ahead = days.where(F.col("Date") > F.lit(D(2021, 6, 30)))
    return ahead.withColumn("series", F.explode(F.array(F.lit("a"), F.lit("b")))).cache()


def test_ridge_equals_the_closed_form(history):
    labelled = history.withColumns({"label": to_log(F.col("Revenue")), "flat": F.lit(7), "gap": F.lit(None).cast("double")})
    names = [*CALENDAR, "flat", "gap"]
    model = ridge.fit_ridge(labelled.repartition(6), names, "label")
    pdf = labelled.toPandas()
    x, y = pdf[names].astype(float).fillna(0.0).to_numpy(), pdf["label"].to_numpy()
    spread = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(spread == 0, 1, spread)
    want = np.linalg.solve(z.T @ z + 3.0 * np.eye(len(names)), z.T @ (y - y.mean()))
    got = np.array([model.coefficients[n] for n in names])
    np.testing.assert_allclose(got, want, atol=1e-7)
    predicted = labelled.select("series", "Date", model.predict().alias("p")).toPandas()
    merged = pdf[["series", "Date"]].assign(want=z @ want + y.mean()).merge(predicted, on=["series", "Date"])
    np.testing.assert_allclose(merged.p, merged.want, atol=1e-8)
    parts = ridge.linear_attribution(
        labelled.na.fill(0.0), {"m": model.slopes}, model.means).toPandas().set_index("feature")
    np.testing.assert_allclose(parts.loc[names, "importance"], np.abs(z * want).mean(axis=0), atol=1e-7)


def test_weighted_ridge_equals_the_closed_form(history):
    labelled = history.withColumns({
        "label": to_log(F.col("Revenue")), "w": F.when(F.col("dow") == 2, 3.0).otherwise(0.25)})
    model = ridge.fit_ridge(labelled, CALENDAR, "label", weight="w")
    pdf = labelled.toPandas()
    x, y, w = pdf[CALENDAR].astype(float).to_numpy(), pdf["label"].to_numpy(), pdf["w"].to_numpy()
    centre = np.average(x, axis=0, weights=w)
    z = (x - centre) / np.sqrt(np.average((x - centre) ** 2, axis=0, weights=w))
    level = np.average(y, weights=w)
    want = level + z @ np.linalg.solve(
        z.T @ (w[:, None] * z) + 3.0 * np.eye(len(CALENDAR)), z.T @ (w * (y - level)))
    got = labelled.select("series", "Date", model.predict().alias("p")).toPandas()
    merged = pdf[["series", "Date"]].assign(want=want).merge(got, on=["series", "Date"])
    np.testing.assert_allclose(merged.p, merged.want, atol=1e-8)


def past_values(values, target):
    """Past-value features of the next day from pandas on the whole series."""
    s = pd.Series([*values, np.nan])
    past, x = s.shift(1), {}
    for lag in C.LAGS:
        x[f"{target}_lag_{lag}"] = s.shift(lag).iloc[-1]
    for width in C.ROLLING_WINDOWS:
        roll = past.rolling(width, min_periods=max(2, width // 3))
        x[f"{target}_roll_mean_{width}"], x[f"{target}_roll_std_{width}"] = roll.mean().iloc[-1], roll.std().iloc[-1]
    for span in C.EWM_SPANS:
        x[f"{target}_ewm_{span}"] = past.ewm(span=span, adjust=False, min_periods=3).mean().iloc[-1]
    return x


def brute_force_path(y, model, target, day_rows):
    """One series, one day at a time."""
    values = list(y)
    for day in day_rows:
        x = past_values(values, target) | dict(day)
        total = model.origin + sum(
            model.slopes[n] * (0.0 if pd.isna(x[n]) else float(x[n])) for n in model.features)
        values.append(max(np.expm1(total), 0.0))
    return values[len(y):]


def test_recursive_forecast_equals_brute_force(panel, days):
    names = [*CALENDAR, *dynamic_names("Revenue")]
    short = panel.where((F.col("series") == "a") | (F.col("Date") > F.lit(D(2021, 5, 20))))
    rows = with_dynamic_features(panel.select("series", "Date", "Revenue"), "Revenue", keys=["series"])
    frame = rows.join(days, "Date").withColumn("label", to_log(F.col("Revenue")))
    model = ridge.fit_ridge(frame, names, "label")
    ahead = days.where(F.col("Date").between(F.lit(D(2021, 7, 1)), F.lit(D(2021, 8, 9))))
    got = recursive_forecast(short, ahead, model, "Revenue", keys=["series"]).toPandas()
    day_rows = [r.asDict() for r in ahead.orderBy("Date").collect()]
    for series, part in short.toPandas().groupby("series"):
        want = brute_force_path(part.sort_values("Date")["Revenue"], model, "Revenue", day_rows)
        mine = got[got.series == series].sort_values("Date")
        assert list(mine.Date) == [r["Date"] for r in day_rows]
        np.testing.assert_allclose(mine.Revenue, want, rtol=1e-7)


def test_recursive_forecast_refuses_features_without_source(panel, days):
    model = ridge.RidgeModel(("unknown",), {"unknown": 0.0}, {"unknown": 1.0}, {"unknown": 1.0}, 0.0)
    with pytest.raises(ValueError, match="unknown"):
        recursive_forecast(panel, days, model, "Revenue", keys=["series"])


SPEC = boosted.TreeSpec("absolute", "quantile", 0.4, 3, min_leaf=5, rounds=4)


@pytest.fixture(scope="module")
def rows(history):
    labelled = history.withColumns({"label": to_log(F.col("Revenue")), "weight": F.lit(1.0)})
    return ridge.as_vectors(labelled, CALENDAR, ["series", "Date", "label", "weight"]).cache()


def test_holdout_chooses_the_rounds_and_beats_the_mean(rows):
    one = rows.where("series = 'a'")
    table = boosted.training_rows(one)
    fitted = boosted.fit_with_holdout(SPEC, table, after=AFTER)
    assert 1 <= fitted.rounds <= 4 and len(fitted.early.trees) == len(fitted.full.trees) == fitted.rounds
    assert not fitted.stopped
    held = one.where(F.col("Date") > F.lit(AFTER))
    mean = one.where(F.col("Date") <= F.lit(AFTER)).agg(F.avg("label")).first()[0]
    base = held.agg(F.avg(F.abs(F.col("label") - mean))).first()[0]
    assert fitted.error < base
    own = forest.with_prediction(fitted.early, held, ["label"]).agg(F.avg(F.abs(F.col("label") - F.col("prediction")))).first()[0]
    assert own == pytest.approx(fitted.error, rel=1e-9)
    no_holdout = boosted.fit_with_holdout(SPEC, table, after=D(2030, 1, 1))
    assert no_holdout.early is None and no_holdout.rounds == 4


def test_patience_ends_a_fit_before_the_ceiling(rows):
    spec = replace(SPEC, step=1.0, depth=5, rounds=200, patience=3)
    fitted = boosted.fit_with_holdout(spec, boosted.training_rows(rows.where("series = 'a'")), after=AFTER)
    assert fitted.stopped and len(fitted.errors) == fitted.rounds + 3 < 200
    assert fitted.error == min(fitted.errors) and len(fitted.full.trees) == fitted.rounds


def test_fits_side_by_side_are_those_of_single_runs(rows, monkeypatch):
    monkeypatch.setattr(boosted, "CHUNK", 2)
    table = boosted.training_rows(rows)
    x = np.array([r.features.toArray() for r in rows.collect()])
    cases = [
        boosted.Case(replace(SPEC, rounds=5, patience=2, step=1.0), after=AFTER), boosted.Case(replace(SPEC, rounds=3)),
        boosted.Case(boosted.TreeSpec("s", "squared", 0.5, 2, min_leaf=5, rounds=4, row_share=0.7, feature_share=0.5), quarter=2)]
    together = boosted.fit_cases(table, cases)
    for case, one in zip(cases, together):
        alone = boosted.fit_cases(table, [case])[0]
        assert (alone.rounds, alone.stopped) == (one.rounds, one.stopped)
        np.testing.assert_allclose(alone.full.predict(x), one.full.predict(x), atol=1e-12)


def test_squared_trees_are_those_of_an_exact_search(rows):
    """One split of all rows against a search over every bin edge."""
    table = boosted.training_rows(rows, bins=16)
    pdf = rows.toPandas()
    x, y = np.array([one.toArray() for one in pdf.features]), pdf.label.to_numpy()
    model = boosted.boost(boosted.TreeSpec("s", "squared", 1.0, 1, min_leaf=20, rounds=1), table)
    best = None
    for k, edges in enumerate(table.edges):
        for edge in edges:
            low = x[:, k] <= edge
            if min(low.sum(), (~low).sum()) >= 20:
                loss = ((y[low] - y[low].mean()) ** 2).sum() + ((y[~low] - y[~low].mean()) ** 2).sum()
                best = min(best or (loss, k, edge), (loss, k, edge))
    tree = model.trees[0]
    assert (tree.feature[0], tree.threshold[0]) == best[1:]
    assert ((y - model.predict(x)) ** 2).sum() == pytest.approx(best[0])
    assert tree.cover[0] == len(y) and tree.cover[1] + tree.cover[2] == len(y)


@pytest.mark.parametrize("limit", [boosted.SORTED_ROWS, 0])
def test_leaves_of_any_quantile_split_the_residuals(rows, limit, monkeypatch):
    monkeypatch.setattr(boosted, "SORTED_ROWS", limit)
    table, pdf = boosted.training_rows(rows), rows.toPandas()
    x = np.array([one.toArray() for one in pdf.features])
    shares = (0.25, 0.5, 0.9)
    fits = boosted.fit_cases(table, [boosted.Case(replace(SPEC, share=share, step=1.0, rounds=1)) for share in shares])
    for share, model in zip(shares, (one.full for one in fits)):
        leaf = model.trees[0].leaf_of(x)
        for node in np.unique(leaf):
            y = np.sort(pdf.label[leaf == node].to_numpy())
            assert model.predict(x[leaf == node])[0] == pytest.approx(y[int(np.ceil(share * len(y) - 1e-9)) - 1], abs=1e-9)


def test_bins_end_at_quantiles_and_hold_the_order(rows):
    table = boosted.training_rows(rows, bins=8)
    assert table.rows == rows.count() and table.labels == ("label",)
    x = np.array([r.features.toArray() for r in rows.collect()])
    for k, edges in enumerate(table.edges):
        assert len(edges) <= 7 and set(edges) <= set(x[:, k])
        assert np.bincount(np.searchsorted(edges, x[:, k]), minlength=1).max() <= len(x) / 8 + max(
            np.unique(x[:, k], return_counts=True)[1]) + 1
    blocks = [np.frombuffer(r.codes, np.uint8).reshape(-1, x.shape[1]) for r in table.blocks.collect()]
    got = sorted(map(tuple, np.concatenate(blocks).tolist()))
    want = np.column_stack([np.searchsorted(edges, x[:, k]) for k, edges in enumerate(table.edges)])
    assert got == sorted(map(tuple, want.tolist()))
    with pytest.raises(ValueError, match="bins"):
        boosted.training_rows(rows, bins=500)


def test_tables_without_rows_or_weight_are_refused(rows):
    for empty in (rows.where("false"), rows.withColumn("weight", F.lit(0.0))):
        for loss in ("squared", "quantile"):
            with pytest.raises(ValueError, match="weight"):
                boosted.boost(replace(SPEC, loss=loss), boosted.training_rows(empty))
    with pytest.raises(ValueError, match="no label"):
        boosted.boost(SPEC, boosted.training_rows(rows), label="other")


def test_permuting_an_unused_feature_changes_nothing(rows):
    one = rows.where("series = 'a'")
    model = boosted.boost(replace(SPEC, rounds=3), boosted.training_rows(one))
    table = {r.feature: r.importance for r in importance.permutation_importance(
        model, one, CALENDAR, keys=["series", "Date"], buckets=3).collect()}
    used = {CALENDAR[k] for tree in model.trees for k in tree.feature if k >= 0}
    shares = {r.feature: r.importance for r in forest.tree_attribution(one, {"m": model}, CALENDAR).collect()}
    assert set(table) == set(shares) == set(CALENDAR) and used != set(CALENDAR)
    assert all(table[name] == shares[name] == 0.0 for name in CALENDAR if name not in used)
    assert max(table.values()) > 0.0


def brute_force_shares(tree, row, width):
    """Shapley values over all coalitions; features left out follow the cover."""
    def value(known, node=0):
        feature = tree.feature[node]
        if feature < 0:
            return tree.value[node]
        left, right = tree.left[node], tree.right[node]
        if feature in known:
            return value(known, left if row[feature] <= tree.threshold[node] else right)
        return (tree.cover[left] * value(known, left) + tree.cover[right] * value(known, right)) / tree.cover[node]

    out = np.zeros(width)
    for k in range(width):
        others = [j for j in range(width) if j != k]
        for size in range(width):
            share = math.factorial(size) * math.factorial(width - 1 - size) / math.factorial(width)
            for chosen in itertools.combinations(others, size):
                out[k] += share * (value({*chosen, k}) - value(set(chosen)))
    return out


def test_attribution_equals_all_coalitions_and_adds_up(spark, rows):
    model = boosted.boost(
        boosted.TreeSpec("squared", "squared", 0.5, 4, min_leaf=3, rounds=4, feature_share=0.6), boosted.training_rows(rows))
    explained = forest.with_attribution(model, rows, ["series", "Date", "features"]).toPandas()
    x, shares = np.array([one.toArray() for one in explained.features]), np.array(explained.attribution.tolist())
    np.testing.assert_allclose(shares.sum(axis=1), explained.prediction - model.mean(), atol=1e-10)
    np.testing.assert_allclose(explained.prediction, model.predict(x), atol=1e-12)
    for row in range(0, len(x), 150):
        want = sum(w * brute_force_shares(tree, x[row], x.shape[1]) for tree, w in zip(model.trees, model.weights))
        np.testing.assert_allclose(shares[row], want, atol=1e-10)
    means = {r.feature: r.importance for r in forest.tree_attribution(rows, {"m": model}, CALENDAR).collect()}
    np.testing.assert_allclose([means[name] for name in CALENDAR], np.abs(shares).mean(axis=0), atol=1e-12)
    table = importance.tree_dependence(model, rows, CALENDAR, ["t_days", "is_weekend"], cells=10).toPandas()
    counts = table.groupby("feature").n.agg(["sum", "size", "max"])
    assert (counts["sum"] == len(x)).all() and counts.loc["is_weekend", "size"] == 2
    assert counts.loc["t_days", "size"] == 10 and counts.loc["t_days", "max"] <= len(x) / 10 + 2


def test_forest_of_no_trees_and_no_rows(rows):
    empty = forest.Forest(1.5)
    assert {r.prediction for r in forest.with_prediction(empty, rows, ["series"]).collect()} == {1.5}
    assert forest.with_attribution(empty, rows.where("false"), ["series"]).count() == 0
    found = forest.tree_attribution(rows.where("false"), {"m": empty}, CALENDAR).collect()
    assert len(found) in (0, len(CALENDAR)) and all(r.importance is None for r in found)


def test_recursion_with_trees_equals_brute_force(panel, days):
    names = [*CALENDAR, *dynamic_names("Revenue")]
    frame = with_dynamic_features(panel.select("series", "Date", "Revenue"), "Revenue", keys=["series"]).join(
        days, "Date").withColumns({"label": to_log(F.col("Revenue")), "weight": F.lit(1.0)})
    vectors = ridge.as_vectors(frame, names, ["series", "Date", "label", "weight"])
    trees = boosted.boost(replace(SPEC, rounds=6), boosted.training_rows(vectors))
    used = {names[k] for tree in trees.trees for k in tree.feature if k >= 0}
    assert used & set(dynamic_names("Revenue"))
    ahead = days.where(F.col("Date").between(F.lit(D(2021, 7, 1)), F.lit(D(2021, 7, 20))))
    got = recursive_forecast(panel, ahead, forest.NamedForest(tuple(names), trees), "Revenue", keys=["series"]).toPandas()

    day_rows = [r.asDict() for r in ahead.orderBy("Date").collect()]
    for series, part in panel.toPandas().groupby("series"):
        values = list(part.sort_values("Date")["Revenue"])
        for day in day_rows:
            x = past_values(values, "Revenue") | day
            row = np.array([[0.0 if pd.isna(x[n]) else float(x[n]) for n in names]])
            values.append(max(np.expm1(trees.predict(row)[0]), 0.0))
        mine = got[got.series == series].sort_values("Date")
        np.testing.assert_allclose(mine.Revenue, values[-20:], rtol=1e-9)


def test_a_gap_before_the_forecast_is_refused(panel, days):
    late = days.where(F.col("Date") > F.lit(D(2021, 7, 5)))
    model = ridge.RidgeModel(("dow",), {"dow": 0.0}, {"dow": 1.0}, {"dow": 0.0}, 1.0)
    with pytest.raises(ValueError, match="history ends"):
        recursive_forecast(panel, late, model, "Revenue", keys=["series"])


def test_search_draws_within_the_space(rows):
    small = {"absolute": {"step": ("log", 0.2, 0.5), "depth": ("int", 2, 3), "rounds": ("int", 1, 2)}}
    table = boosted.training_rows(rows)
    trials = search.search(table, [SPEC], target="Revenue", after=AFTER, trials=2, spaces=small).cache()
    for r in trials.collect():
        assert 0.2 <= r.params["step"] <= 0.5 and r.params["depth"] in (2.0, 3.0) and r.score > 0
    best = search.best_trials(trials).first()
    assert best.score == trials.agg(F.min("score")).first()[0]
    assert SPEC.tuned(best.params).depth in (2, 3)


def surface(params):
    """A smooth valley with its floor away from the middle of the space."""
    return (math.log(params["step"] / 0.02)) ** 2 + 0.05 * (params["depth"] - 6) ** 2 + 2 * (params["row_share"] - 0.9) ** 2


def test_adaptive_search_beats_free_draws():
    space = {"step": ("log", 0.001, 1.0), "depth": ("int", 2, 10), "row_share": ("real", 0.1, 1.0)}
    wins, trials = 0, 60
    for seed in range(12):
        found = search.study(space, lambda wave: [surface(one) for one in wave], trials=trials, seed=seed)
        assert len(found) == trials
        for params, _ in found:
            assert 0.001 <= params["step"] <= 1.0 and params["depth"] in range(2, 11) and 0.1 <= params["row_share"] <= 1.0
        free = np.random.default_rng(seed)
        wins += min(score for _, score in found) < min(surface(search.draw(space, free)) for _ in range(trials))
    assert wins >= 10
    again = search.study(space, lambda wave: [surface(one) for one in wave], trials=12, seed=3)
    assert again == search.study(space, lambda wave: [surface(one) for one in wave], trials=12, seed=3)


def test_trials_in_flight_differ():
    space = {"row_share": ("real", 0.0, 1.0)}
    done = [({"row_share": k / 20}, abs(k / 20 - 0.5)) for k in range(20)]
    random, wave = np.random.default_rng(1), []
    for _ in range(4):
        wave.append(search.propose(space, done, wave, random))
    assert len({round(one["row_share"], 3) for one in wave}) == 4
    assert np.mean([abs(one["row_share"] - 0.5) for one in wave]) < 0.25


def test_training_pipeline_end_to_end(history, future):
    tiny = [boosted.TreeSpec("squared", "squared", 0.4, 2, min_leaf=5, rounds=2)]
    run = training.train(
        history, future, CALENDAR, keys=["series"], after=AFTER, specs=tiny,
        weights={"Revenue": {"squared": 1.0}}, fixed={"Revenue": 3.0}, stable_years=(2019, 2021))
    assert run.holdout.count() == history.where(F.col("Date") > F.lit(AFTER)).count()
    assert run.future_variants.count() == 3 * future.count()
    scores = {r.variant: r.mae for r in run.scores.collect()}
    assert scores["per_q"] <= scores["global"] + 1e-9 and scores["global"] <= scores["default"] + 1e-9
    assert run.best.first().variant in {"per_q", "global"}
    wide = variants.targets_wide(run.future_variants, keys=["variant", "series", "Date"], targets=["Revenue"])
    assert wide.where(F.col("Revenue").isNull()).count() == 0


def test_component_pipeline(spark, history, future):
    parts = history.where(F.col("Date") != F.lit(D(2020, 1, 1))).select(
        "series", "Date", F.lit(10).alias("n_orders"), (F.col("Revenue") / 10).alias("aov"))
    joined = components.with_components(history, parts, keys=["series"])
    missing = joined.where((F.col("Date") == F.lit(D(2020, 1, 1))) & (F.col("series") == "a")).first()
    assert missing.n_orders == 0
    assert missing.aov == parts.where("series = 'a'").agg(F.median("aov")).first()[0]
    ratios = spark.createDataFrame([("a", 0.5), ("b", 1.5)], "series string, cogs_ratio double")
    tiny = [boosted.TreeSpec("squared", "squared", 0.4, 2, min_leaf=5, rounds=1)]
    got = components.component_forecast(
        joined, future, CALENDAR, ratios, keys=["series"], after=AFTER, specs=tiny, seeds=(1, 2),
        anchor=500.0, stable_years=(2019, 2021)).groupBy("series").agg(
        F.avg("Revenue").alias("r"), F.avg(F.col("COGS") / F.col("Revenue")).alias("c")).collect()
    assert {r.series: (round(r.r, 6), round(r.c, 6)) for r in got} == {"a": (500.0, 0.5), "b": (500.0, 0.98)}
