"""Boosted trees with a time-based hold-out, quarterly specialists and seeds.

Features are cut into quantile bins once and stored as small integers, which all
fits of a run read, whatever their target, weights, seed or parameters.  All fits
grow side by side: one job sums the histograms of one level of the current trees of
every fit, its reducers pick the splits, and only those reach the driver.  Margins
are kept with the rows, so a round goes on from where the last one ended; every
``CHUNK`` rounds they are written to the checkpoint folder, and a lost executor
costs what was added since.  Losses other than the squared one get the weighted
quantile of the residuals of each leaf as its value.  Fits with a hold-out end
``patience`` rounds after their best one and start again on all rows with as many.

These are hundreds of small jobs on the same cached blocks.  A job over an RDD of
blocks took 0.09 s here and one over a DataFrame 0.41 s, hence the RDD.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast import constants
from tallycast.functions.scalars import from_log
from tallycast.models.forest import Forest, Tree, with_prediction
from tallycast.operators.blend import mean_over_runs
from tallycast.session import cut_lineage, ensure_checkpoint_dir

# Rounds between two writings of the margins.
CHUNK = 20
# Bins of the stored features, and rows of one stored block.
BINS = 64
BLOCK_ROWS = 2048
# Rows up to which the residuals of a leaf are sorted in one place; beyond, the
# range is narrowed down by ``CELLS`` cells a pass.
SORTED_ROWS = 1 << 18
CELLS = 512
PASSES = 5
# Limits of quarterly models.
SPECIALIST_ROUNDS = 3000
SPECIALIST_PATIENCE = 200


@dataclass(frozen=True)
class TreeSpec:
    """Parameters of one booster.

    ``loss`` is ``squared`` or ``quantile``, whose ``share`` 0.5 is the absolute
    error.  ``rounds`` is a ceiling; fits with a hold-out stop ``patience`` rounds
    after the best one.
    """

    name: str
    loss: str
    step: float
    depth: int
    min_leaf: int = 30
    row_share: float = 1.0
    feature_share: float = 1.0
    rounds: int = 5000
    patience: int = 300
    share: float = 0.5
    seed: int = constants.SEED

    def slope(self, residual: np.ndarray) -> np.ndarray:
        """Direction in which the loss falls."""
        if self.loss == "squared":
            return residual
        return np.where(residual > 0, self.share, np.where(residual < 0, self.share - 1.0, 0.0))

    def error(self, residual: np.ndarray) -> np.ndarray:
        if self.loss == "squared":
            return residual * residual
        return 2.0 * np.maximum(residual * self.share, residual * (self.share - 1.0))

    def specialist(self) -> TreeSpec:
        """The limits of a quarter's model: never above those of the base model."""
        return replace(self, rounds=min(self.rounds, SPECIALIST_ROUNDS), patience=min(self.patience, SPECIALIST_PATIENCE))

    def tuned(self, params: Mapping[str, float]) -> TreeSpec:
        """With searched parameters in place of its own."""
        whole = {"depth", "min_leaf", "rounds", "patience", "seed"}
        known = {name: int(value) if name in whole else float(value)
                 for name, value in params.items() if name in self.__dataclass_fields__}
        return replace(self, **known)


# Learning rate, depth and shares of the four boosters.
DEFAULT_SPECS = (
    TreeSpec("squared", "squared", 0.016, 7, row_share=0.85, feature_share=0.75),
    TreeSpec("absolute", "quantile", 0.03, 6, row_share=0.85, feature_share=0.85),
    TreeSpec("deep", "quantile", 0.05, 6),
    TreeSpec("median", "quantile", 0.03, 6, row_share=0.85, feature_share=0.85),
)


@dataclass(frozen=True)
class Binned:
    """Blocks of rows (see ``blocks``), the upper edges of the bins of each feature, the
    labels in their order and the number of rows."""

    blocks: DataFrame
    edges: tuple[np.ndarray, ...]
    labels: tuple[str, ...]
    rows: int


def training_rows(
    vectors: DataFrame, *, labels: Sequence[str] = ("label",), weight: str = "weight", date: str = "Date", bins: int = BINS,
) -> Binned:
    """Cuts the features of all rows at their quantiles, found in one pass with
    mergeable summaries, and writes bin numbers, labels, weights and days once, as
    blocks.  A bin ends at its edge."""
    if not 2 <= bins <= 255:
        raise ValueError("bins must be between 2 and 255")
    given = cut_lineage(vectors.select(
        vector_to_array("features").alias("x"), F.array(*[F.col(name).cast("double") for name in labels]).alias("y"),
        F.col(weight).cast("double").alias("w"), F.datediff(date, F.lit("1970-01-01")).alias("day"),
        F.quarter(date).alias("quarter")))
    count, width = given.agg(F.count("*"), F.max(F.size("x"))).first()
    # One column for all features: literals cost more to make than to use.
    shares = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    cuts = given.agg(F.array(*[
        F.percentile_approx(F.get("x", F.lit(k)), shares, 10_000) for k in range(width or 0)])).first()[0] if count else []
    edges = tuple(np.unique(np.array(one or [], float)) for one in cuts)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                codes = np.column_stack([np.searchsorted(one, x[:, k], side="left") for k, one in enumerate(edges)])
                fields = (
                    codes.astype(np.uint8), part.column("y").flatten().to_numpy(zero_copy_only=False),
                    part.column("w").to_numpy(zero_copy_only=False), part.column("day").to_numpy(zero_copy_only=False),
                    part.column("quarter").to_numpy(zero_copy_only=False).astype(np.int8))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([one.tobytes()], pa.binary()) for one in fields], names=["codes", "y", "w", "day", "quarter"])

    # Rows go to as many tasks as there are blocks for.
    tasks = max(1, min(given.rdd.getNumPartitions() * 8, -(-(count or 0) // BLOCK_ROWS)))
    blocks = given.repartition(tasks).mapInArrow(
        packed, "codes binary, y binary, w binary, day binary, quarter binary")
    return Binned(cut_lineage(blocks), edges, tuple(labels), count)


@dataclass(frozen=True)
class Case:
    """One model to fit: its parameters, its label, the quarter whose rows weigh more,
    and the last day before the hold-out (none: all rows, ``rounds`` rounds)."""

    spec: TreeSpec
    label: str = "label"
    quarter: int | None = None
    boost: float = constants.QUARTER_BOOST
    after: dt.date | None = None
    refit: bool = True


@dataclass(frozen=True)
class Fitted:
    """A model of all rows, one of the rows before the hold-out, their rounds, the
    hold-out error, whether patience (not the ceiling) ended the search, and the
    errors and absolute errors of all rounds."""

    full: Forest | None
    early: Forest | None
    rounds: int
    error: float | None
    stopped: bool = False
    errors: tuple[float, ...] = ()
    absolute: tuple[float, ...] = ()


@dataclass
class _Fit:
    """A fit in progress.  ``held_after`` is the day number that ends its training rows."""

    case: Case
    slot: int
    rounds: int
    held_after: int | None
    origin: float = 0.0
    trees: list[Tree] = field(default_factory=list)
    errors: list[float] = field(default_factory=list)
    absolute: list[float] = field(default_factory=list)

    @property
    def bare(self) -> _Fit:
        """The fit without what it has grown, to travel with tasks."""
        return replace(self, trees=[], errors=[], absolute=[])

    @property
    def best(self) -> int:
        return int(np.argmin(self.errors)) + 1

    @property
    def done(self) -> bool:
        waited = bool(self.errors) and len(self.errors) - self.best >= self.case.spec.patience
        return waited or len(self.trees) >= self.rounds

    def forest(self, edges: Sequence[np.ndarray], count: int | None = None) -> Forest:
        trees = tuple(_raw(tree, edges) for tree in self.trees[:count])
        return Forest(self.origin, trees, (self.case.spec.step,) * len(trees))


def _raw(tree: Tree, edges: Sequence[np.ndarray]) -> Tree:
    """A tree over bin numbers as one over the features themselves."""
    threshold = tree.threshold.copy()
    for node in np.flatnonzero(tree.feature >= 0):
        threshold[node] = edges[tree.feature[node]][int(tree.threshold[node])]
    return replace(tree, threshold=threshold)


class _Growing:
    """A tree while it grows, in order of creation; ``open`` holds the nodes to split."""

    def __init__(self) -> None:
        self.feature, self.threshold, self.left, self.right = [-1], [0.0], [-1], [-1]
        self.value, self.cover = [0.0], [0.0]
        self.open = [0]

    def tree(self) -> Tree:
        return Tree(np.array(self.feature), np.array(self.threshold), np.array(self.left), np.array(self.right),
                    np.array(self.value), np.array(self.cover))

    def split(self, found: list[tuple], least: int) -> None:
        """Applies the splits of one level: (node, feature, bin, sums of both sides, own sums)."""
        self.open = []
        for node, feature, cut, left, right, own in found:
            self.cover[node], self.value[node] = own[1], own[0] / own[1] if own[1] else 0.0
            if feature < 0:
                continue
            self.feature[node], self.threshold[node] = feature, float(cut)
            for side, sums in ((self.left, left), (self.right, right)):
                side[node] = len(self.feature)
                self.feature.append(-1)
                self.threshold.append(0.0)
                self.left.append(-1)
                self.right.append(-1)
                self.value.append(sums[0] / sums[1] if sums[1] else 0.0)
                self.cover.append(sums[1])
                if sums[2] >= 2 * least:
                    self.open.append(side[node])


def _unpacked(row, labels: int) -> tuple:
    """A block as arrays: number, codes, labels by column, weights, days, quarters, margins."""
    number, block = row
    weight = np.frombuffer(block["w"])
    n = len(weight)
    return (number, np.frombuffer(block["codes"], np.uint8).reshape(n, -1), np.frombuffer(block["y"]).reshape(n, labels),
            weight, np.frombuffer(block["day"], np.int32), np.frombuffer(block["quarter"], np.int8), {})


def _weights(fit: _Fit, block: tuple) -> np.ndarray:
    """Weights of the rows a fit learns from; 0 for those of its hold-out."""
    _, _, _, weight, day, quarter, _ = block
    if fit.case.quarter is not None:
        weight = np.where(quarter == fit.case.quarter, weight * fit.case.boost, weight)
    return weight if fit.held_after is None else np.where(day > fit.held_after, 0.0, weight)


class Booster:
    """All fits of a run over one table of blocks."""

    def __init__(self, table: Binned) -> None:
        ensure_checkpoint_dir(table.blocks.sparkSession)
        self.table, width = table, len(table.labels)
        self.state: RDD = table.blocks.rdd.zipWithIndex().map(lambda pair: _unpacked((pair[1], pair[0]), width)).persist()
        self.since = 0

    def run(self, cases: Sequence[Case]) -> list[Fitted]:
        for case in cases:
            if case.label not in self.table.labels:
                raise ValueError(f"no label {case.label}")
        last_day = self._last_day()
        if last_day is None:
            raise ValueError("no row with a weight")
        fits = []
        for slot, case in enumerate(cases):
            after = None if case.after is None else (case.after - dt.date(1970, 1, 1)).days
            fits.append(_Fit(case, slot, case.spec.rounds, None if after is None or last_day <= after else after))
        first, active = {fit.slot: fit for fit in fits}, fits
        final: dict[int, _Fit] = {}
        self._begin(active)
        while active:
            self._round(active)
            ended, going = [fit for fit in active if fit.done], [fit for fit in active if not fit.done]
            again = []
            for fit in ended:
                if fit.held_after is None:
                    final[fit.slot % len(cases)] = fit
                elif fit.case.refit:
                    again.append(_Fit(fit.case, fit.slot + len(cases), fit.best, None))
            if again:
                self._begin(again)
            active = going + again
        self.state.unpersist()
        return [self._result(first[slot], final.get(slot)) for slot in range(len(cases))]

    def _result(self, first: _Fit, final: _Fit | None) -> Fitted:
        edges = self.table.edges
        full = final.forest(edges) if final is not None else None
        if first.held_after is None:
            return Fitted(full, None, first.rounds, None)
        best = first.best
        return Fitted(full, first.forest(edges, best), best, first.errors[best - 1],
                      len(first.errors) - best >= first.case.spec.patience, tuple(first.errors), tuple(first.absolute))

    def _last_day(self) -> int | None:
        return max(self.state.map(lambda block: int(block[4].max())).collect(), default=None)

    def _begin(self, fits: Sequence[_Fit]) -> None:
        """Starts margins at the mean or quantile of the labels."""
        place = {name: k for k, name in enumerate(self.table.labels)}
        squared = [fit for fit in fits if fit.case.spec.loss == "squared"]
        bare = [fit.bare for fit in squared]

        def sums(block: tuple) -> np.ndarray:
            return np.array([(w @ block[2][:, place[fit.case.label]], w.sum())
                             for fit in bare for w in [_weights(fit, block)]])

        if squared:
            totals = self.state.map(sums).reduce(np.add)
            for fit, (total, weight) in zip(squared, totals):
                fit.origin = _checked(total, weight)
        others = [fit for fit in fits if fit.case.spec.loss != "squared"]
        if others:
            for fit, found in zip(others, self._quantiles([(fit, None) for fit in others])):
                fit.origin = _checked(found[0], 0.0 if np.isnan(found[0]) else 1.0, plain=True)
        starts = [(fit.slot, fit.origin) for fit in fits]

        def started(block: tuple) -> tuple:
            return (*block[:6], block[6] | {slot: np.full(len(block[3]), origin) for slot, origin in starts})

        self._keep(self.state.map(started))

    def _keep(self, state: RDD) -> None:
        """The next state, cached; written to the checkpoint folder every ``CHUNK`` times."""
        before, self.state = self.state, state.persist()
        self.since += 1
        if self.since % CHUNK == 0:
            self.state.checkpoint()
        self.state.count()
        before.unpersist()

    def _round(self, fits: Sequence[_Fit]) -> None:
        growing = [_Growing() for _ in fits]
        deepest = max(fit.case.spec.depth for fit in fits)
        for level in range(deepest):
            asked = [k for k, fit in enumerate(fits) if level < fit.case.spec.depth and growing[k].open]
            if not asked:
                break
            plans = [(k, fits[k].bare, growing[k].tree(), growing[k].open, len(fits[k].trees)) for k in asked]
            for k, found in self._level(plans):
                growing[k].split(found, fits[k].case.spec.min_leaf)
        trees = [one.tree() for one in growing]
        renewed = [k for k, fit in enumerate(fits) if fit.case.spec.loss != "squared"]
        if renewed:
            for k, found in zip(renewed, self._quantiles([(fits[k], trees[k]) for k in renewed])):
                values = np.zeros(len(trees[k].feature))
                values[:] = np.nan_to_num(found)
                trees[k] = replace(trees[k], value=np.where(trees[k].feature < 0, values, trees[k].value))
        moves = [(fit.slot, tree, fit.case.spec.step) for fit, tree in zip(fits, trees)]

        def moved(block: tuple) -> tuple:
            margins = {slot: block[6][slot] + step * tree.value[tree.leaf_of(block[1])] for slot, tree, step in moves}
            return (*block[:6], margins)

        for fit, tree in zip(fits, trees):
            fit.trees.append(tree)
        self._keep(self.state.map(moved))
        self._look([fit for fit in fits if fit.held_after is not None])

    def _look(self, fits: Sequence[_Fit]) -> None:
        """Adds the hold-out errors of the round; hold-out rows are scored unweighted."""
        place, bare = {name: k for k, name in enumerate(self.table.labels)}, [fit.bare for fit in fits]

        def errors(block: tuple) -> np.ndarray:
            out = np.zeros((len(bare), 3))
            for k, fit in enumerate(bare):
                held = block[4] > fit.held_after
                residual = (block[2][:, place[fit.case.label]] - block[6][fit.slot])[held]
                out[k] = fit.case.spec.error(residual).sum(), np.abs(residual).sum(), len(residual)
            return out

        if fits:
            for fit, (error, absolute, n) in zip(fits, self.state.map(errors).reduce(np.add)):
                fit.errors.append(float(error / n))
                fit.absolute.append(float(absolute / n))

    def _level(self, plans: list[tuple]) -> list[tuple[int, list[tuple]]]:
        """Best splits of the open nodes of every plan."""
        place = {name: k for k, name in enumerate(self.table.labels)}
        bins = max([len(one) for one in self.table.edges], default=0) + 1

        def sums(blocks: Iterator[tuple]) -> Iterator[tuple]:
            out: dict[int, np.ndarray] = {}
            for block in blocks:
                for k, fit, tree, nodes, turn in plans:
                    found = _histogram(fit, tree, nodes, turn, block, place[fit.case.label], bins)
                    if k in out:
                        out[k] += found
                    else:
                        out[k] = found
            yield from out.items()

        chosen = {plan[0]: plan for plan in plans}

        def best(pair: tuple) -> tuple:
            _, fit, _, nodes, turn = chosen[pair[0]]
            return pair[0], _splits(pair[1], nodes, fit.case.spec, turn)

        return self.state.mapPartitions(sums).reduceByKey(np.add, len(plans)).map(best).collect()

    def _quantiles(self, asked: list[tuple[_Fit, Tree | None]]) -> list[np.ndarray]:
        """Weighted quantile of the residuals in every node of each tree (of the labels
        themselves without a tree), NaN where there are none."""
        place = {name: k for k, name in enumerate(self.table.labels)}
        asked = [(fit.bare, tree) for fit, tree in asked]

        def residuals(block: tuple) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
            for k, (fit, tree) in enumerate(asked):
                weight = _weights(fit, block)
                used = weight > 0
                label = block[2][:, place[fit.case.label]]
                value = label if tree is None else label - block[6][fit.slot]
                node = np.zeros(len(label), np.int64) if tree is None else tree.leaf_of(block[1])
                yield k, node[used], value[used], weight[used]

        sizes = [1 if tree is None else len(tree.feature) for _, tree in asked]
        shares = [fit.case.spec.share for fit, _ in asked]
        if self.table.rows <= SORTED_ROWS:
            gathered = self.state.flatMap(lambda block: [(k, [rest]) for k, *rest in residuals(block)]).reduceByKey(
                lambda a, b: a + b, len(asked))
            found = dict(gathered.map(lambda pair: (pair[0], _sorted_quantiles(pair[1], sizes[pair[0]], shares[pair[0]]))).collect())
            return [found.get(k, np.full(size, np.nan)) for k, size in enumerate(sizes)]
        return self._narrowed(residuals, sizes, shares)

    def _narrowed(self, residuals, sizes: list[int], shares: list[float]) -> list[np.ndarray]:
        """The same by ranges: each pass keeps the cell that holds the quantile.  After
        ``PASSES`` a cell is CELLS^PASSES times narrower than the values' range; the
        smallest value in it is taken."""
        first = np.cumsum([0, *sizes])

        def ranges(block: tuple) -> np.ndarray:
            out = np.vstack([np.full(first[-1], np.inf), np.full(first[-1], np.inf), np.zeros(first[-1])])
            for k, node, value, weight in residuals(block):
                np.minimum.at(out[0], first[k] + node, value)
                np.minimum.at(out[1], first[k] + node, -value)
                np.add.at(out[2], first[k] + node, weight)
            return out

        low, high, total = self.state.map(ranges).treeReduce(
            lambda a, b: np.vstack([np.minimum(a[:2], b[:2]), (a[2] + b[2])[None]]))
        high, target = -high, total * np.repeat(shares, sizes)
        below = np.zeros(first[-1])
        for _ in range(PASSES):
            span = np.where(high > low, high - low, 1.0)

            def cells(block: tuple) -> np.ndarray:
                weights = np.zeros((first[-1], CELLS))
                least = np.full((first[-1], CELLS), np.inf)
                most = np.full((first[-1], CELLS), -np.inf)
                for k, node, value, weight in residuals(block):
                    at = first[k] + node
                    inside = (value >= low[at]) & (value <= high[at])
                    at, value, weight = at[inside], value[inside], weight[inside]
                    cell = np.minimum(((value - low[at]) / span[at] * CELLS).astype(np.int64), CELLS - 1)
                    np.add.at(weights, (at, cell), weight)
                    np.minimum.at(least, (at, cell), value)
                    np.maximum.at(most, (at, cell), value)
                return np.stack([weights, least, -most])

            weights, least, most = self.state.map(cells).treeReduce(
                lambda a, b: np.stack([a[0] + b[0], np.minimum(a[1], b[1]), np.minimum(a[2], b[2])]))
            upto = below[:, None] + np.cumsum(weights, axis=1)
            filled = weights > 0
            hit = filled & (upto >= target[:, None])
            cell = np.where(hit.any(axis=1), hit.argmax(axis=1), CELLS - 1 - filled[:, ::-1].argmax(axis=1))
            at = np.arange(first[-1])
            below = upto[at, cell] - weights[at, cell]
            low, high = least[at, cell], -most[at, cell]
            if (high <= low).all():
                break
        low = np.where(np.isfinite(low), low, np.nan)
        return [low[a:b] for a, b in zip(first[:-1], first[1:])]


def _checked(total: float, weight: float, plain: bool = False) -> float:
    if not weight > 0:
        raise ValueError("no row with a weight")
    return float(total if plain else total / weight)


def _sorted_quantiles(parts: list, size: int, share: float) -> np.ndarray:
    node, value, weight = (np.concatenate([part[k] for part in parts]) for k in range(3))
    order = np.lexsort((value, node))
    node, value, weight = node[order], value[order], weight[order]
    out = np.full(size, np.nan)
    edges = np.searchsorted(node, np.arange(size + 1))
    for one, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        if b > a:
            upto = np.cumsum(weight[a:b])
            out[one] = value[a + min(int(np.searchsorted(upto, share * upto[-1] * (1 - 1e-12))), b - a - 1)]
    return out


def _histogram(fit: _Fit, tree: Tree, nodes: list[int], turn: int, block: tuple, label: int, bins: int) -> np.ndarray:
    """Sums of slopes, weights and rows per open node, feature and bin."""
    number, codes, labels = block[:3]
    spec, weight = fit.case.spec, _weights(fit, block)
    place = np.full(len(tree.feature), -1)
    place[nodes] = np.arange(len(nodes))
    own = place[tree.leaf_of(codes)]
    used = (own >= 0) & (weight > 0)
    if spec.row_share < 1.0:
        # The same rows in every level of a tree.
        used &= np.random.default_rng([spec.seed, turn, number]).random(len(used)) < spec.row_share
    rows, width = np.flatnonzero(used), codes.shape[1]
    slope = spec.slope(labels[rows, label] - block[6][fit.slot][rows]) * weight[rows]
    cell = ((own[rows, None] * width + np.arange(width)) * bins + codes[rows]).ravel()
    size = len(nodes) * width * bins
    return np.stack([
        np.bincount(cell, np.repeat(values, width), size) for values in (slope, weight[rows], np.ones(len(rows)))
    ]).reshape(3, len(nodes), width, bins)


def _splits(sums: np.ndarray, nodes: list[int], spec: TreeSpec, turn: int) -> list[tuple]:
    """Per node the split with the largest fall of the squared error of the slopes."""
    out = []
    for k, node in enumerate(nodes):
        slope, weight, count = sums[:, k]
        left = np.cumsum(sums[:, k], axis=2)
        own = left[:, 0, -1]
        right = own[:, None, None] - left
        fits = (left[2] >= spec.min_leaf) & (right[2] >= spec.min_leaf) & (left[1] > 0) & (right[1] > 0)
        if spec.feature_share < 1.0:
            draw = np.random.default_rng([spec.seed, turn, node, 1])
            width = len(slope)
            chosen = draw.choice(width, max(1, round(width * spec.feature_share)), replace=False)
            allowed = np.zeros(width, bool)
            allowed[chosen] = True
            fits &= allowed[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(fits, left[0] ** 2 / left[1] + right[0] ** 2 / right[1] - own[0] ** 2 / own[1], -np.inf)
        feature, cut = np.unravel_index(int(np.argmax(gain)), gain.shape)
        if gain[feature, cut] > 1e-12 * max(own[1], 1.0):
            out.append((node, int(feature), int(cut), left[:, feature, cut], right[:, feature, cut], own))
        else:
            out.append((node, -1, 0, None, None, own))
    return out


def fit_cases(table: Binned, cases: Sequence[Case]) -> list[Fitted]:
    """All cases fitted side by side, in their order."""
    return Booster(table).run(cases) if cases else []


def boost(spec: TreeSpec, table: Binned, *, label: str = "label") -> Forest:
    """A forest of all rows with all its rounds."""
    return fit_cases(table, [Case(spec, label)])[0].full


def fit_with_holdout(spec: TreeSpec, table: Binned, *, after: dt.date, label: str = "label") -> Fitted:
    """Choose the number of trees on the hold-out, then refit on all rows.

    Predictions of ``early`` on the hold-out are unbiased.
    """
    return fit_cases(table, [Case(spec, label, after=after)])[0]


def predict(forest: Forest, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Predictions on the original scale: keys and yhat.  ``rows`` has ``features``."""
    return with_prediction(forest, rows, keys).select(*keys, from_log(F.col("prediction")).alias("yhat"))


def fit_specialists(
    spec: TreeSpec, table: Binned, *, after: dt.date, label: str = "label",
    quarters: Iterable[int] = (1, 2, 3, 4), boost: float = constants.QUARTER_BOOST,
) -> dict[int, Fitted]:
    """One model per quarter, trained with that quarter's rows weighted up."""
    quarters = list(quarters)
    cases = [Case(spec.specialist(), label, quarter, boost, after) for quarter in quarters]
    return dict(zip(quarters, fit_cases(table, cases)))


def predict_specialists(
    models: Mapping[int, Fitted], rows: DataFrame, keys: Sequence[str], *, early: bool = False
) -> DataFrame:
    """Every row predicted by its own quarter's model."""
    parts = None
    for quarter, fitted in models.items():
        model = fitted.early if early and fitted.early is not None else fitted.full
        part = predict(model, rows.where(F.quarter("Date") == quarter), keys)
        parts = part if parts is None else parts.unionByName(part)
    return parts


def predict_over_seeds(
    specs: Sequence[TreeSpec], table: Binned, future: DataFrame, keys: Sequence[str], *,
    after: dt.date, labels: Sequence[str] = ("label",), seeds: Sequence[int] = constants.COMPONENT_SEEDS,
) -> dict[str, DataFrame]:
    """Per label the mean prediction of every spec fitted with every seed, not below zero."""
    cases = [Case(replace(spec, seed=seed), label, after=after) for label in labels for seed in seeds for spec in specs]
    runs: dict[str, DataFrame] = {}
    for case, fitted in zip(cases, fit_cases(table, cases)):
        part = predict(fitted.full, future, keys)
        runs[case.label] = runs[case.label].unionByName(part) if case.label in runs else part
    return {label: mean_over_runs(parts, keys=keys) for label, parts in runs.items()}
