"""Boosted trees from histograms: rows as blocks of bin numbers, and several fits in one pass.

The learner is MLlib's, for squared errors: its thresholds, its gains, its stopping rules, and rows drawn
anew for every round where it asks for a share of them.
What differs is how rows lie. A task holds blocks of many rows, a byte a feature, with the running
prediction of every fit, where MLlib keeps some objects a row for every fit. Rows that agree in all features
and roles are told apart by no tree: where a count says that they are few, they are merged by one aggregate
into a row with their number and the sums of targets and squares. One pass over the blocks adds
up the histograms of the open nodes of all fits, and the errors of the round before on held-out rows, so
that boosting ends as soon as a fit's patience does. Histograms of a node are added up and judged in one
task; the driver sees the chosen splits.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tidepanel.operators.boosting import best_round
from tidepanel.sources.staging import stage, staging_path

#: Roles of a row in a fit; without one it takes no part.
TRAIN, HELD = 1, 2
#: Rows of a block, and rounds after which the running predictions are written, which cuts lineage.
BLOCK, WRITTEN = 1 << 16, 20
#: Bytes of histograms up to which the driver adds them up itself.
TOLD_BYTES = 8 << 20
#: Rows below which a fit leaves its tasks as they are, and rows and cells of vectors that one task should hold at most.
FEW_ROWS, TASK_ROWS, TASK_CELLS = 100_000, 500_000, 8_000_000
#: Rows that thresholds are learned from, at least, as in MLlib.
SAMPLE = 10_000
#: Rounds up to which a fit on shares of the rows has its draws kept with them, a bit a row and round.
DRAWN_ROUNDS = 100
#: Of MERGED_ROWS or more, rows are merged where at most one in MERGED is left, and the sums of all draws, if any, take no more than DRAWN_BYTES.
MERGED_ROWS, MERGED, DRAWN_BYTES = 1_000_000, 8, 64 << 20


def dealt(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` spread evenly over at least as many tasks as there are cores, unless they already are.

    Files are split by their bytes, and columns of few values take hardly any: one task may hold most rows
    of a table, and every pass of a fit waits for it. ``width`` is the length of the vectors.
    """
    parts = rows.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
    held = parts.agg(F.sum("n").alias("rows"), F.max("n").alias("most")).first()
    total, most = held["rows"] or 0, held["most"] or 0
    limit = min(TASK_ROWS, max(1, TASK_CELLS // max(1, width)))
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-total // limit))
    if most <= max(FEW_ROWS, 1.25 * total / tasks):
        return rows
    return rows.repartition(tasks)


def fits_by_histograms(learner: GBTRegressor) -> bool:
    """Whether the learner uses all features for squared errors, as the fits here do, and its draws can be kept."""
    whole = learner.getFeatureSubsetStrategy() == "all" and not learner.isSet(learner.weightCol)
    drawn = learner.getSubsamplingRate() == 1.0 or learner.getMaxIter() <= DRAWN_ROUNDS
    return whole and drawn and learner.getLossType() == "squared"


def thresholds(values: np.ndarray, expected: float, most: int) -> np.ndarray:
    """At most ``most`` thresholds of a sampled feature: between all values, or at equal strides of their counts.

    Zeros stand for what is missing up to the ``expected`` rows of a sample.
    """
    known, counts = np.unique(values[values != 0], return_counts=True)
    counts = counts.astype(float)
    zeros = expected - counts.sum()
    if zeros > np.finfo(float).eps * len(values) ** 2:
        at = np.searchsorted(known, 0.0)
        known, counts = np.insert(known, at, 0.0), np.insert(counts, at, zeros)
    between = (known[:-1] + known[1:]) / 2
    if len(between) <= most:
        return between
    chosen, stride = [], expected / (most + 1)
    total, wanted = counts[0], stride
    for i in range(1, len(known)):
        before, total = total, total + counts[i]
        if abs(before - wanted) < abs(total - wanted):
            chosen.append(between[i - 1])
            wanted += stride
    return np.array(chosen)


@dataclass
class Tree:
    """A growing tree: for every node its split, children and moments (rows, sum, sum of squares of the target)."""

    feature: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    moments: list[tuple[float, float, float]] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    open: list[int] = field(default_factory=list)

    def add(self, moments: tuple[float, float, float] = (0.0, 0.0, 0.0)) -> int:
        # A node without a split leads to itself.
        place = len(self.feature)
        for column, value in zip((self.feature, self.cut, self.left, self.right, self.moments, self.gain), (0, 1 << 15, place, place, moments, 0.0), strict=True):
            column.append(value)
        return place

    def is_leaf(self, node: int) -> bool:
        return self.left[node] == node

    def values(self) -> np.ndarray:
        return np.array([s / n if n else 0.0 for n, s, _ in self.moments])

    def depth(self) -> int:
        level = {0: 0}
        for i in range(len(self.feature)):
            if not self.is_leaf(i):
                level[self.left[i]] = level[self.right[i]] = level[i] + 1
        return max(level.values())

    def told(self) -> tuple:
        return (*(np.array(c) for c in (self.feature, self.cut, self.left, self.right)), self.values(), self.depth())


def _impurity(moments: Sequence[float]) -> float:
    n, s, q = moments
    return (q - s * s / n) / n if n else 0.0


def _walk(bins: np.ndarray, tree: tuple) -> np.ndarray:
    """The node in which every row ends."""
    feature, cut, left, right, _, depth = tree
    every, at = np.arange(bins.shape[1]), np.zeros(bins.shape[1], np.intp)
    for _ in range(depth):
        at = np.where(bins[feature[at], every] <= cut[at], left[at], right[at])
    return at


def best_split(histogram: np.ndarray, allowed: np.ndarray, least: int, gain: float) -> list[float]:
    """(gain, feature, bin, moments of the node, moments on the left) of a node; gain -1 where nothing may split it.

    ``histogram`` is features x bins x (rows, sum, sum of squares), ``allowed`` features x bins.
    """
    whole = histogram[0].sum(axis=0)
    if not whole[0]:
        # No row of the node was drawn.
        return [-1.0, 0, 0, *whole, 0, 0, 0]
    left = np.cumsum(histogram, axis=1)
    right = whole - left

    def weighted(part: np.ndarray) -> np.ndarray:
        n = np.maximum(part[..., 0], 1)
        return (part[..., 2] - part[..., 1] ** 2 / n) / whole[0]

    gains = _impurity(whole) - weighted(left) - weighted(right)
    valid = allowed & (left[..., 0] >= least) & (right[..., 0] >= least) & (gains >= gain)
    if not valid.any():
        return [-1.0, 0, 0, *whole, 0, 0, 0]
    feature, place = np.unravel_index(np.argmax(np.where(valid, gains, -np.inf)), gains.shape)
    return [gains[feature, place], feature, place, *whole, *left[feature, place]]


class Boosting:
    """Fits over one table of rows; ``roles`` has a column of 0, TRAIN or HELD for every learner."""

    def __init__(self, rows: DataFrame, names: Sequence[str], learners: Sequence[GBTRegressor], roles: Sequence[Column]) -> None:
        self.learners, self.width = list(learners), len(names)
        self.targets = list(dict.fromkeys(x.getLabelCol() for x in learners))
        self.target = [self.targets.index(x.getLabelCol()) for x in learners]
        # Of every (fit, round) that takes a share of the rows, which random numbers draw them: those of MLlib.
        shared = [(i, x) for i, x in enumerate(learners) if x.getSubsamplingRate() < 1]
        self.draws = {(i, m): (x.getSeed() + m + 1, x.getSubsamplingRate()) for i, x in shared for m in range(x.getMaxIter())}
        wanted = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(names)]
        wanted += [F.col(c).cast("double").alias(f"_y{i}") for i, c in enumerate(self.targets)]
        self.rows = rows.select(*wanted, *[r.cast("tinyint").alias(f"_r{i}") for i, r in enumerate(roles)])
        self._learn_thresholds()

    def _learn_thresholds(self) -> None:
        fits = range(len(self.learners))
        kinds = F.approx_count_distinct(F.xxhash64(*self._told_apart()))
        counted = self.rows.agg(F.count(F.lit(1)).alias("rows"), kinds.alias("kinds"), *[F.count_if(F.col(f"_r{i}") == TRAIN).alias(f"_r{i}") for i in fits]).first()
        totals = [counted[f"_r{i}"] for i in fits]
        if not all(totals):
            raise ValueError("a fit needs training rows with a target")
        few = counted["rows"] >= MERGED_ROWS and counted["kinds"] * MERGED <= counted["rows"]
        self.merged = few and 24 * len(self.draws) * counted["kinds"] <= DRAWN_BYTES
        bins = [min(x.getMaxBins(), n) for x, n in zip(self.learners, totals, strict=True)]
        shares = [min(1.0, max(b * b, SAMPLE) / n) for b, n in zip(bins, totals, strict=True)]
        share = max(shares)
        some = self.rows if share >= 1 else self.rows.sample(False, share, self.learners[0].getSeed())
        told = some.select(*[f"_x{i}" for i in range(self.width)], *[f"_r{i}" for i in fits]).toArrow()
        columns = [told.column(f"_x{i}").to_numpy() for i in range(self.width)]
        own = []
        for i in fits:
            mine = told.column(f"_r{i}").to_numpy() == TRAIN
            own.append([thresholds(c[mine], share * totals[i], bins[i] - 1) for c in columns])
        # Fits on different rows have thresholds of their own among those that all share.
        self.cuts = [np.unique(np.concatenate([o[f] for o in own])) for f in range(self.width)]
        self.bins = max(len(c) for c in self.cuts) + 1
        self.kind = np.uint8 if self.bins <= 256 else np.uint16
        self.allowed = []
        for i in fits:
            mask = np.zeros((self.width, self.bins), bool)
            for f in range(self.width):
                mask[f, : len(self.cuts[f])] = np.isin(self.cuts[f], own[i][f])
            self.allowed.append(mask)

    def _told_apart(self) -> list[str]:
        return [*[f"_x{i}" for i in range(self.width)], *[f"_r{i}" for i in range(len(self.learners))]]

    def _sums(self, rows: DataFrame, seeds: Mapping[int, str]) -> tuple[DataFrame, list[str], list[str]]:
        """One row for all that agree in features and roles: (number, sums, squares) of targets and of what is drawn."""
        made = {"_n": F.count(F.lit(1))}
        made |= {f"_s{i}": F.sum(f"_y{i}") for i in range(len(self.targets))}
        made |= {f"_q{i}": F.sum(F.col(f"_y{i}") ** 2) for i in range(len(self.targets))}
        drawn = {}
        for k, ((fit, _), (seed, rate)) in enumerate(self.draws.items()):
            y = F.when(F.col(seeds[seed]) < rate, F.col(f"_y{self.target[fit]}"))
            drawn |= {f"_dn{k}": F.count(y), f"_ds{k}": F.sum(y), f"_dq{k}": F.sum(y**2)}
        sums = [F.coalesce(v, F.lit(0)).cast("double").alias(c) for c, v in (made | drawn).items()]
        return stage(rows.groupBy(*self._told_apart()).agg(*sums), "merged"), list(made), list(drawn)

    def _blocks(self) -> DataFrame:
        """The rows as blocks: bins, targets and roles, features or fits one after the other.

        Of merged rows there are numbers and sums instead of targets, and the sums of every draw.
        """
        cuts, fits, kind, merged = self.cuts, len(self.learners), self.kind, self.merged
        draws = list(self.draws.values())
        seeds = {seed: f"_u{i}" for i, seed in enumerate(dict.fromkeys(seed for seed, _ in draws))}
        rows = self.rows if merged and not draws else dealt(self.rows, self.width)
        rows = rows.select("*", *[F.rand(seed).alias(name) for seed, name in seeds.items()])
        told, sums = [f"_y{i}" for i in range(len(self.targets))], []
        if merged:
            rows, told, sums = self._sums(rows, seeds)
            rows = dealt(rows, self.width + len(told) + len(sums))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, count = [], 0

            def block() -> pa.RecordBatch:
                table = pa.Table.from_batches(held)
                bins = [np.searchsorted(c, table.column(f"_x{i}").to_numpy(), side="left") for i, c in enumerate(cuts)]
                made = {
                    "n": len(table),
                    "bins": np.array(bins, kind).tobytes(),
                    "y": np.array([table.column(c).to_numpy() for c in told]).tobytes(),
                    "roles": np.array([table.column(f"_r{i}").to_numpy() for i in range(fits)], np.int8).tobytes(),
                }
                if merged:
                    made["drawn"] = np.array([table.column(c).to_numpy() for c in sums]).tobytes()
                else:
                    made["drawn"] = b"".join(np.packbits(table.column(seeds[seed]).to_numpy() < rate).tobytes() for seed, rate in draws)
                return pa.RecordBatch.from_pydict({k: [v] for k, v in made.items()})

            for batch in batches:
                held.append(batch)
                count += batch.num_rows
                if count >= BLOCK:
                    yield block()
                    held, count = [], 0
            if count:
                yield block()

        return rows.mapInArrow(pack, "n long, bins binary, y binary, roles binary, drawn binary")

    def packed(self) -> RDD:
        """The blocks as (draws, bins, targets, roles), a row a round, feature or fit, persisted for any number of fits."""
        kind, merged = self.kind, self.merged

        def opened(row: Row) -> tuple:
            bins, y, roles = (np.frombuffer(b, t).reshape(-1, row.n) for b, t in ((row.bins, kind), (row.y, float), (row.roles, np.int8)))
            drawn = np.frombuffer(row.drawn, float).reshape(-1, row.n) if merged else np.frombuffer(row.drawn, np.uint8).reshape(-1, -(-row.n // 8))
            return drawn, bins, y, roles

        return self._blocks().rdd.map(opened).persist(StorageLevel.MEMORY_AND_DISK)

    def _advanced(self, state: RDD, trees: dict[int, tuple[float, tuple]]) -> RDD:
        """The blocks with the trees of a round added to the predictions, ``trees`` by their row."""

        def advance(block: tuple) -> tuple:
            drawn, bins, y, roles, made = block
            made = made.copy()
            for row, (weight, tree) in trees.items():
                made[row] += weight * tree[4][_walk(bins, tree)]
            return drawn, bins, y, roles, made

        return state.map(advance, preservesPartitioning=True)

    def _written(self, state: RDD) -> RDD:
        """The blocks as a written table, without the lineage of earlier rounds."""
        path = staging_path(self.rows.sparkSession, "boosting")
        state.saveAsPickleFile(path)
        return self.rows.sparkSession.sparkContext.pickleFile(path, state.getNumPartitions())

    def _pass(
        self, state: RDD, done: int, trees: dict[int, Tree], errors: Sequence[int], at: dict[int, int]
    ) -> tuple[dict, dict]:
        """The best split of every open node by (fit, node), and of the fits in ``errors`` (rows, squared errors).

        ``done`` is the number of rounds before, and ``at`` has every fit's row among the predictions.
        """
        width, bins, target, targets, merged = self.width, self.bins, self.target, len(self.targets), self.merged
        draws = {fit: row for row, (fit, m) in enumerate(self.draws) if m == done}
        slots = {}
        for fit, tree in trees.items():
            slots[fit] = np.full(len(tree.feature), -1)
            slots[fit][tree.open] = np.arange(len(tree.open))
        told = {fit: tree.told() for fit, tree in trees.items()}
        errors, count = list(errors), {fit: len(tree.open) for fit, tree in trees.items()}

        def left(number: np.ndarray, total: np.ndarray, squares: np.ndarray, reached: np.ndarray) -> tuple:
            """Of merged rows: their number, and the sums and squares of what a prediction leaves of their targets."""
            return number, total - number * reached, squares - reached * (2 * total - number * reached)

        def add(blocks: Iterator[tuple]) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
            total = {fit: np.zeros((3, count[fit], width, bins)) for fit in told}
            wrong = {fit: np.zeros(2) for fit in errors}
            for drawn, x, y, roles, made in blocks:
                n = x.shape[1]
                for fit in errors:
                    held = roles[fit] == HELD
                    if merged:
                        number, _, squares = left(y[0], y[1 + target[fit]], y[1 + targets + target[fit]], made[at[fit]])
                        wrong[fit] += number[held].sum(), squares[held].sum()
                    else:
                        wrong[fit] += held.sum(), ((made[at[fit]][held] - y[target[fit]][held]) ** 2).sum()
                for fit, tree in told.items():
                    slot = slots[fit][_walk(x, tree)]
                    used = (slot >= 0) & (roles[fit] == TRAIN)
                    if fit in draws and not merged:
                        used &= np.unpackbits(drawn[draws[fit]], count=n).astype(bool)
                    mine = np.flatnonzero(used)
                    whole = len(mine) == n
                    number = None
                    if merged:
                        sums = drawn[3 * draws[fit] :][:3] if fit in draws else (y[0], y[1 + target[fit]], y[1 + targets + target[fit]])
                        number, wanted, squares = left(*sums, made[at[fit]])
                        if done:
                            wanted, squares = 2 * wanted, 4 * squares
                        if not whole:
                            number, wanted, squares = number[mine], wanted[mine], squares[mine]
                    else:
                        wanted = y[target[fit]] if not done else 2 * (y[target[fit]] - made[at[fit]])
                        if not whole:
                            wanted = wanted[mine]
                        squares = wanted * wanted
                    if not whole:
                        slot = slot[mine]
                    base = slot * bins
                    for f in range(width):
                        cell = base + (x[f] if whole else x[f][mine])
                        for i, weights in enumerate((number, wanted, squares)):
                            total[fit][i, :, f] += np.bincount(cell, weights, count[fit] * bins).reshape(-1, bins)
            for fit in told:
                for s in range(count[fit]):
                    yield (fit, s), np.ascontiguousarray(np.moveaxis(total[fit][:, s], 0, -1))
            for fit in errors:
                yield (fit, -1), wrong[fit]

        allowed = self.allowed
        rules = [(x.getMinInstancesPerNode(), x.getMinInfoGain()) for x in self.learners]

        def judged(pair: tuple[tuple[int, int], np.ndarray]) -> tuple[tuple[int, int], list[float]]:
            (fit, slot), total = pair
            return (fit, slot), total.tolist() if slot < 0 else [float(v) for v in best_split(total, allowed[fit], *rules[fit])]

        parts, tasks = state.mapPartitions(add), state.getNumPartitions()
        if 24 * width * bins * sum(count.values()) * tasks <= TOLD_BYTES:
            sums = {}
            for key, total in parts.collect():
                sums[key] = sums[key] + total if key in sums else total
            found = dict(judged(pair) for pair in sums.items())
        else:
            found = dict(parts.reduceByKey(np.add, min(tasks, sum(count.values()))).map(judged).collect())
        return {k: v for k, v in found.items() if k[1] >= 0}, {k[0]: v for k, v in found.items() if k[1] < 0}

    def _grow(self, fit: int, tree: Tree, found: dict, level: int) -> None:
        depth, opened = self.learners[fit].getMaxDepth(), []
        for slot, node in enumerate(tree.open):
            gain, feature, cut, *moments = found[fit, slot]
            whole, left = tuple(moments[:3]), tuple(moments[3:])
            if level == 0:
                tree.moments[node] = whole
            if gain <= 0 or level >= depth:
                continue
            right = tuple(a - b for a, b in zip(whole, left, strict=True))
            tree.feature[node], tree.cut[node], tree.gain[node] = int(feature), int(cut), gain
            tree.left[node], tree.right[node] = tree.add(left), tree.add(right)
            for child in (tree.left[node], tree.right[node]):
                if level + 1 < depth and abs(_impurity(tree.moments[child])) >= np.finfo(float).eps:
                    opened.append(child)
        tree.open = opened

    def fit(
        self, stopped: Sequence[int | None], rounds: Mapping[int, int] | None = None, packed: RDD | None = None
    ) -> list[GBTRegressionModel]:
        """A model of every learner; those with a patience in ``stopped`` keep the rounds up to their best one.

        ``rounds`` names the learners that are fitted and how many rounds each takes, all with their own
        number by default. ``packed`` is shared by several calls and stays persisted.
        """
        rounds = {i: x.getMaxIter() for i, x in enumerate(self.learners)} if rounds is None else rounds
        at = {fit: row for row, fit in enumerate(rounds)}
        trees: dict[int, list[Tree]] = {i: [] for i in rounds}
        errors: dict[int, list[float]] = {i: [] for i in rounds}
        running, count = set(rounds), len(at)
        blocks = self.packed() if packed is None else packed
        kept = [blocks] if packed is None else []
        # The empty predictions are made, not kept.
        state = blocks.map(lambda block: (*block, np.zeros((count, block[1].shape[1]))), preservesPartitioning=True)

        def ended(fit: int) -> bool:
            done = errors[fit]
            return len(done) >= rounds[fit] or len(done) - int(np.argmin(done)) > stopped[fit]

        try:
            for done in range(max(rounds.values()) + 1):
                growing = {i: Tree() for i in sorted(running) if done < rounds[i]}
                for tree in growing.values():
                    tree.open = [tree.add()]
                watched = [i for i in sorted(running) if stopped[i] is not None] if done else []
                level, asked = 0, growing
                while asked or watched:
                    found, wrong = self._pass(state, done, asked, watched, at)
                    for i, (n, error) in wrong.items():
                        if not n:
                            raise ValueError("early stopping needs validation rows with a target")
                        errors[i].append(error / n)
                        if ended(i):
                            running.discard(i)
                            growing.pop(i, None)
                    watched = []
                    # What the newest state was made from, now that it is there.
                    while len(kept) > 1:
                        kept.pop(0).unpersist()
                    for i, tree in growing.items():
                        if tree.open:
                            self._grow(i, tree, found, level)
                    level, asked = level + 1, {i: t for i, t in growing.items() if t.open}
                running &= set(growing)
                if not growing:
                    break
                new = {}
                for i, tree in growing.items():
                    new[at[i]] = (1.0 if done == 0 else self.learners[i].getStepSize(), tree.told())
                    trees[i].append(tree)
                # Those that have all their rounds wait for the errors of the last one.
                running = {i for i in growing if stopped[i] is not None or len(trees[i]) < rounds[i]}
                if not running:
                    break
                state = self._advanced(state, new)
                state = self._written(state) if (done + 1) % WRITTEN == 0 else state
                kept.append(state.persist(StorageLevel.MEMORY_AND_DISK))
        finally:
            for part in kept:
                part.unpersist()
        return [self._model(i, trees[i][: best_round(errors[i], stopped[i])] if stopped[i] is not None else trees[i]) for i in rounds]

    def _model(self, fit: int, trees: Sequence[Tree]) -> GBTRegressionModel:
        """The trees as a model of MLlib's."""
        learner = self.learners[fit]
        learner._transfer_params_to_java()
        sc = self.rows.sparkSession.sparkContext
        ml, gateway = sc._jvm.org.apache.spark.ml, sc._gateway
        calculator = sc._jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator

        def node(tree: Tree, values: np.ndarray, i: int):
            moments = gateway.new_array(gateway.jvm.double, 3)
            for j, v in enumerate(tree.moments[i]):
                moments[j] = float(v)
            stats = calculator(moments, int(tree.moments[i][0]))
            value, impurity = float(values[i]), _impurity(tree.moments[i])
            if tree.is_leaf(i):
                return ml.tree.LeafNode(value, impurity, stats)
            split = ml.tree.ContinuousSplit(tree.feature[i], float(self.cuts[tree.feature[i]][tree.cut[i]]))
            left, right = node(tree, values, tree.left[i]), node(tree, values, tree.right[i])
            return ml.tree.InternalNode(value, impurity, float(tree.gain[i]), left, right, split, stats)

        made = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
        weights = gateway.new_array(gateway.jvm.double, len(trees))
        for i, tree in enumerate(trees):
            values = tree.values()
            made[i] = ml.regression.DecisionTreeRegressionModel(f"{learner.uid}_{i}", node(tree, values, 0), self.width)
            weights[i] = 1.0 if i == 0 else learner.getStepSize()
        java = ml.regression.GBTRegressionModel(learner.uid, made, weights, self.width)
        learner._java_obj.copyValues(java, ml.param.ParamMap.empty())
        model = GBTRegressionModel(java)
        model._resetUid(learner.uid)
        model._transfer_params_from_java()
        return model
