"""Statistics across entities within a date, era or peer group."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.operators.skew import (
    HotKeys,
    attach,
    attach_all,
    find_hot,
    hot_rows,
    running_total,
    salted_join,
    split_hot,
)
from tidepanel.sources.staging import stage

QUINTILES = (0.0, 0.2, 0.4, 0.6, 0.8, 1.0)

# Ranks from a sketch of this accuracy are off by at most one row in a thousand.
SKETCH = 1000

#: Standard errors of a sampled quantile that its bracket leaves on either side.
MARGIN = 5.5
#: Bytes of brackets that every task is told at most, and rows that a task counts by group at a time.
TOLD_BYTES, COUNTED_ROWS = 64 << 20, 1 << 18


def group_means(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], prefix: str = ""
) -> DataFrame:
    """One row per group with the mean of every column."""
    return df.groupBy(*keys).agg(*[F.avg(c).alias(f"{prefix}{c}") for c in columns])


def with_group_means(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], prefix: str
) -> DataFrame:
    """Every row with the means of its group, as ``<prefix><column>``."""
    return attach(df, group_means(df, keys, columns, prefix), keys)


def peer_means(
    df: DataFrame, groups: Mapping[str, Sequence[str]], value: str, source: DataFrame | None = None, written: bool = False
) -> DataFrame:
    """Every row with the mean of ``value`` over each peer group; ``groups`` maps name to keys.

    Several groups share one scan of the rows: sums and counts by all their keys together, from which
    each group's are added up. ``source`` is a cheaper frame of the same rows. With ``written`` every reader
    of the result sees the same means to the last bit.
    """
    source, total, count = df if source is None else source, F.sum(value), F.count(value)
    if len(groups) > 1:
        every = list(dict.fromkeys(k for keys in groups.values() for k in keys))
        source = stage(source.groupBy(*every).agg(F.sum(value).alias("_sum"), F.count(value).alias("_count")), "peers")
        total, count = F.sum("_sum"), F.sum("_count")
    stats = [(source.groupBy(*k).agg(F.try_divide(total, count).alias(out)), k) for out, k in groups.items()]
    return attach_all(df, [(stage(t, "peers"), k) for t, k in stats] if written else stats)


def average_rank(
    df: DataFrame, keys: Sequence[str], value: str, rank: str = "_rank", size: str = "_size"
) -> DataFrame:
    """Add the 1-based rank of ``value`` with ties averaged, and the number of ranked rows.

    Null values get a null rank and are not counted. Without ``keys`` the whole frame is
    one group. A hot group is ranked through its distinct values and their counts.
    """
    keys = list(keys)
    ordinary, hot = split_hot(df, keys, find_hot(df, keys))
    by_value = Window.partitionBy(*keys).orderBy(F.col(value).asc_nulls_last())
    ties = F.count(value).over(by_value.rangeBetween(Window.currentRow, Window.currentRow))
    ranked = F.rank().over(by_value) + (ties - 1) / 2
    result = ordinary.withColumns(
        {
            rank: F.when(F.col(value).isNotNull(), ranked),
            size: F.count(value).over(Window.partitionBy(*keys)),
        }
    )
    if hot is None:
        return result
    counted = (
        hot.filter(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("_ties"))
    )
    counted = stage(counted, "ties")
    placed = running_total(counted, keys, [value], "_ties")
    table = stage(
        placed.select(
            *keys, value, "_ties", (F.col("_before") + (F.col("_ties") + 1) / 2).alias(rank)
        ),
        "ranks",
    )
    sizes = counted.groupBy(*keys).agg(F.sum("_ties").alias(size))
    heavy = counted.filter(F.col("_ties") > hot_rows(df.sparkSession))
    tied = HotKeys(heavy.withColumnRenamed("_ties", "_n"), 0)
    spread = salted_join(hot, table, [*keys, value], tied)
    if keys:
        spread = attach(spread, sizes, keys)
    else:
        spread = spread.crossJoin(F.broadcast(sizes))  # one row
    spread = spread.withColumn(size, F.coalesce(size, F.lit(0).cast("bigint")))
    return result.unionByName(spread.select(*result.columns))


def percent_rank(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Add the average rank divided by the number of ranked rows, in (0, 1]."""
    ranked = average_rank(df, keys, value)
    return ranked.withColumn(out, F.col("_rank") / F.col("_size")).drop("_rank", "_size")


def centered_rank(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Add (average rank - 0.5) / count, strictly inside (0, 1)."""
    ranked = average_rank(df, keys, value)
    inside = (F.col("_rank") - 0.5) / F.col("_size")
    return ranked.withColumn(out, inside).drop("_rank", "_size")


def quantile_edges(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    probabilities: Sequence[float] = QUINTILES,
    bound: DataFrame | None = None,
) -> DataFrame:
    """One row per group: exact linear-interpolated quantiles of every column, as an array each.

    ``percentile`` keeps the distinct values of a group in memory, so the hot limit is
    shared out over the columns; larger groups are bracketed by a sketch and refined. ``bound`` is
    a frame with no fewer rows per group that is cheaper to count than ``df``.
    """
    limit = max(1, hot_rows(df.sparkSession) // len(columns))
    counted = df if bound is None else bound
    narrow = df.select(*keys, *columns)
    ordinary, hot = split_hot(narrow, keys, find_hot(counted, keys, limit))
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    edges = ordinary.groupBy(*keys).agg(*[F.percentile(c, wanted).alias(c) for c in columns])
    if hot is None:
        return edges
    return edges.unionByName(_bracketed_edges(hot, list(keys), list(columns), probabilities))


def _bracketed_edges(
    hot: DataFrame, keys: list[str], columns: list[str], probabilities: Sequence[float]
) -> DataFrame:
    """Exact quantiles of large groups without sorting them.

    A mergeable sketch brackets every quantile. One pass counts the values below each
    bracket, another puts only the values inside in order: a few in a thousand per
    quantile. A group whose bracket misses is sorted in full.
    """
    inner = [float(p) for p in probabilities if 0 < p < 1]
    hot = hot.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns])
    margin = 2 / SKETCH
    sides = F.array(*[F.lit(q) for p in inner for q in (max(p - margin, 0), min(p + margin, 1))])
    sketch = stage(
        hot.groupBy(*keys).agg(
            *[F.percentile_approx(c, sides, SKETCH).alias(f"_q_{c}") for c in columns],
            *[
                F.struct(F.count(c).alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi")).alias(
                    f"_all_{c}"
                )
                for c in columns
            ],
        ),
        "sketch",
    )
    rows = attach(hot, sketch.select(*keys, *[f"_q_{c}" for c in columns]), keys)
    edges = [(c, i) for c in columns for i in range(len(inner))]

    def low(c: str, i: int) -> Column:
        return F.col(f"_q_{c}")[2 * i]

    below = rows.groupBy(*keys).agg(
        *[F.count_if(F.col(c) < low(c, i)).alias(f"_below_{c}_{i}") for c, i in edges]
    )
    cells = [
        F.when(
            F.col(c).between(low(c, i), F.col(f"_q_{c}")[2 * i + 1]),
            F.struct(F.lit(c).alias("_name"), F.lit(i).alias("_edge"), F.col(c).alias("_value")),
        )
        for c, i in edges
    ]
    part = [*keys, "_name", "_edge"]
    inside = rows.select(*keys, F.explode(F.array_compact(F.array(*cells))).alias("_cell"))
    ties = stage(
        inside.select(*keys, "_cell.*").groupBy(*part, "_value").agg(
            F.count(F.lit(1)).alias("_ties")
        ),
        "ties",
    )
    facts = sketch.join(below, keys).select(
        *keys,
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("_name"),
                        F.lit(i).alias("_edge"),
                        (F.lit(inner[i]) * (F.col(f"_all_{c}.n") - 1)).alias("_spot"),
                        F.col(f"_below_{c}_{i}").alias("_below"),
                    )
                    for c, i in edges
                ]
            )
        ).alias("_fact"),
    )
    placed = attach(
        running_total(ties, part, ["_value"], "_ties"), facts.select(*keys, "_fact.*"), part
    )
    start = F.col("_below") + F.col("_before")

    def at(position: Column) -> Column:
        here = (start <= position) & (position < start + F.col("_ties"))
        return F.max(F.when(here, F.col("_value")))

    found = placed.groupBy(*part, "_spot").agg(
        at(F.floor("_spot")).alias("_lo"), at(F.ceil("_spot")).alias("_hi")
    )
    found = found.select(*part, _between("_lo", "_hi", F.col("_spot")).alias("_at"))
    wide = found.groupBy(*keys).agg(
        *[
            F.max(F.when((F.col("_name") == c) & (F.col("_edge") == i), F.col("_at"))).alias(
                f"_at_{c}_{i}"
            )
            for c, i in edges
        ]
    )
    joined = sketch.join(wide, keys, "left")

    def whole(c: str) -> Column:
        points = iter(range(len(inner)))
        ends = {0.0: F.col(f"_all_{c}.lo"), 1.0: F.col(f"_all_{c}.hi")}
        steps = [
            ends[float(p)] if float(p) in ends else F.col(f"_at_{c}_{next(points)}")
            for p in probabilities
        ]
        return F.when(F.col(f"_all_{c}.n") > 0, F.array(*steps))

    missed = [
        F.coalesce(F.exists(whole(c), lambda v: v.isNull()), F.lit(False)) for c in columns
    ]
    result = stage(
        joined.select(
            *keys, *[whole(c).alias(c) for c in columns], F.greatest(*missed, F.lit(False)).alias("_missed")
        ),
        "edges",
    )
    again = result.filter("_missed").select(*keys)
    result = result.filter("not _missed").drop("_missed")
    if again.isEmpty():
        return result
    return result.unionByName(
        _sorted_edges(hot.join(again, keys, "left_semi"), keys, columns, probabilities)
    )


def _between(low: str, high: str, spot: Column) -> Column:
    """Linear interpolation between the values at the floor and the ceiling of ``spot``."""
    mixed = (F.ceil(spot) - spot) * F.col(low) + (spot - F.floor(spot)) * F.col(high)
    return F.when(F.col(low) == F.col(high), F.col(low)).otherwise(mixed)


def _sorted_edges(
    hot: DataFrame, keys: list[str], columns: Sequence[str], probabilities: Sequence[float]
) -> DataFrame:
    long = hot.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        keys, list(columns), "_name", "_value"
    )
    part = [*keys, "_name"]
    ties = (
        long.filter(F.col("_value").isNotNull())
        .groupBy(*part, "_value")
        .agg(F.count(F.lit(1)).alias("_ties"))
    )
    ties = stage(ties, "ties")
    sizes = stage(ties.groupBy(*part).agg(F.sum("_ties").alias("_size")), "sizes")
    placed = running_total(ties, part, ["_value"], "_ties").join(sizes, part)

    def at(position: Column) -> Column:
        inside = (F.col("_before") <= position) & (
            position < F.col("_before") + F.col("_ties")
        )
        return F.max(F.when(inside, F.col("_value")))

    found = placed.groupBy(*part, "_size").agg(
        *[
            at(rounding(F.lit(float(p)) * (F.col("_size") - 1))).alias(f"_{side}{i}")
            for i, p in enumerate(probabilities)
            for side, rounding in (("lo", F.floor), ("hi", F.ceil))
        ]
    )
    steps = [
        _between(f"_lo{i}", f"_hi{i}", F.lit(float(p)) * (F.col("_size") - 1))
        for i, p in enumerate(probabilities)
    ]
    arrays = found.select(*part, F.array(*steps).alias("_edges"))
    return arrays.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_name") == c, F.col("_edges"))).alias(c) for c in columns]
    )


def bucket(value: str, bounds: str, buckets: int) -> Column:
    """Bucket number of ``value``: how many inner bounds it lies above; null without any.

    A chain of comparisons, so that it stays inside generated code.
    """
    v = F.col(value)
    label = F.when(v <= F.col(f"{bounds}.b1"), 0)
    for i in range(2, buckets):
        label = label.when(v <= F.col(f"{bounds}.b{i}"), i - 1)
    return F.when(v.isNotNull() & F.col(f"{bounds}.b1").isNotNull(), label.otherwise(buckets - 1))


def _inner_bounds(edges: str, buckets: int) -> Column:
    """Distinct edges after the first as fields b1..; absent ones lie above every value."""
    distinct = F.array_distinct(F.col(edges))
    fields = [F.get(distinct, F.lit(1)).alias("b1")]
    for i in range(2, buckets):
        above = F.coalesce(F.get(distinct, F.lit(i)), F.lit(float("inf")))
        fields.append(above.alias(f"b{i}"))
    return F.struct(*fields)


def _group_labels(values: np.ndarray) -> np.ndarray:
    """Quintiles 0..4 of every column of one group; NaN for missing values and for a single edge."""
    placed = np.sort(values, axis=0)
    known = np.count_nonzero(~np.isnan(values), axis=0)
    spot = np.array(QUINTILES)[:, None] * np.maximum(known - 1, 0)
    low, high = (np.take_along_axis(placed, side(spot).astype(int), axis=0) for side in (np.floor, np.ceil))
    mixed = (np.ceil(spot) - spot) * low + (spot - np.floor(spot)) * high
    edges = np.where(low == high, low, mixed)
    # An edge counts once, and the least one bounds nothing.
    own = edges[1:] != edges[:-1]
    labels = np.zeros_like(values)
    for edge, counts in zip(edges[1:-1], own[:-1], strict=True):
        labels += (values > edge) & counts
    labels[np.isnan(values) | ~(own & ~np.isnan(edges[1:])).any(axis=0)] = np.nan
    return labels


def _doubles(table: pa.Table | pa.RecordBatch, columns: Sequence[str]) -> np.ndarray:
    """Columns as doubles, one after the other; NaN for what is missing."""
    made = np.empty((len(columns), table.num_rows))
    for i, c in enumerate(columns):
        made[i] = table.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False)
    return made


def _sampled_brackets(some: DataFrame, columns: Sequence[str], inner: Sequence[float]) -> DataFrame:
    """Of every sampled ``_group`` two values for each column and quantile between which it should lie."""
    p, columns = np.array(inner), list(columns)

    def bracket(table: pa.Table) -> pa.Table:
        values = np.sort(_doubles(table, columns), axis=1)
        known = np.count_nonzero(~np.isnan(values), axis=1)[:, None]
        slack = MARGIN * np.sqrt(known * p * (1 - p)) + 1
        low, high = np.floor(known * p - slack).astype(int), np.ceil(known * p + slack).astype(int)
        lows = np.where(low < 0, -np.inf, np.take_along_axis(values, np.maximum(low, 0), axis=1))
        highs = np.where(high >= known, np.inf, np.take_along_axis(values, np.minimum(high, values.shape[1] - 1), axis=1))
        return pa.table({"_group": table.column("_group")[:1], "bounds": [np.stack([lows, highs], axis=1).ravel()]})

    return some.select("_group", *columns).groupBy("_group").applyInArrow(bracket, "_group long, bounds array<double>")


def _counted_edges(
    rows: DataFrame, columns: Sequence[str], inner: Sequence[float], groups: np.ndarray, bounds: np.ndarray
) -> DataFrame:
    """Of every ``_group`` the edges of all columns, in which a quantile outside its bracket is missing.

    A task counts the values below every bracket and sends on only those inside it, packed by group.
    ``groups`` are in order; ``bounds`` is groups x columns x (low, high) x quantiles.
    """
    columns, wide, cells = list(columns), len(columns), len(columns) * len(inner)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def told() -> pa.RecordBatch:
            at = _places(groups, np.concatenate([b.column("_group").to_numpy() for b in held]))
            order = np.argsort(at, kind="stable")
            present, start, sizes = np.unique(at[order], return_index=True, return_counts=True)
            values = np.concatenate([_doubles(b, columns) for b in held], axis=1)[:, order]
            numbers = np.zeros((len(present), wide + 2 * cells), np.int32)
            ends = np.empty((len(present), 2 * wide))
            kept = []
            for c, v in enumerate(values):
                numbers[:, c] = np.add.reduceat(~np.isnan(v), start, dtype=np.int32)
                ends[:, c], ends[:, wide + c] = np.fmin.reduceat(v, start), np.fmax.reduceat(v, start)
                for e in range(len(inner)):
                    low, high = (np.repeat(bounds[present, c, side, e], sizes) for side in (0, 1))
                    inside = (v >= low) & (v <= high)
                    cell = wide + c * len(inner) + e
                    numbers[:, cell] = np.add.reduceat(v < low, start, dtype=np.int32)
                    numbers[:, cell + cells] = np.add.reduceat(inside, start, dtype=np.int32)
                    kept.append(v[inside])
            # The ends of a group come first, then what is inside, cell by cell.
            many = numbers[:, wide + cells :]
            stops = np.cumsum(2 * wide + many.sum(axis=1))
            flat = np.empty(stops[-1])
            begin = np.concatenate([[0], stops[:-1]])
            flat[begin[:, None] + np.arange(2 * wide)] = ends
            into = begin[:, None] + 2 * wide + np.cumsum(many, axis=1) - many
            for j, v in enumerate(kept):
                before = np.cumsum(many[:, j]) - many[:, j]
                flat[np.repeat(into[:, j] - before, many[:, j]) + np.arange(len(v))] = v
            lists = [
                pa.ListArray.from_arrays(np.arange(len(present) + 1, dtype=np.int32) * numbers.shape[1], numbers.ravel()),
                pa.ListArray.from_arrays(np.concatenate([[0], stops]).astype(np.int32), flat),
            ]
            return pa.RecordBatch.from_arrays([pa.array(groups[present]), *lists], names=["_group", "numbers", "inside"])

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                count += batch.num_rows
            if count >= COUNTED_ROWS:
                yield told()
                held, count = [], 0
        if count:
            yield told()

    def found(table: pa.Table) -> pa.Table:
        parts = np.array([x.values.to_numpy() for x in table.column("numbers")])
        flat = [x.values.to_numpy() for x in table.column("inside")]
        ends = np.array([x[: 2 * wide] for x in flat])
        many = parts[:, wide + cells :]
        values = np.concatenate([x[2 * wide :] for x in flat])
        cell = np.repeat(np.tile(np.arange(cells), len(parts)), many.ravel())
        values = values[np.lexsort((values, cell))]
        total = parts.sum(axis=0, dtype=np.int64)
        known, below, inside = total[:wide], total[wide : wide + cells], total[wide + cells :]
        start = np.cumsum(inside) - inside
        spot = np.array(inner) * np.maximum(known - 1, 0)[:, None]

        def at(place: np.ndarray) -> np.ndarray:
            place = place.astype(int).ravel() - below
            ours = (place >= 0) & (place < inside)
            made = np.full(cells, np.nan)
            made[ours] = values[(start + place)[ours]]
            return made.reshape(wide, -1)

        low, high = at(np.floor(spot)), at(np.ceil(spot))
        mixed = np.where(low == high, low, (np.ceil(spot) - spot) * low + (spot - np.floor(spot)) * high)
        least, most = np.fmin.reduce(ends[:, :wide], axis=0), np.fmax.reduce(ends[:, wide:], axis=0)
        edges = np.column_stack([least, mixed, most])
        return pa.table({"_group": table.column("_group")[:1], "edges": [edges.ravel()]})

    packed = rows.select("_group", *columns).mapInArrow(counted, "_group long, numbers array<int>, inside array<double>")
    return packed.groupBy("_group").applyInArrow(found, "_group long, edges array<double>")


def _places(groups: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.searchsorted(groups, wanted)
    if (groups[np.minimum(at, len(groups) - 1)] != wanted).any():
        raise ValueError("a group that the bound does not have")
    return at


def _told(made: DataFrame, groups: np.ndarray, into: np.ndarray) -> np.ndarray:
    """Arrays by ``_group`` put in their places of ``into``; the places."""
    table = made.toArrow()
    at = _places(groups, table.column("_group").to_numpy())
    if len(at):
        into[at] = np.array([x.values.to_numpy() for x in table.column(1)]).reshape(len(at), *into.shape[1:])
    return at


def _labelled_in_place(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], suffix: str, groups: np.ndarray, some: DataFrame
) -> DataFrame:
    """Quintiles of groups too large for a task with all their columns; no row moves.

    A sample brackets the quantiles. One pass counts what lies below each bracket and sends on what lies
    inside it, which is enough for exact edges, and another labels the rows where they are made. A group
    whose bracket misses is counted again with all its values.
    """
    columns, inner = list(columns), [p for p in QUINTILES if 0 < p < 1]
    group = F.xxhash64(*keys).alias("_group")
    bounds = np.empty((len(groups), len(columns), 2, len(inner)))
    bounds[:, :, 0], bounds[:, :, 1] = -np.inf, np.inf
    _told(_sampled_brackets(some.select(group, *columns), columns, inner), groups, bounds)
    rows = df.select("*", group)
    edges = np.full((len(groups), len(columns), len(QUINTILES)), np.nan)
    _told(_counted_edges(rows, columns, inner, groups, bounds), groups, edges)
    missed = np.flatnonzero((np.isnan(edges[:, :, 1:-1]).any(axis=2) & ~np.isnan(edges[:, :, 0])).any(axis=1))
    if len(missed):
        bounds[missed, :, 0], bounds[missed, :, 1] = -np.inf, np.inf
        again = rows.filter(F.col("_group").isin([int(g) for g in groups[missed]]))
        _told(_counted_edges(again, columns, inner, groups, bounds), groups, edges)
    # As in _group_labels: an edge counts once, and the least one bounds nothing.
    own = edges[:, :, 1:] != edges[:, :, :-1]
    single = ~(own & ~np.isnan(edges[:, :, 1:])).any(axis=2)
    steps = np.ascontiguousarray(np.where(own[:, :, :-1], edges[:, :, 1:-1], np.inf).transpose(1, 2, 0))
    single = np.ascontiguousarray(single.T)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _places(groups, batch.column("_group").to_numpy()) if batch.num_rows else np.zeros(0, int)
            made = []
            for c, values in enumerate(_doubles(batch, columns)):
                labels = np.zeros(len(values), np.float32)
                for step in steps[c]:
                    labels += values > step[at]
                labels[np.isnan(values) | single[c][at]] = np.nan
                made.append(pa.array(labels, from_pandas=True))
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], *made], names=[*names, *[f"{c}{suffix}" for c in columns]])

    names = df.columns
    fields = [*df.schema.fields, *(T.StructField(f"{c}{suffix}", T.FloatType()) for c in columns)]
    return rows.mapInArrow(label, T.StructType(fields))


def quintiles(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    suffix: str = "_quintile",
    bound: DataFrame | None = None,
    some: Callable[[float], DataFrame] | None = None,
) -> DataFrame:
    """Add a value-based quintile 0..4 per group for every column; equal edges are merged.

    A group of ordinary size is labelled by the task that holds it: its rows are shuffled once. With larger
    groups all rows stay where they are, see ``_labelled_in_place``. Where one has more than ``hot_rows`` rows,
    or there are too many, the rows of the larger groups are written and meet the edges of
    ``quantile_edges``, which no task has to see whole. NaN counts as missing. ``bound`` is a frame with no
    fewer rows per group that is cheaper to count than ``df``, and ``some`` gives about a share of the rows of
    every group more cheaply than a sample of ``df``; results do not depend on which.
    """
    keys, columns = list(keys), list(columns)
    limit = max(1, hot_rows(df.sparkSession) // len(columns))
    counted = df if bound is None else bound
    found = find_hot(counted, keys, limit)
    if found.keys is not None and keys:
        sizes = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        told = sizes.agg(F.count(F.lit(1)).alias("groups"), F.sum("_n").alias("rows"), F.max("_n").alias("most")).first()
        if told["most"] <= hot_rows(df.sparkSession) and 64 * len(columns) * told["groups"] <= TOLD_BYTES:
            groups = np.unique(sizes.select(F.xxhash64(*keys).alias("_group")).toArrow().column(0).to_numpy())
            if len(groups) == told["groups"]:
                # The larger the sample, the fewer rows are inside the brackets; this share moves least.
                share = min(1.0, (2 * MARGIN * 0.9 / math.sqrt(told["rows"] / told["groups"])) ** (2 / 3))
                drawn = some(share) if some else df.sample(False, share, 7)
                return _labelled_in_place(df, keys, columns, suffix, groups, drawn)
    ordinary, hot = split_hot(df, keys, found)

    def label(table: pa.Table) -> pa.Table:
        values = np.column_stack([table.column(c).cast(pa.float64()).to_numpy() for c in columns])
        with np.errstate(invalid="ignore"):
            labels = _group_labels(values).astype(np.float32)
        flat = pa.array(labels.T.ravel(), from_pandas=True)
        made = [flat.slice(i * len(labels), len(labels)) for i in range(len(columns))]
        return pa.Table.from_arrays([*table.columns, *made], names=[*table.column_names, *[f"{c}{suffix}" for c in columns]])

    fields = [*df.schema.fields, *(T.StructField(f"{c}{suffix}", T.FloatType()) for c in columns)]
    made = ordinary.groupBy(*keys).applyInArrow(label, T.StructType(fields))
    if hot is None:
        return made
    buckets = len(QUINTILES) - 1
    edges = _bracketed_edges(hot.select(*keys, *columns), keys, columns, QUINTILES)
    bounds = edges.select(*keys, *[_inner_bounds(c, buckets).alias(f"_in_{c}") for c in columns])
    labels = {f"{c}{suffix}": bucket(c, f"_in_{c}", buckets).cast("float") for c in columns}
    large = attach(hot, bounds, keys).withColumns(labels).drop(*[f"_in_{c}" for c in columns])
    return made.unionByName(large.select(*made.columns))


def held_out(n: int, share: float) -> int:
    """Rows of the later part of a chronological split."""
    return math.ceil(n * share)
