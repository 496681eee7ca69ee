"""Removing linear exposure of scores to factors.

Only sums cross the network: means and covariances per group, k x k for k factors. The normal
equations are solved in tasks. Up to WIDE columns everything is built-in expressions; beyond that
tasks multiply matrices: each keeps one matrix per group it meets, matrices of a group are merged in
trees of bounded fan-in, and residuals are one matrix product per Arrow batch with the coefficients.
Rows with a null score or factor take no part in the fit and get a null result.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.functions.columns import by_prefix
from tidepanel.operators.skew import attach, broadcast_limit, hot_rows
from tidepanel.sources.staging import stage

# Above this many columns the products are summed with matrix products in Arrow batches.
WIDE = 16
#: Bytes of matrices that a task holds before it hands them on, and matrices of a group that one merge reads.
HELD_BYTES, FAN = 512 << 20, 64


def standardize(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Mean 0 and population std 1 per column; a constant column becomes 0."""
    stats = df.groupBy(*keys).agg(
        *[F.avg(c).alias(f"_avg_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"_std_{c}") for c in columns],
    )
    joined = attach(df, stats, keys) if keys else df.crossJoin(F.broadcast(stats))  # one row
    scaled = {
        c: (F.col(c) - F.col(f"_avg_{c}"))
        / F.when(F.col(f"_std_{c}") == 0, 1.0).otherwise(F.col(f"_std_{c}"))
        for c in columns
    }
    return joined.withColumns(scaled).select(*df.columns)


def gram(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per group: ``_n``, ``_mean`` (array) and ``_gram`` (centered products, row-major).

    The products are centered sums of squares, so ``_gram / _n`` is the population covariance.
    """
    columns, keys = list(columns), list(keys)
    if len(columns) <= WIDE:
        return _narrow_gram(df.dropna("any", subset=columns), columns, keys)

    def finish(n: int, mean: np.ndarray, products: np.ndarray) -> dict:
        return {"_n": n, "_mean": mean.tolist(), "_gram": products.ravel().tolist()}

    return _wide(df, columns, keys, finish, "_n long, _mean array<double>, _gram array<double>")


def _narrow_gram(df: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    n = len(columns)
    upper = {
        (i, j): F.covar_pop(columns[i], columns[j]) for i in range(n) for j in range(i, n)
    }
    sums = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.array(*[F.avg(c) for c in columns]).alias("_mean"),
        *[c.alias(f"_c{i}_{j}") for (i, j), c in upper.items()],
    )
    square = [F.col(f"_c{min(i, j)}_{max(i, j)}") * F.col("_n") for i in range(n) for j in range(n)]
    return sums.select(*keys, "_n", "_mean", F.array(*square).alias("_gram"))


class Moments:
    """Row count, means and centered products of some rows; merging two is exact however far apart they lie."""

    def __init__(self, n: int, mean: np.ndarray, products: np.ndarray) -> None:
        self.n, self.mean, self.products = n, mean, products

    @classmethod
    def of(cls, rows: np.ndarray) -> Moments:
        mean = rows.mean(axis=0)
        apart = rows - mean
        return cls(len(rows), mean, apart.T @ apart)

    def add(self, other: Moments) -> None:
        n = self.n + other.n
        apart = other.mean - self.mean
        self.products += other.products
        self.products += np.outer(apart, apart * (self.n * other.n / n))
        self.mean = self.mean + apart * (other.n / n)
        self.n = n


#: A matrix on its way: the bytes of means and products.
PARTIAL = "_n long, _mean binary, _products binary"


def _record(key: Sequence, schema: pa.Schema, m: Moments) -> pa.RecordBatch:
    values = [*key, m.n, m.mean.tobytes(), m.products.tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)


def _partial_schema(batch: pa.RecordBatch, names: Sequence[str]) -> pa.Schema:
    own = [pa.field(n, batch.schema.field(n).type) for n in names]
    return pa.schema([*own, ("_n", pa.int64()), ("_mean", pa.binary()), ("_products", pa.binary())])


def _packed(columns: Sequence[str]) -> Column:
    """The columns as one array of doubles, which Arrow hands to Python as rows of a matrix.

    Hundreds of columns of their own cost several times as much: each value is written to another place,
    and gathered again from there. The lambda keeps the array out of whole-stage code, which would be one
    method too long for the JIT.
    """
    first, *others = (F.col(c).cast("double") for c in columns)
    return F.array(F.transform(F.array(first), lambda x: x)[0], *others)


def _matrix(batch: pa.RecordBatch, k: int) -> np.ndarray:
    """The rows of ``_row``, missing values NaN."""
    return batch.column("_row").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, k)


def _one_thread() -> None:
    """Keep this worker's matrix products on one thread: Spark allows every task all cores of its executor.

    Numpy's wheels bring the library along; any other keeps its own setting.
    """
    for path in (Path(np.__file__).parent.parent / "numpy.libs").glob("*openblas*"):
        library = ctypes.CDLL(str(path))
        for name in ("scipy_openblas_set_num_threads64_", "scipy_openblas_set_num_threads", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(ctypes.c_int(1))


def _task_moments(
    batches: Iterator[pa.RecordBatch], names: list[str], k: int, limit: int
) -> Iterator[pa.RecordBatch]:
    """One matrix per group of the task's complete rows; all are handed on whenever they fill ``limit`` bytes."""
    _one_thread()
    held: dict[tuple, Moments] = {}
    schema = None
    for batch in batches:
        schema = schema or _partial_schema(batch, names)
        rows = _matrix(batch, k)
        whole = np.isfinite(rows).all(axis=1)
        groups = [((), np.flatnonzero(whole))]
        if names:
            keys = pa.Table.from_batches([batch.select(names)]).append_column("_at", pa.array(np.arange(batch.num_rows)))
            lists = keys.filter(pa.array(whole)).group_by(names).aggregate([("_at", "list")])
            made = zip(*(lists.column(n).to_pylist() for n in names), strict=True)
            groups = [(key, np.array(at)) for key, at in zip(made, lists.column("_at_list").to_pylist(), strict=True)]
        for key, at in groups:
            if not len(at):
                continue
            if key not in held and (len(held) + 1) * 8 * k**2 > limit:
                for known, m in held.items():
                    yield _record(known, schema, m)
                held = {}
            new = Moments.of(rows if len(at) == len(rows) else rows[at])
            if key in held:
                held[key].add(new)
            else:
                held[key] = new
    for key, m in held.items():
        yield _record(key, schema, m)


def _merged(batches: Iterator[pa.RecordBatch], names: list[str], k: int) -> Iterator[tuple[tuple, pa.Schema, Moments]]:
    """Neighbouring matrices of one group added up, one group at a time."""
    last, total, schema = None, None, None
    for batch in batches:
        schema = schema or _partial_schema(batch, names)
        for i in range(batch.num_rows):
            key = tuple(batch.column(n)[i].as_py() for n in names)
            mean = np.frombuffer(batch.column("_mean")[i].as_py(), float)
            m = Moments(batch.column("_n")[i].as_py(), mean, np.frombuffer(batch.column("_products")[i].as_py(), float).reshape(k, k).copy())
            if total is not None and key == last:
                total.add(m)
                continue
            if total is not None:
                yield last, schema, total
            last, total = key, m
    if total is not None:
        yield last, schema, total


def _wide(
    df: DataFrame, columns: list[str], keys: list[str], finish: Callable[[int, np.ndarray, np.ndarray], dict], fields: str
) -> DataFrame:
    """``finish(n, mean, products)`` of the complete rows of every group, with its keys.

    Rows stay where they are and each task sends a matrix per group it met, unless most of these would
    be larger than the rows they stand for: then the rows are dealt by group first, large groups to many
    tasks.
    """
    k, names = len(columns), [f"_key_{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(c).alias(n) for c, n in zip(keys, names, strict=True)], *columns)
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.select(*names).schema)
    kinds = f"{kinds}, " if names else ""
    if names:
        met = rows.groupBy(*names, F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"))
        counted = met.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("parts")).first()
        if (counted["rows"] or 0) < k * counted["parts"]:
            rows = stage(rows, "wide-rows")
            sizes = rows.groupBy(*names).agg(F.ceil(F.count(F.lit(1)) / F.lit(hot_rows(df.sparkSession))).alias("_salts"))
            # Rows are dealt by their place in the written table, so equal ones spread too.
            placed = attach(rows.withColumn("_place", F.monotonically_increasing_id()), sizes, names)
            salt = F.pmod(F.xxhash64("_place"), F.coalesce("_salts", F.lit(1)))
            rows = placed.withColumn("_salt", salt).repartition(*names, "_salt").select(*names, *columns)
    packed = rows.select(*names, _packed(columns).alias("_row"))
    parts = packed.mapInArrow(lambda it: _task_moments(it, names, k, HELD_BYTES), kinds + PARTIAL)
    parts = stage(parts, "matrices")

    def added(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, schema, m in _merged(it, names, k):
            yield _record(key, schema, m)

    def most(table: DataFrame) -> int:
        return table.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0

    found = most(parts)
    while found > FAN:
        salted = parts.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(-(-found // FAN))))
        dealt = salted.repartition(*names, "_salt").sortWithinPartitions(*names, "_salt").drop("_salt")
        parts = stage(dealt.mapInArrow(added, kinds + PARTIAL), "matrices")
        found = most(parts)

    def finished(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, schema, m in _merged(it, names, k):
            made = finish(m.n, m.mean, m.products)
            own = [pa.array([v], schema.field(n).type) for v, n in zip(key, names, strict=True)]
            yield pa.RecordBatch.from_arrays([*own, *(pa.array([v]) for v in made.values())], names=[*names, *made])

    dealt = parts.repartition(*names).sortWithinPartitions(*names) if names else parts.coalesce(1)
    made = dealt.mapInArrow(finished, kinds + fields)
    return made.select(*[F.col(n).alias(c) for c, n in zip(keys, names, strict=True)], *made.columns[len(names) :])


def _solve(
    products: Sequence[float], k: int, scores: int, means: Sequence[float], n: int
) -> np.ndarray:
    """Coefficients (k x scores) on standardized factors, from centered products.

    A factor is constant when its spread is rounding noise next to its own mean, whatever the
    other factors' scales. Directions below 1e-13 of the largest correlation eigenvalue are left
    out: two factors may differ by 1e-6 of their spread and still count as two.
    """
    m = np.asarray(products, float).reshape(k + scores, k + scores)
    spread = np.sqrt(np.clip(np.diag(m)[:k], 0, None))
    noise = 1e-13 * np.sqrt(max(n, 1)) * np.abs(np.asarray(means, float)[:k])
    spread[spread <= noise] = np.inf
    scaled = m[:k, :k] / np.outer(spread, spread)
    right = m[:k, k:] / spread[:, None]
    return (np.linalg.pinv(scaled, rcond=1e-13, hermitian=True) @ right) / spread[:, None]


def exposures(
    df: DataFrame, scores: Sequence[str], factors: Sequence[str], keys: Sequence[str] = ()
) -> DataFrame:
    """One row per group: ``_mean`` of the factors then the scores, and ``_beta`` per score."""
    k, s = len(factors), len(scores)
    columns = [*factors, *scores]
    if len(columns) > WIDE:

        def finish(n: int, mean: np.ndarray, products: np.ndarray) -> dict:
            return {"_mean": mean.tolist(), "_beta": [b.tolist() for b in _solve(products, k, s, mean, n).T]}

        return _wide(df, columns, list(keys), finish, "_mean array<double>, _beta array<array<double>>")
    sums = gram(df, columns, keys)

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            cells = zip(frame["_gram"], frame["_mean"], frame["_n"], strict=True)
            betas = [[list(b) for b in _solve(g, k, s, m, n).T] for g, m, n in cells]
            yield frame.drop(columns=["_gram", "_n"]).assign(_beta=betas)

    fields = [f for f in sums.schema.fields if f.name not in ("_gram", "_n")]
    beta = T.StructField("_beta", T.ArrayType(T.ArrayType(T.DoubleType())))
    return sums.mapInPandas(solve, T.StructType([*fields, beta]))


def _explained(factors: Sequence[str], score: int) -> Column:
    """Fitted part of a score from centered factors."""
    terms = [
        (F.col(c) - F.col("_mean")[i]) * F.col("_beta")[score][i] for i, c in enumerate(factors)
    ]
    return sum(terms[1:], terms[0])


def _less_fitted(
    df: DataFrame, scores: list[str], factors: list[str], proportion: float, keys: list[str], constant: bool, keep: list[str]
) -> DataFrame:
    """``df`` with ``proportion`` of the fit on the factors, and with ``constant`` of the mean, taken off the scores.

    Of the columns only those of ``keep`` are returned.
    """
    k, s = len(factors), len(scores)
    fit = exposures(df, scores, factors, keys)
    if k <= WIDE:
        joined = attach(df, fit, keys) if keys else df.crossJoin(F.broadcast(stage(fit, "exposures")))  # one row
        changed = {
            c: F.col(c) - proportion * (_explained(factors, i) + (F.col("_mean")[k + i] if constant else 0.0))
            for i, c in enumerate(scores)
        }
        return joined.withColumns(changed).select(*keep)

    def unpack(mean: Sequence[float], beta: Sequence[Sequence[float]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.array(mean[:k]), np.array(beta), np.array(mean[k:]) if constant else np.zeros(s)

    # Factors and scores travel as one array; of the other columns, those that are kept or group the rows.
    packed = df.select(*dict.fromkeys(c for c in [*keep, *keys] if c not in scores or c in keys), _packed([*factors, *scores]).alias("_row"))
    kinds = {f.name: f.dataType for f in df.schema}
    schema = T.StructType([T.StructField(c, T.DoubleType() if c in scores else kinds[c]) for c in keep])

    def replaced(batch: pa.RecordBatch, rows: np.ndarray, fitted: np.ndarray) -> pa.RecordBatch:
        left = rows[:, k:] - proportion * fitted
        made = {c: pa.array(left[:, i], from_pandas=True) for i, c in enumerate(scores)}
        return pa.RecordBatch.from_arrays([made[c] if c in made else batch.column(c) for c in keep], names=keep)

    fit = stage(fit, "exposures")
    # One group's coefficients are a row; those of many groups go along only if they are counted as small.
    size = 8 * (k + s) * (1 + s)
    if not keys or fit.count() * size <= broadcast_limit(df.sparkSession):
        rows = fit.toArrow().to_pylist()
        told = {tuple(r[c] for c in keys): unpack(r["_mean"], r["_beta"]) for r in rows if all(r[c] is not None for c in keys)}
        shared = df.sparkSession.sparkContext.broadcast(told)

        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = _matrix(batch, k + s)
                fitted = np.full((batch.num_rows, s), np.nan)
                groups = [((), np.arange(batch.num_rows))]
                if keys:
                    table = pa.Table.from_arrays([*(batch.column(c) for c in keys), pa.array(np.arange(batch.num_rows))], names=[*keys, "_at"])
                    lists = table.group_by(keys).aggregate([("_at", "list")])
                    made = zip(*(lists.column(c).to_pylist() for c in keys), strict=True)
                    groups = [(key, np.array(at)) for key, at in zip(made, lists.column("_at_list").to_pylist(), strict=True)]
                for key, at in groups:
                    if key in shared.value:
                        centers, cells, mean = shared.value[key]
                        part = rows if len(at) == batch.num_rows else rows[at]
                        fitted[at] = (part[:, :k] - centers) @ cells.T + mean
                yield replaced(batch, rows, fitted)

        return packed.mapInArrow(apply, schema)

    def apply_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _matrix(batch, k + s)
            fitted = np.full((batch.num_rows, s), np.nan)
            means, betas = batch.column("_mean").to_pylist(), batch.column("_beta").to_pylist()
            for i in range(batch.num_rows):
                if means[i] is not None:
                    centers, cells, mean = unpack(means[i], betas[i])
                    fitted[i] = (rows[i, :k] - centers) @ cells.T + mean
            yield replaced(batch, rows, fitted)

    return attach(packed, fit, keys).mapInArrow(apply_joined, schema)


def neutralize_full(
    df: DataFrame,
    score: str = "prediction",
    by: Sequence[str] | None = None,
    proportion: float = 1.0,
    keys: Sequence[str] = (),
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Residual of ``score`` on the factors and a constant, divided by its sample std.

    ``by`` defaults to every column whose name starts with ``feature``. With ``keys`` each
    group is treated on its own; rows with a missing key get a null. ``keep`` names the columns to
    return, all by default: what many factors are not needed for later need not travel with the result.
    """
    keep = list(df.columns if keep is None else keep)
    factors = list(by) if by is not None else by_prefix(df.columns, "feature")
    keys = list(keys)
    if factors:
        left = _less_fitted(df, [score], factors, proportion, keys, True, list(dict.fromkeys([*keep, *keys, score])))
    else:
        center = df.groupBy(*keys).agg(F.avg(score).alias("_center"))
        joined = attach(df, center, keys) if keys else df.crossJoin(F.broadcast(center))
        left = joined.withColumn(score, F.col(score) - proportion * F.col("_center")).select(*df.columns)
    if len(factors) > WIDE:
        # The spread is read from what the matrix products have written, without doing them again.
        left = stage(left, "residuals")
    spread = left.groupBy(*keys).agg(F.stddev_samp(score).alias("_spread"))
    scaled = attach(left, spread, keys) if keys else left.crossJoin(F.broadcast(spread))
    return scaled.withColumn(
        score, F.try_divide(F.col(score), F.col("_spread"))
    ).select(*keep)


def neutralize_partial(
    df: DataFrame,
    scores: Sequence[str],
    by: Sequence[str],
    proportion: float = 1.0,
    keys: Sequence[str] = (),
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Scores minus ``proportion`` of their fit on standardized factors, without an intercept.

    Factors absent from ``df`` are left out; without any factor the scores stay as they are.
    """
    factors = [c for c in by if c in df.columns]
    keep = list(df.columns if keep is None else keep)
    if proportion == 0.0 or not factors:
        return df.select(*keep)
    return _less_fitted(df, list(scores), factors, proportion, list(keys), False, keep)
