"""User functions on grouped series."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from tidepanel.operators.skew import HOT_ROWS_KEY, attach, find_hot, over_series, split_hot


def transform_series(
    df: DataFrame,
    key: str,
    order: str,
    value: str,
    function: Callable[[pd.Series], pd.Series],
    out: str,
    halo: int | None,
) -> DataFrame:
    """Add ``function(series)`` per entity: a series of equal length.

    ``halo`` is how many earlier rows a result may depend on; entities too long for one task
    reach the function in blocks that start that many rows early. With None a result may depend on
    all earlier rows: entities are never cut, and one too long for a task is refused.
    """

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by(order)
        made = function(table.column(value).to_pandas().reset_index(drop=True))
        return table.append_column(out, pa.array(made.astype(float), from_pandas=True))

    def build(frame: DataFrame, part: list[str]) -> DataFrame:
        schema = T.StructType([*frame.schema.fields, T.StructField(out, T.DoubleType())])
        return frame.groupBy(*part).applyInArrow(add, schema)

    if halo is None:
        if split_hot(df, [key], find_hot(df, [key]))[1] is not None:
            raise ValueError(f"a {key} has more than {HOT_ROWS_KEY} rows; give a halo or raise that limit")
        return build(df, [key])
    return over_series(df, key, order, halo, build)


def broadcast_aggregate(
    df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column]
) -> DataFrame:
    """Add aggregates of the group to each of its rows."""
    stats = df.groupBy(*keys).agg(*[c.alias(name) for name, c in aggregates.items()])
    return attach(df, stats, keys)


#: Groups whose states a task holds before it hands them on.
HELD_STATES = 100_000


def _groups(batch: pa.RecordBatch, names: Sequence[str]) -> Iterator[tuple[tuple, np.ndarray]]:
    """The keys of a batch and the places of their rows."""
    rows = pa.Table.from_arrays([*(batch.column(c) for c in names), pa.array(np.arange(batch.num_rows))], names=[*names, "_at"])
    lists = rows.group_by(list(names)).aggregate([("_at", "list")])
    keys = zip(*(lists.column(c).to_pylist() for c in names), strict=True)
    return zip(keys, map(np.array, lists.column("_at_list").to_pylist()), strict=True)


def merged_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    schema: str,
    start: Callable[[], Any],
    update: Callable[[Any, dict[str, np.ndarray]], Any],
    merge: Callable[[Any, Any], Any],
    finish: Callable[[Any], Sequence],
) -> DataFrame:
    """A user's aggregate per group in two phases, so that a hot group is many small states.

    ``update(state, columns)`` takes some rows of a group as arrays, without regard to order; ``merge`` joins
    two states, which must be picklable; ``finish`` gives the values of ``schema``. Every task sends one state
    per group it met, and these meet by group. Missing numbers are NaN. Rows with missing keys are groups of
    their own.
    """
    keys, columns = list(keys), list(columns)
    names = [f"_key_{i}" for i in range(len(keys))]
    rows = df.select(*[df[c].alias(n) for c, n in zip(keys, names, strict=True)], *columns)
    key_fields = rows.select(*names).schema.fields

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, Any] = {}
        kinds: list[pa.DataType] = []

        def told() -> pa.RecordBatch:
            made = [pa.array([k[i] for k in held], kind) for i, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays([*made, pa.array([pickle.dumps(s) for s in held.values()], pa.binary())], names=[*names, "_state"])

        for batch in batches:
            kinds = [batch.schema.field(n).type for n in names]
            values = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in columns}
            for key, at in _groups(batch, names):
                held[key] = update(held[key] if key in held else start(), {c: v[at] for c, v in values.items()})
            if len(held) >= HELD_STATES:
                yield told()
                held.clear()
        if held:
            yield told()

    states = rows.mapInArrow(first, T.StructType([*key_fields, T.StructField("_state", T.BinaryType())]))
    out = T._parse_datatype_string(schema)

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sorted by group: one total at a time.
        last, total, kinds = None, None, []

        def told() -> pa.RecordBatch:
            made = [pa.array([v], kind) for v, kind in zip(last, kinds, strict=True)]
            return pa.RecordBatch.from_arrays([*made, *(pa.array([v]) for v in finish(total))], names=[*names, *out.names])

        for batch in batches:
            kinds = [batch.schema.field(n).type for n in names]
            for i in range(batch.num_rows):
                key = tuple(batch.column(n)[i].as_py() for n in names)
                state = pickle.loads(batch.column("_state")[i].as_py())
                if last is None or key != last:
                    if last is not None:
                        yield told()
                    last, total = key, state
                else:
                    total = merge(total, state)
        if last is not None:
            yield told()

    dealt = states.repartition(*names).sortWithinPartitions(*names)
    made = dealt.mapInArrow(second, T.StructType([*key_fields, *out.fields]))
    return made.toDF(*keys, *out.names)


def map_rows(df: DataFrame, schema: str, function: Callable[[pd.DataFrame], Mapping[str, Any]], columns: Sequence[str]) -> DataFrame:
    """Add the columns of ``schema`` that a user's function makes of some columns, batch by batch.

    For what built-in expressions cannot say; the function sees pandas columns and must treat every row alone.
    """
    out = T._parse_datatype_string(schema)
    columns = list(columns)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(**function(frame[columns]))

    return df.mapInPandas(run, T.StructType([*df.schema.fields, *out.fields]))
