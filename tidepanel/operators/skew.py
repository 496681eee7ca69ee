"""Ordered and joined work that holds up when one key owns a large share of the rows.

Every operator first counts rows per key with a map-side aggregate. Keys of at most
``hot_rows`` rows take the ordinary plan, one shuffle on the key. Larger keys are cut
into ordered chunks, so no task ever sees a whole hot key.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tidepanel.sources.staging import stage

HOT_ROWS_KEY = "spark.tidepanel.hotRows"
HOT_ROWS_DEFAULT = 1_000_000
BROADCAST_BYTES_KEY = "spark.tidepanel.broadcastBytes"
BROADCAST_BYTES_DEFAULT = 128 * 1024 * 1024


def hot_rows(spark: SparkSession) -> int:
    """Largest number of rows of one key that is left to a single task."""
    return int(spark.conf.get(HOT_ROWS_KEY, str(HOT_ROWS_DEFAULT)))


@dataclass(frozen=True)
class HotKeys:
    """Keys above the limit with their row counts ``_n`` (None if there are none), and all rows."""

    keys: DataFrame | None
    rows: int


def find_hot(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> HotKeys:
    """Keys with more than ``limit`` rows, from one map-side aggregate over the key columns.

    There are at most total / limit of them. They are staged, so a join with them is a
    broadcast only when their file is below the session's threshold.
    """
    limit = limit or hot_rows(df.sparkSession)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    found = sizes.agg(F.count(F.lit(1)).alias("k"), F.sum("_n").alias("n")).first()
    if not found["k"]:
        return HotKeys(None, 0)
    return HotKeys(stage(sizes, "hot-keys"), found["n"])


def split_hot(
    df: DataFrame, keys: Sequence[str], hot: HotKeys
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of ordinary keys and rows of hot keys; the latter None without hot keys.

    Only in the hot case is ``df`` staged, so that its two readers do not compute it twice.
    """
    if hot.keys is None:
        return df, None
    df = stage(df, "skewed")
    if not keys:
        return df.filter(F.lit(False)), df
    named = hot.keys.select(*keys)
    return df.join(named, list(keys), "left_anti"), df.join(named, list(keys), "left_semi")


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    weight: str | None = None,
    out: str = "_before",
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add ``out``: the sum of ``weight`` (1 per row by default) over earlier rows of the key.

    ``order`` must be unique within a key. Hot keys are range-partitioned by
    (keys, order); each chunk is summed on its own and shifted by the chunks before it.
    """
    keys, order = list(keys), list(order)
    limit = hot_rows(df.sparkSession)
    amount = F.col(weight) if weight else F.lit(1).cast("bigint")
    hot = hot or find_hot(df, keys)
    ordinary, large = split_hot(df, keys, hot)

    def earlier(partition: list[str], by: list[str]) -> WindowSpec:
        spec = Window.partitionBy(*partition).orderBy(*by)
        return spec.rowsBetween(Window.unboundedPreceding, -1)

    zero = F.lit(0).cast("bigint")
    result = ordinary.withColumn(out, F.coalesce(F.sum(amount).over(earlier(keys, order)), zero))
    if large is None:
        return result
    parts = max(2, math.ceil(hot.rows / limit))
    chunks = stage(
        large.repartitionByRange(parts, *keys, *order).withColumn("_chunk", F.spark_partition_id()),
        "chunks",
    )
    sums = chunks.groupBy(*keys, "_chunk").agg(F.sum(amount).alias("_sum"))
    shift = stage(
        sums.select(
            *keys,
            "_chunk",
            F.coalesce(F.sum("_sum").over(earlier(keys, ["_chunk"])), zero).alias("_shift"),
        ),
        "chunk-shifts",
    )
    inside = F.coalesce(F.sum(amount).over(earlier([*keys, "_chunk"], order)), zero)
    placed = (
        chunks.withColumn(out, inside)
        .join(shift, [*keys, "_chunk"])
        .withColumn(out, F.col(out) + F.col("_shift"))
    )
    return result.unionByName(placed.select(*result.columns))


def salted_join(df: DataFrame, table: DataFrame, on: Sequence[str], hot: HotKeys) -> DataFrame:
    """Left join; the rows of every hot key are spread over as many salts as its size asks for.

    The matching rows of ``table`` are repeated once per salt.
    """
    on = list(on)
    if hot.keys is None:
        return df.join(table, on, "left")
    limit = hot_rows(df.sparkSession)
    heavy = hot.keys.select(*on, F.ceil(F.col("_n") / F.lit(limit)).cast("int").alias("_salts"))
    # The salt is the row's place in a written table: a task run again places it alike, and equal
    # rows get different salts.
    df = stage(df, "salted").withColumn("_place", F.monotonically_increasing_id())
    spread = F.pmod(F.xxhash64("_place"), F.col("_salts"))
    left = df.join(heavy, on, "left").withColumn(
        "_salt", F.coalesce(spread, F.lit(0)).cast("int")
    )
    right = table.join(heavy, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    )
    return left.drop("_salts").join(right.drop("_salts"), [*on, "_salt"], "left").drop("_salt", "_place")


def attach(df: DataFrame, stats: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left join per-key statistics back to rows."""
    return attach_all(df, [(stats, on)])


def attach_all(
    df: DataFrame, tables: Sequence[tuple[DataFrame, Sequence[str]]]
) -> DataFrame:
    """Left join several independent per-key tables back to rows.

    Where Catalyst's bound is already below the broadcast threshold, because the input of a
    table is, it is joined as it is. The others are aggregated map-side and staged, all at
    once, and their counted size decides: a table that fits is broadcast and the rows of
    ``df`` are not shuffled; for one that does not the rows of hot keys are salted.
    """
    ready = stage_where([(t, not small_by_plan(t)) for t, _ in tables])
    for (table, staged), (_, on) in zip(ready, tables):
        if not staged:
            df = df.join(table, list(on), "left")
        elif fits_broadcast(table):
            df = df.join(F.broadcast(table), list(on), "left")
        else:
            df = salted_join(df, table, on, find_hot(df, on))
    return df


def stage_where(tables: Sequence[tuple[DataFrame, bool]]) -> list[tuple[DataFrame, bool]]:
    """Stage the marked tables as concurrent jobs and leave the others."""
    marked = [t for t, wanted in tables if wanted]
    if len(marked) > 1:
        with ThreadPoolExecutor(len(marked)) as pool:
            done = iter(list(pool.map(lambda t: stage(t, "stats"), marked)))
    else:
        done = iter([stage(t, "stats") for t in marked])
    return [(next(done), True) if wanted else (t, False) for t, wanted in tables]


def small_by_plan(df: DataFrame) -> bool:
    """Whether Catalyst's size bound of ``df`` is below the session's broadcast threshold."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return _planned_bytes(df) <= limit


def _planned_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """Largest size in bytes of what is broadcast."""
    return int(spark.conf.get(BROADCAST_BYTES_KEY, str(BROADCAST_BYTES_DEFAULT)))


def fits_broadcast(staged: DataFrame) -> bool:
    """Whether a staged table is small enough to broadcast: by its files, and by its rows and array entries."""
    limit = broadcast_limit(staged.sparkSession)
    if _planned_bytes(staged) > limit:
        return False
    # The default size of an array is that of one entry; the others are counted.
    arrays = [f for f in staged.schema if isinstance(f.dataType, ArrayType)]
    entries = [F.sum(_entries(F.col(f.name), f.dataType)).alias(f.name) for f in arrays]
    counted = staged.agg(F.count(F.lit(1)).alias("_rows"), *entries).first()
    size = counted["_rows"] * int(staged._jdf.schema().defaultSize())
    return size + sum(8 * (counted[f.name] or 0) for f in arrays) <= limit


def _entries(column: Column, kind: ArrayType) -> Column:
    """Entries of an array, those of arrays inside it counted one by one."""
    if isinstance(kind.elementType, ArrayType):
        inner = F.transform(column, lambda x: _entries(x, kind.elementType))
        return F.aggregate(F.coalesce(inner, F.array(F.lit(0))), F.lit(0), lambda a, x: a + F.greatest(x, F.lit(0)))
    return F.greatest(F.size(column), F.lit(0))


def over_series(
    df: DataFrame,
    key: str,
    order: str,
    halo: int,
    build: Callable[[DataFrame, list[str]], DataFrame],
    hot: HotKeys | None = None,
) -> DataFrame:
    """Run ``build(frame, partition_keys)`` per entity, where a row needs ``halo`` earlier rows.

    Entities of ordinary length are one partition each. Longer ones are cut into blocks of
    consecutive rows; each block also gets copies of the last ``halo`` rows before it, which
    are dropped afterwards. ``build`` sees the block number in ``_block``. Steps over the
    same entities can share one ``hot`` instead of counting again.
    """
    hot = hot or find_hot(df, [key])
    ordinary, large = split_hot(df, [key], hot)
    result = build(ordinary, [key])
    if large is None:
        return result
    size = max(hot_rows(df.sparkSession), halo)
    at = F.col("_before")
    block = F.floor(at / size)
    tail = at % size >= size - halo
    places = F.array_compact(
        F.array(
            F.struct(block.alias("_block"), F.lit(True).alias("_own")),
            F.when(
                tail, F.struct((block + 1).alias("_block"), F.lit(False).alias("_own"))
            ),
        )
    )
    blocks = (
        running_total(large, [key], [order], hot=hot)
        .withColumn("_place", F.explode(places))
        .select(*df.columns, "_place._block", "_place._own")
    )
    built = build(blocks, [key, "_block"]).filter("_own")
    return stage(result.unionByName(built.select(*result.columns)), "series")
