"""Hard negatives by a vertical scan of vectors stored by dimension.

Vectors are packed into blocks that hold one array a dimension, with every dimension's least and greatest
value. An anchor reads the dimensions of a block in the order of its own magnitudes, greatest first, a few
at a time. After each step the least and the most that the unread dimensions can still add bound every
candidate's score; candidates whose bounds miss the anchor's window, or stay below the k-th score that is
already proven, leave its bitmap, and the next dimensions are read for the others only. What remains when
all dimensions are read has exact scores. One scan finds each anchor's best rows of its own label, a second
one the best rows of other labels in the windows that these set.

Anchors are a stated share of the rows. They are packed into bundles of at most BUNDLE; a pass broadcasts
PASS bundles, whose size is thereby bounded, to all blocks of vectors. A task keeps the best k of each
anchor over its blocks, so it hands on that many rows an anchor, however many it read.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.sources.staging import stage

#: Vectors a block, anchors a bundle, bundles that one pass broadcasts.
BLOCK, BUNDLE, PASS = 4096, 256, 32
#: Pairs of a vector and an anchor that one task judges, about.
TASK_PAIRS = 1 << 27
#: Dimensions that are read between two looks at the bounds.
STEP = 8
POSITIVES, NEGATIVES = 5, 10
#: The window of a negative's score, in percent of the positive's.
LOW, HIGH = 30, 90
#: Vectors whose greatest entry times the root of the width is beyond this are refused: below it every
#: score is a whole number that a double holds.
LARGEST = 1 << 26
#: Blocks go to the Python workers so many at a time.
BATCH_ROWS = "4"

PACKED = "block long, rows int, width int, ids binary, labels binary, entries binary"
BUNDLED = f"bundle long, owner binary, place binary, lows binary, highs binary, {PACKED.replace('block long, ', '')}"


def whole_entries(scale: int = 256, vector: str = "embedding") -> Column:
    """Every entry as floor(scale * x); null if the vector or an entry is missing or not finite."""
    bad = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    made = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("double"))
    return F.when(F.coalesce(~bad, F.lit(False)), made)


def _pack(rows: list[pa.RecordBatch], number: int) -> dict:
    width = max((int(np.diff(b.column("entries").offsets.to_numpy()).max(initial=0)) for b in rows), default=0)
    parts = []
    for b in rows:
        lists = b.column("entries")
        at = lists.offsets.to_numpy()
        flat = lists.values.to_numpy(zero_copy_only=False)
        made = np.zeros((b.num_rows, width))
        size = np.diff(at)
        made[np.repeat(np.arange(b.num_rows), size), np.arange(at[0], at[-1]) - np.repeat(at[:-1], size)] = flat[at[0] : at[-1]]
        parts.append(made)
    entries = np.concatenate(parts).T
    if np.abs(entries).max(initial=0) * width**0.5 > LARGEST:
        raise ValueError("entries of this size would not give exact scores")
    ids, labels = (np.concatenate([b.column(c).to_numpy(zero_copy_only=False) for b in rows]).astype(np.int64) for c in ("vec_id", "label"))
    return {
        "block": number,
        "rows": entries.shape[1],
        "width": width,
        "ids": ids.tobytes(),
        "labels": labels.tobytes(),
        # Dimension by dimension.
        "entries": entries.astype(np.int32).tobytes(),
    }


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"block": pa.int64(), "bundle": pa.int64(), "rows": pa.int32(), "width": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kinds.get(c, pa.binary())) for c in rows[0]], names=list(rows[0]))


def _groups(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[list[pa.RecordBatch]]:
    held, count = [], 0
    for batch in batches:
        while batch.num_rows:
            own = batch.slice(0, size - count)
            held.append(own)
            count, batch = count + own.num_rows, batch.slice(own.num_rows)
            if count == size:
                yield held
                held, count = [], 0
    if held:
        yield held


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Inside, rows that hold whole blocks go to the workers a few at a time."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def pack(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """(vec_id, label, entries) packed into staged blocks by dimension; vectors that are shorter end in zeros."""
    rows = vectors.select("vec_id", "label", "entries")
    packed = rows.mapInArrow(lambda it: (_batch([_pack(g, 0)]) for g in _groups(it, block)), PACKED)
    # The number of a block only has to be its own; it is fixed once the table is written.
    return stage(packed.withColumn("block", F.monotonically_increasing_id()), "vector-blocks")


class Vertical:
    """A block as read back: ids, labels, one array a dimension, and the bounds of every dimension."""

    def __init__(self, rows: int, width: int, ids: bytes, labels: bytes, entries: bytes) -> None:
        self.rows, self.width = rows, width
        self.ids, self.labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        self.entries = np.frombuffer(entries, np.int32).reshape(width, rows).astype(np.float64)
        self.least = self.entries.min(axis=1, initial=np.inf) if rows else np.zeros(width)
        self.most = self.entries.max(axis=1, initial=-np.inf) if rows else np.zeros(width)

    def scan(self, anchor: np.ndarray, alive: np.ndarray, lows: np.ndarray, highs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the bitmap whose score can matter, and their exact scores.

        A row matters if its score is in one of the windows [low, high] and not below the k-th score that
        others are proven to have in that window.
        """
        width = min(self.width, len(anchor))
        order = np.argsort(-np.abs(anchor[:width]), kind="stable")
        order = order[: np.count_nonzero(anchor[:width])]
        a = anchor[order]
        one, two = a * self.least[order], a * self.most[order]
        # What the dimensions from each place on can add at least and at most.
        rest_low = np.append(np.cumsum(np.minimum(one, two)[::-1])[::-1], 0.0)
        rest_high = np.append(np.cumsum(np.maximum(one, two)[::-1])[::-1], 0.0)
        places = np.flatnonzero(alive)
        score = np.zeros(len(places))
        floor = lows.astype(np.float64)
        for begin in range(0, len(order), STEP):
            dims = order[begin : begin + STEP]
            # While all rows are there the arrays are read as they lie.
            part = self.entries[dims] if len(places) == self.rows else self.entries[dims[:, None], places]
            score = score + a[begin : begin + STEP] @ part
            end = begin + len(dims)
            least, most = score + rest_low[end], score + rest_high[end]
            keep = np.zeros(len(places), bool)
            for w in range(len(lows)):
                inside = (least >= lows[w]) & (most <= highs[w])
                if np.count_nonzero(inside) >= k:
                    sure = least[inside]
                    floor[w] = max(floor[w], np.partition(sure, len(sure) - k)[len(sure) - k])
                keep |= (most >= floor[w]) & (least <= highs[w])
            if not keep.all():
                places, score = places[keep], score[keep]
            if not len(places):
                break
        return places, score.astype(np.int64)


class Best:
    """The first k of each (anchor, window) of a bundle over the blocks seen so far."""

    def __init__(self, anchors: int, windows: int, k: int) -> None:
        self.k = k
        self.held = [[(np.zeros(0, np.int64), np.zeros(0, np.int64))] * windows for _ in range(anchors)]

    def floor(self, anchor: int, window: int, low: int) -> int:
        score, _ = self.held[anchor][window]
        return max(low, int(score[-1])) if len(score) == self.k else low

    def add(self, anchor: int, window: int, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(score):
            return
        old, old_ids = self.held[anchor][window]
        score, ids = np.concatenate([old, score]), np.concatenate([old_ids, ids])
        if len(score) > self.k:
            # Ties with the k-th stay until the ids decide.
            keep = score >= np.partition(score, len(score) - self.k)[len(score) - self.k]
            score, ids = score[keep], ids[keep]
        first = np.lexsort((ids, -score))[: self.k]
        self.held[anchor][window] = (score[first], ids[first])


ANY = (np.array([-(1 << 62)]), np.array([1 << 62]))


def _scan(batches: Iterator[pa.RecordBatch], same: bool, k: int) -> Iterator[pa.RecordBatch]:
    """Judge (block, bundle) rows; at the end the best of every anchor and window."""
    best: dict[int, Best] = {}
    anchors: dict[int, tuple] = {}
    last, block = None, None
    for batch in batches:
        for r in batch.to_pylist():
            if r["block"] != last:
                last = r["block"]
                block = Vertical(*(r[c] for c in ("rows", "width", "ids", "labels", "entries")))
            if r["bundle"] not in anchors:
                many = Vertical(*(r["a_" + c] for c in ("rows", "width", "ids", "labels", "entries")))
                owner, place, lows, highs = (np.frombuffer(r[c], np.int64) for c in ("owner", "place", "lows", "highs"))
                windows = len(lows) // max(many.rows, 1)
                anchors[r["bundle"]] = many, owner, place, lows.reshape(many.rows, windows), highs.reshape(many.rows, windows)
                best[r["bundle"]] = Best(many.rows, windows, k)
            many, owner, place, lows, highs = anchors[r["bundle"]]
            found = best[r["bundle"]]
            for i in range(many.rows):
                alive = (block.labels == many.labels[i]) == same
                if owner[i] == last:
                    alive[place[i]] = False
                floors = np.array([found.floor(i, w, int(low)) for w, low in enumerate(lows[i])])
                # Windows that hold nothing need no scan.
                if not np.any(floors <= highs[i]):
                    continue
                rows, score = block.scan(many.entries[:, i], alive, floors, highs[i], k)
                for w in range(lows.shape[1]):
                    own = (score >= floors[w]) & (score <= highs[i, w])
                    found.add(i, w, score[own], block.ids[rows[own]])
    for bundle, found in best.items():
        many, owner, place, _, _ = anchors[bundle]
        columns = [[], [], [], [], [], []]
        for i, windows in enumerate(found.held):
            for w, (score, ids) in enumerate(windows):
                for c, x in zip(columns, (*([x] * len(ids) for x in (owner[i], place[i], many.ids[i], w)), ids, score), strict=True):
                    c.extend(x)
        arrays = [pa.array(np.array(c, np.int64)) for c in columns]
        yield pa.RecordBatch.from_arrays(arrays, names=["owner", "place", "anchor_id", "window", "vec_id", "score"])


FOUND = "owner long, place long, anchor_id long, window long, vec_id long, score long"


def _bundles(blocks: DataFrame, wanted: DataFrame | None, every: int, bundle: int) -> DataFrame:
    """The anchors among the vectors, packed; with the windows of ``wanted`` (owner, place, lows, highs)."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                block = Vertical(*(r[c] for c in ("rows", "width", "ids", "labels", "entries")))
                own = np.flatnonzero(block.ids % every == 0)
                cells = [np.full(len(own), r["block"]), own, block.ids[own], block.labels[own]]
                entries = block.entries[:, own].T.ravel().astype(np.int32)
                offsets = pa.array(np.arange(len(own) + 1, dtype=np.int32) * block.width)
                lists = pa.ListArray.from_arrays(offsets, pa.array(entries))
                yield pa.RecordBatch.from_arrays([*map(pa.array, cells), lists], names=["owner", "place", "vec_id", "label", "entries"])

    def bind(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, bundle):
            made = _pack(group, 0)
            made = {"bundle": 0} | {
                c: np.concatenate([(b.column(c).flatten() if c in ("lows", "highs") else b.column(c)).to_numpy() for b in group]).tobytes()
                for c in ("owner", "place", "lows", "highs")
            } | {k: v for k, v in made.items() if k != "block"}
            yield _batch([made])

    with small_batches(blocks.sparkSession):
        rows = blocks.mapInArrow(pick, "owner long, place long, vec_id long, label long, entries array<int>")
        rows = stage(rows, "anchor-vectors")
    if wanted is None:
        rows = rows.withColumns({"lows": F.array(F.lit(int(ANY[0][0]))), "highs": F.array(F.lit(int(ANY[1][0])))})
    else:
        rows = rows.join(wanted, ["owner", "place"])
    # About a bundle a task; the anchors are counted first.
    rows = stage(rows, "anchors")
    few = max(1, ceil(1.25 * rows.count() / bundle))
    bound = rows.repartition(few, "owner", "place").mapInArrow(bind, BUNDLED)
    return stage(bound.withColumn("bundle", F.monotonically_increasing_id()), "anchor-bundles")


def _best(blocks: DataFrame, bundles: DataFrame, same: bool, k: int, bundle: int) -> DataFrame:
    """The first k rows of every anchor and window: same label or other labels."""
    spark = blocks.sparkSession
    numbers = [r["bundle"] for r in bundles.select("bundle").orderBy("bundle").collect()]
    size = blocks.agg(F.sum("rows").alias("n"), F.count(F.lit(1)).alias("b")).first()
    few = min(len(numbers), PASS) * bundle
    tasks = min(size["b"] or 1, max(spark.sparkContext.defaultParallelism, ceil((size["n"] or 0) * few / TASK_PAIRS)))
    dealt = blocks.repartition(max(tasks, 1), "block").withColumn("pass", F.lit(0))
    named = bundles.select("bundle", "owner", "place", "lows", "highs", *(F.col(c).alias(f"a_{c}") for c in ("rows", "width", "ids", "labels", "entries")))
    parts = []
    for a in range(0, len(numbers), PASS):
        own = named.filter(F.col("bundle").between(numbers[a], numbers[min(a + PASS, len(numbers)) - 1])).withColumn("pass", F.lit(0))
        pairs = dealt.join(F.broadcast(own), "pass").drop("pass")
        with small_batches(spark):
            parts.append(stage(pairs.mapInArrow(lambda it: _scan(it, same, k), FOUND), "vector-matches"))
    if not parts:
        return spark.createDataFrame([], f"{FOUND}, rank int")
    rank = F.row_number().over(Window.partitionBy("owner", "place", "window").orderBy(F.desc("score"), "vec_id"))
    return reduce(DataFrame.unionByName, parts).withColumn("rank", rank).filter(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    every: int = 100,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    block: int = BLOCK,
    bundle: int = BUNDLE,
) -> DataFrame:
    """Hard negatives of the rows of ``vectors`` (vec_id, label, entries) whose vec_id ``every`` divides.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score. An anchor's positives
    are its first other rows of its label, a positive's negatives the first rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score; first is by score, then by
    vec_id. Rows with a missing vec_id, label or entries take no part. Every row counts by itself: a
    repeated vec_id is another row, a repeated anchor has results of its own, and rows that tie in score
    and vec_id are alike. Shorter vectors end in zeros. Other columns are ignored, an empty table gives none.
    """
    rows = vectors.select(*(F.col(c) for c in ("vec_id", "label", "entries"))).dropna()
    rows = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("entries").cast("array<double>"))
    blocks = pack(rows, block)
    first = stage(_best(blocks, _bundles(blocks, None, every, bundle), True, positives, bundle), "positives")
    # ceil(low * score / 100) and floor(high * score / 100), in whole numbers.
    least, most = _hundredths(-low) * -1, _hundredths(high)
    windows = first.groupBy("owner", "place").agg(
        F.array_sort(F.collect_list(F.struct("rank", least.alias("low"), most.alias("high")))).alias("w")
    )
    # Every anchor has as many windows; those that it has no positive for are empty.
    none = F.struct(F.lit(0).alias("rank"), F.lit(1).cast("long").alias("low"), F.lit(0).cast("long").alias("high"))
    slots = F.slice(F.concat("w", F.array_repeat(none, positives)), 1, positives)
    windows = windows.select("owner", "place", slots.alias("slots"))
    wanted = windows.select("owner", "place", F.col("slots.low").alias("lows"), F.col("slots.high").alias("highs"))
    second = _best(blocks, _bundles(blocks, wanted, every, bundle), False, negatives, bundle)
    keys = ["owner", "place", "window"]
    named = (F.col("anchor_id"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    found = first.select("owner", "place", (F.col("rank") - 1).alias("window"), *named)
    second = second.select(*keys, F.col("rank").cast("int"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return found.join(second, keys).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _hundredths(percent: int) -> Column:
    """floor(percent * score / 100)."""
    return F.expr(f"({percent} * score - pmod({percent} * score, 100L)) div 100L")


def shifted_labels(every: int = 7, labels: int = 10) -> Column:
    """The label, moved on by one where vec_id is divisible by ``every``."""
    return F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
