"""Repeated passages by compressed FM-indexes, one per shard of alike text.

1. Rows whose whole word sequence repeats an earlier document's are settled by a hash aggregate.
2. Every window of ``length`` words is represented by its least hashed run of ``ANCHOR`` words.
   Neighbouring windows with the same anchor form a segment. Equal windows have equal anchors, so
   only segments whose anchor occurs twice anywhere can hold a repeat; the rest is never moved.
3. Those segments are sharded by anchor: all occurrences of a window meet in one shard. Equal segments
   are one entry, that of their first occurrence, by an aggregate with map-side combine. An anchor
   with more than ``SHARD_WORDS`` words of entries is split: its windows are cut anew by their least hashed
   longer run, at last by all their words, so equal windows still meet and no anchor makes a large shard.
4. A shard's segments are indexed: suffix array, Burrows-Wheeler transform, a wavelet matrix of packed
   bits with counted blocks. The segments stream against it by backward search, which gives the
   matching statistics up to the threshold; where a match of ``length`` words has an occurrence
   before the segment's own, the interval is reported.
5. Intervals go back to the documents, and the covered words are cut out of the whole texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.text import BROADCAST_ROWS, constants, hot_limit, join_one, mix, steps, word_hashes, words_of
from tidepanel.sources.staging import stage

LENGTH = 20
ANCHOR = 8
#: Words of distinct segments in a shard, about, and of one anchor at most.
SHARD_WORDS = 300_000
#: What a missing doc_id is ordered as.
NO_ID = -(1 << 63)


# ---- segments ------------------------------------------------------------------------------------


def segments(hashed: np.ndarray, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, anchor hash) of each segment of a text given as word hashes."""
    windows = len(hashed) - length + 1
    if windows < 1:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64)
    factor = constants(anchor, 53)
    runs = np.zeros(len(hashed) - anchor + 1, np.uint64)
    for i in range(anchor):
        runs += hashed[i : i + len(runs)] * factor[i]
    runs = mix(runs)
    least, at = runs[:windows].copy(), np.zeros(windows, np.int64)
    for i in range(1, length - anchor + 1):
        other = runs[i : i + windows]
        less = other < least
        least[less], at[less] = other[less], i
    at += np.arange(windows)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return first, np.diff(np.append(first, windows)), least[first]


def sequence_keys(hashed: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes of each text's word sequence."""
    place = np.arange(len(hashed)) - np.repeat(starts[:-1], np.diff(starts))
    out = np.zeros((2, len(starts) - 1), np.uint64)
    full = np.flatnonzero(np.diff(starts))
    for k, seed in enumerate((61, 67)):
        seeded = mix(place.astype(np.uint64) * constants(1, seed)[0] + np.uint64(seed)) | np.uint64(1)
        if len(full):
            out[k, full] = np.add.reduceat(mix(hashed * seeded), starts[:-1][full])
    return out.view(np.int64)


def _powers(count: int, base: np.uint64) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(count, base, np.uint64)]), dtype=np.uint64)


def span_keys(hashed: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of words, the same wherever the span stands: polynomial prefix sums
    modulo 2 ** 64, shifted back by the inverse of the (odd) base."""
    base = constants(1, 59)[0]
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashed * _powers(len(hashed), base)[:-1], dtype=np.uint64)])
    keys = (sums[high] - sums[low]) * _powers(len(hashed), inverse)[low]
    return mix(keys + (high - low).astype(np.uint64)).view(np.int64)


def _anchored(batches: Iterator[pa.RecordBatch], length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        words, starts = words_of(batch.column("text"))
        hashed = word_hashes(words)
        keys = sequence_keys(hashed, starts)
        found = [segments(hashed[a:b], length, anchor)[2] for a, b in zip(starts[:-1], starts[1:], strict=True)]
        offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
        flat = np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("d"),
                pa.array(keys[0]),
                pa.array(keys[1]),
                pa.array(np.diff(starts).astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
            ],
            names=["d", "key_a", "key_b", "n_words", "anchors"],
        )


def _joined(words: pa.Array, low: np.ndarray, high: np.ndarray) -> pa.Array:
    """Runs of words, which may overlap, each joined by single spaces."""
    size = high - low
    offsets = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - low, size)
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words.take(pa.array(at)))
    return pc.binary_join(lists, " ")


def _cut_segments(batches: Iterator[pa.RecordBatch], length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    names = ["shard_key", "segment_key", "d", "key_a", "key_b", "start", "windows", "segment"]
    for batch in steps(batches):
        words, starts = words_of(batch.column("text"))
        hashed = word_hashes(words)
        keys = sequence_keys(hashed, starts)
        columns: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in names[:-1]]
        lows, highs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        told = batch.column("told").to_pylist()
        d = batch.column("d").to_numpy()
        for i, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)):
            mine = [t["anchors"] for t in told[i] if (t["key_a"], t["key_b"]) == (keys[0, i], keys[1, i])]
            if not mine:
                continue
            first, count, least = segments(hashed[a:b], length, anchor)
            hit = np.isin(least.view(np.int64), np.array(mine[0], np.int64))
            low, n = first[hit], count[hit]
            high = low + n + length - 1
            same = [np.full(len(low), x, np.int64) for x in (d[i], keys[0, i], keys[1, i])]
            found = (least[hit].view(np.int64), span_keys(hashed[a:b], low, high), *same, low, n)
            for column, values in zip(columns, found, strict=True):
                column.append(values)
            lows.append(a + low)
            highs.append(a + high)
        arrays = [pa.array(np.concatenate(c)) for c in columns]
        text = _joined(words, np.concatenate(lows), np.concatenate(highs))
        yield pa.RecordBatch.from_arrays([*arrays, text], names=names)


CUT = "shard_key long, segment_key long, d long, key_a long, key_b long, start long, windows long, segment string"


def _cut_anew(batches: Iterator[pa.RecordBatch], length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    """Segments cut by the least hashed run of ``anchor`` words of each window; the key extends the former one."""
    names = [c.split()[0] for c in CUT.split(", ")]
    for batch in steps(batches, text="segment"):
        words, starts = words_of(batch.column("segment"))
        hashed = word_hashes(words)
        found = [segments(hashed[a:b], length, anchor) for a, b in zip(starts[:-1], starts[1:], strict=True)]
        row = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
        first, count, least = (np.concatenate(x) for x in zip(*found, strict=True))
        former = batch.column("shard_key").to_numpy().view(np.uint64)[row]
        low = starts[:-1][row] + first
        high = low + count + length - 1
        columns = [mix(former * np.uint64(3) + least).view(np.int64), span_keys(hashed, low, high)]
        columns += [batch.column(c).to_numpy()[row] for c in ("d", "key_a", "key_b")]
        columns += [batch.column("start").to_numpy()[row] + first, count]
        yield pa.RecordBatch.from_arrays([*[pa.array(c) for c in columns], _joined(words, low, high)], names=names)


# ---- the index -----------------------------------------------------------------------------------


class WaveletMatrix:
    """Symbols as bit planes of 64-bit words with the ones counted before each word."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.planes, self.counts, self.zeros = [], [], []
        now = symbols
        for level in range(bits - 1, -1, -1):
            bit = ((now >> level) & 1).astype(np.uint8)
            packed = np.packbits(bit, bitorder="little")
            packed = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view(np.uint64)
            self.planes.append(packed)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed))[:-1]]).astype(np.int64))
            ones = np.flatnonzero(bit)
            self.zeros.append(len(bit) - len(ones))
            now = np.concatenate([now[np.flatnonzero(bit == 0)], now[ones]])
        self.bits = bits

    def descend(self, at: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Where a position lands below the last plane when it follows ``symbol``."""
        for k in range(self.bits):
            word = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[k][word] + np.bitwise_count(self.planes[k][word] & mask)
            at = np.where((symbol >> (self.bits - 1 - k)) & 1, self.zeros[k] + ones, at - ones)
        return at


class FMIndex:
    """Backward search over concatenated segments; symbol 0 ends each of them."""

    def __init__(self, text: np.ndarray):
        self.suffixes = self._sorted(text)
        before = text[self.suffixes - 1]
        size = int(text.max()) + 1
        self.bits = max(1, int(size - 1).bit_length())
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size))])
        self.wavelet = WaveletMatrix(before, self.bits)
        symbols = np.arange(size)
        self.base = self.wavelet.descend(np.zeros(size, np.int64), symbols)

    @staticmethod
    def _sorted(text: np.ndarray) -> np.ndarray:
        """Suffix array by doubling; each separator counts as a symbol of its own, so few rounds do."""
        ends = np.flatnonzero(text == 0)
        rank = text.astype(np.int64) + len(ends)
        rank[ends] = np.arange(len(ends))
        step = 1
        while True:
            key = rank * (int(rank.max()) + 2)
            key[:-step] += rank[step:] + 1
            order = np.argsort(key, kind="stable")
            new = np.empty(len(text), np.int64)
            new[order] = np.concatenate([[0], np.cumsum(key[order][1:] != key[order][:-1])])
            if new[order[-1]] == len(text) - 1:
                return order
            rank, step = new, 2 * step

    def extend(self, low: np.ndarray, high: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals after one more symbol in front."""
        shift = self.smaller[symbol] - self.base[symbol]
        return self.wavelet.descend(low, symbol) + shift, self.wavelet.descend(high, symbol) + shift


def repeated_windows(texts: list[np.ndarray], order: np.ndarray, length: int) -> list[np.ndarray]:
    """For each segment the windows of ``length`` words that occur earlier in the shard.

    ``order`` has a rank for every position of the segments with their separators: smaller is earlier.
    """
    joined = np.concatenate([np.append(t, 0) for t in texts])
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
    index = FMIndex(joined)
    windows = [np.arange(b, b + len(t) - length + 1) for b, t in zip(begin[:-1], texts, strict=True)]
    at = np.concatenate(windows)
    low, high = np.zeros(len(at), np.int64), np.full(len(at), len(joined), np.int64)
    alive = np.arange(len(at))
    for i in range(length - 1, -1, -1):
        low[alive], high[alive] = index.extend(low[alive], high[alive], joined[at[alive] + i])
        # A match that only the window itself has is not followed further.
        alive = alive[high[alive] - low[alive] > 1]
        if not len(alive):
            break
    covered = np.zeros(len(at), bool)
    if len(alive):
        spans, which = np.unique(np.stack([low[alive], high[alive]], axis=1), axis=0, return_inverse=True)
        ranked = np.append(order[index.suffixes], np.iinfo(np.int64).max)
        first = np.minimum.reduceat(ranked, spans.reshape(-1))[::2]
        covered[alive] = first[which.reshape(-1)] < order[at[alive]]
    cuts = np.cumsum([0, *map(len, windows)])
    return [np.flatnonzero(covered[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


SPANS = "d long, key_a long, key_b long, begin long, stop long"


def _spans(rows: list[tuple]) -> pa.Table:
    names = [x.split()[0] for x in SPANS.split(", ")]
    return pa.table({n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(names)})


def _search_shard(shard: pa.Table, length: int) -> pa.Table:
    words, starts = words_of(shard.column("segment"))
    coded = words.dictionary_encode().indices.to_numpy().astype(np.int64) + 1
    texts = [coded[a:b] for a, b in zip(starts[:-1], starts[1:], strict=True)]
    places = [shard.column(c).to_numpy() for c in ("d", "key_a", "key_b", "start")]
    size = np.diff(starts) + 1
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    at = [np.repeat(p, size) for p in places]
    at[3] = at[3] + inside
    order = np.empty(len(inside), np.int64)
    order[np.lexsort(at[::-1])] = np.arange(len(inside))
    rows = []
    for i, hits in enumerate(repeated_windows(texts, order, length)):
        if len(hits):
            edges = np.flatnonzero(np.diff(hits) > 1)
            for a, b in zip(hits[np.append(0, edges + 1)], hits[np.append(edges, len(hits) - 1)], strict=True):
                start = int(places[3][i])
                rows.append((int(places[0][i]), int(places[1][i]), int(places[2][i]), start + int(a), start + int(b) + length))
    return _spans(rows)


# ---- the job -------------------------------------------------------------------------------------


def _cut_marks(told: list | None, words: pa.Array) -> np.ndarray | None:
    """Which words of a text go, by the spans told for its word sequence; None if it has none."""
    if not told:
        return None
    keys = sequence_keys(word_hashes(words), np.array([0, len(words)]))
    cut = np.zeros(len(words) + 1, np.int64)
    for t in told:
        if (t["key_a"], t["key_b"]) == (keys[0, 0], keys[1, 0]):
            for span in t["spans"]:
                cut[min(span["begin"], len(words))] += 1
                cut[min(span["stop"], len(words))] -= 1
    return np.cumsum(cut)[:-1] > 0


def _digests(texts: pa.Array) -> pa.Array:
    """The sha256 of every text, from the bytes where they lie."""
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].tolist()
    data = memoryview(texts.buffers()[2] or b"")
    return pa.array([hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)], pa.string())


def _removed(batches: Iterator[pa.RecordBatch], texts: bool, keep: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        words, starts = words_of(batch.column("text"))
        gone = np.zeros(len(words), bool)
        for i in np.flatnonzero(batch.column("told").is_valid().to_numpy(zero_copy_only=False)):
            a, b = int(starts[i]), int(starts[i + 1])
            marks = _cut_marks(batch.column("told")[int(i)].as_py(), words.slice(a, b - a))
            if marks is not None:
                gone[a:b] = marks
        before = np.concatenate([[0], np.cumsum(gone)])[starts]
        lost = np.diff(before)
        offsets = pa.array((starts - before).astype(np.int32))
        left = words.filter(pa.array(~gone)) if lost.any() else words
        kept = pc.binary_join(pa.ListArray.from_arrays(offsets, left), " ")
        kept = pc.if_else(pa.array(lost == 0), batch.column("text"), kept) if texts else _digests(kept)
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in keep], pa.array(np.diff(starts).astype(np.int64)), pa.array(lost.astype(np.int64)), kept],
            names=[*keep, "n_words", "n_removed", "kept"],
        )


def entries(cut: DataFrame, length: int, anchor: int) -> tuple[DataFrame, DataFrame]:
    """The first of equal segments, with at most SHARD_WORDS words of a shard_key, and the spans of the others."""
    keys, by_segment = ["key_a", "key_b"], ["shard_key", "segment_key"]
    place = F.struct("d", *keys, "start")
    kept, repeats = [], []
    # The last run is the whole window: then equal windows are equal segments, and no entry is left to search.
    for longer in (*(anchor + (length - anchor) * k // 3 for k in (1, 2, 3)), None):
        first = F.min(F.struct("d", *keys, "start", "windows", "segment")).alias("first")
        entry = cut.groupBy(*by_segment).agg(first, F.count(F.lit(1)).alias("n"))
        counted = stage(entry.select(*by_segment, "first.*", "n"), "entries")
        entry = counted.drop("n")
        # A segment that occurs once has no others.
        firsts = counted.filter("n > 1").select(*by_segment, place.alias("first"), "n")
        again = join_one(cut, firsts, by_segment, hot_limit(cut.count())).filter(place != F.col("first"))
        stop = F.col("start") + F.col("windows") + length - 1
        repeats.append(again.select("d", *keys, F.col("start").alias("begin"), stop.alias("stop")))
        if longer is None:
            break
        # At most one key for each SHARD_WORDS words.
        heavy = entry.groupBy("shard_key").agg(F.sum(F.col("windows") + length).alias("n"))
        heavy = stage(heavy.filter(F.col("n") > SHARD_WORDS).select("shard_key"), "heavy")
        if heavy.isEmpty():
            kept.append(entry)
            break
        if heavy.count() <= BROADCAST_ROWS:
            heavy = F.broadcast(heavy)
        kept.append(entry.join(heavy, "shard_key", "left_anti"))
        cut = entry.join(heavy, "shard_key").select(*cut.columns)
        cut = stage(cut.mapInArrow(lambda it, longer=longer: _cut_anew(it, length, longer), CUT), "segments")
    return reduce(DataFrame.union, [k.select(*cut.columns) for k in kept]), reduce(DataFrame.union, repeats)


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """(d, told) for each doc_id with something to remove; told has the word spans by text key."""
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("d"), "text")
    schema = "d long, key_a long, key_b long, n_words long, anchors array<long>"
    known = stage(rows.mapInArrow(lambda it: _anchored(it, length, anchor), schema), "anchors").filter(F.col("n_words") >= length)
    keys = ["key_a", "key_b"]
    counted = stage(known.groupBy(*keys).agg(F.min("d").alias("first"), F.count(F.lit(1)).alias("n")), "firsts")
    firsts = counted.drop("n")
    plain = join_one(known.select("d", *keys, "n_words"), counted.filter("n > 1"), keys, hot_limit(known.count()))
    copies = plain.filter("d <> first").select("d", *keys, F.lit(0).cast("long").alias("begin"), F.col("n_words").alias("stop"))

    single = known.join(firsts.withColumnRenamed("first", "d"), ["d", *keys], "left_semi").dropDuplicates(["d", *keys])
    exploded = single.select("d", *keys, F.explode("anchors").alias("anchor"))
    often = stage(exploded.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1"), "often")
    # What very many texts share is looked up where those are.
    hits = join_one(exploded, often, "anchor", hot_limit(often.agg(F.sum("n")).first()[0] or 0))
    hits = hits.groupBy("d", *keys).agg(F.collect_set("anchor").alias("anchors"))
    wanted = hits.groupBy("d").agg(F.collect_list(F.struct(*keys, "anchors")).alias("told"))
    wanted = stage(wanted, "wanted")
    cut = rows.join(wanted, "d").select("d", "text", "told").mapInArrow(
        lambda it: _cut_segments(it, length, anchor),
        CUT,
    )
    entry, again = entries(stage(cut, "segments"), length, anchor)
    total = entry.agg(F.sum(F.col("windows") + length)).first()[0] or 0
    shards = int(total // SHARD_WORDS) + 1
    sharded = entry.select("d", *keys, "start", "segment", F.pmod(F.xxhash64("shard_key"), F.lit(shards)).alias("shard"))
    inner = sharded.groupBy("shard").applyInArrow(lambda t: _search_shard(t.select(["d", *keys, "start", "segment"]), length), SPANS)
    spans = copies.union(again).union(inner)
    spans = spans.groupBy("d", *keys).agg(F.collect_set(F.struct("begin", "stop")).alias("spans"))
    return stage(spans.groupBy("d").agg(F.collect_list(F.struct(*keys, "spans")).alias("told")), "spans")


def _applied(docs: DataFrame, keep: tuple[str, ...], texts: bool, length: int) -> DataFrame:
    told = repeated_spans(docs.select("doc_id", "text"), length)
    rows = docs.select(*keep, "text", F.coalesce("doc_id", F.lit(NO_ID)).alias("d"))
    joined = rows.join(told, "d", "left").select(*keep, "text", "told")
    kinds = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes)
    schema = f"{kinds}, n_words long, n_removed long, kept string"
    return joined.mapInArrow(lambda it: _removed(it, texts, keep), schema)


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 of what is left, joined by one space.

    A word goes if a window of ``length`` words that covers it starts earlier too, in a document of
    smaller doc_id or earlier in its own. Windows are judged on the input. Null, empty and short
    texts lose nothing. Rows that agree in doc_id and text are one document; rows that agree
    in doc_id only are ordered by a hash of the text. A missing doc_id comes before all others. Other
    columns are ignored; an empty table gives no rows.
    """
    out = _applied(docs, ("doc_id",), False, length)
    return out.withColumnRenamed("kept", "kept_sha256")


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with the repeated words cut from text; a row that loses nothing keeps its text as it is."""
    rest = [c for c in docs.columns if c != "text"]
    out = _applied(docs.select("doc_id", "text", F.struct(*rest).alias("row")), ("row",), True, length)
    return out.select(*[F.col("kept" if c == "text" else f"row.`{c}`").alias(c) for c in docs.columns])
