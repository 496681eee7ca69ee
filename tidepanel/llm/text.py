"""Words of whole texts in Arrow batches, 64-bit hashes of them, and seeded constants."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Text that one step of a batch works on, in bytes; a longer text is a step of its own. Hashing
#: takes some forty bytes for each byte of text; steps that only look words up can be larger.
STEP_BYTES, LOOKUP_BYTES = 1 << 20, 4 << 20
#: Longest word whose bytes get a factor each; the bytes of a longer one share them in turns.
FACTORS = 1 << 12

_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


def constants(count: int, seed: int) -> np.ndarray:
    """Odd 64-bit constants from a seed, the same on every machine."""
    step = np.uint64(0x9E3779B97F4A7C15)
    return mix(np.arange(1, count + 1, dtype=np.uint64) * step + np.uint64(seed)) | np.uint64(1)


def whole(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def give_back() -> None:
    """Return freed memory to the machine: workers are kept between stages, beside a full Java heap."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform.startswith("linux") else None
    if trim:
        trim(0)


def steps(batches: Iterator[pa.RecordBatch], size: int = STEP_BYTES, text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut by rows so that a piece has about ``size`` bytes of text or is one row."""
    for batch in batches:
        length = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(length, dtype=np.int64) // size
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1), len(length)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)
    batch = None
    give_back()


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of all texts in a row, and where each text's begin. Null: none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(whole(texts), ""))
    flat = lists.flatten()
    starts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    if full.all():
        return flat, starts
    before = np.concatenate([[0], np.cumsum(full)])
    return flat.filter(pa.array(full)), before[starts]


def word_hashes(words: pa.Array, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of each (non-empty) word: its bytes times seeded factors, summed and mixed."""
    if not len(words):
        return np.zeros(0, np.uint64)
    off = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[off[0] : off[-1]]
    begin = (off[:-1] - off[0]).astype(np.int64)
    size = np.diff(off)
    place = np.arange(len(data)) - np.repeat(begin, size)
    if size.max() > FACTORS:
        place += place // FACTORS
    factor = constants(FACTORS, seed)[place % FACTORS]
    return mix(np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * factor, begin) + size.astype(np.uint64))


def held_out(doc_id: str, of: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves that remainder; a missing id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % of == remainder, F.lit(False))


#: Rows that go to a Python worker at a time; with the default of ten thousand whole texts a batch and
#: its copies would take a good part of an executor.
BATCH_ROWS = "1000"


def documents(spark, sf_dir: str) -> DataFrame:
    """The documents of a folder, in a session that hands whole texts over in small batches."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Rows of integer keys that may be broadcast, 16 MB.
BROADCAST_ROWS = 1 << 20


def keep_rows(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """The rows whose key is among ``keys`` (a staged table of one integer column, without repeats).

    The keys are counted: up to BROADCAST_ROWS they are broadcast and ``rows`` stay where they are;
    beyond that both sides are shuffled.
    """
    few = keys.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return rows.join(F.broadcast(keys) if few else keys, on, "left_semi")


#: Rows of one key that a task may meet in a join, and keys (a row of integers each) that are broadcast because
#: they have more.
HOT_ROWS, HOT_KEYS = 2000, 1 << 20


def hot_limit(rows: int) -> int:
    """Rows beyond which a key is hot: so many that at most HOT_KEYS keys of a table of ``rows`` rows are."""
    return max(HOT_ROWS, rows // HOT_KEYS)


def join_one(rows: DataFrame, table: DataFrame, on: str | list[str], limit: int) -> DataFrame:
    """Inner join with a table of one row a key, whose column ``n`` counts the key's ``rows``.

    Hot keys, see ``hot_limit``, are looked up by broadcast where their rows are, so that none of them
    brings all its rows to one task; the others are shuffled.
    """
    on = [on] if isinstance(on, str) else on
    hot = F.broadcast(table.filter(F.col("n") > limit))
    found = rows.join(hot, on).drop("n")
    rest = rows.join(hot.select(*on), on, "left_anti")
    return found.union(rest.join(table.filter(F.col("n") <= limit), on).select(*found.columns))
