"""Token ids in a wavelet matrix per shard: one compressed file part with access, count and occurrence lookup.

Texts are range-partitioned by doc_id, so a partition holds consecutive ids; within it a shard is closed
once it holds ``SHARD_IDS`` ids. A shard is one row of a Parquet table: its documents and their
lengths, its alphabet, and a blob: one bit plane per bit of the shard-local symbol, packed, with the ones
counted before every block of ``BLOCK`` bits, each plane deflated if that is smaller. Spark's own writer
commits the table, so a task that is run again leaves no second copy.

Blob: magic ``WVM1``; u8 planes; u32 ids; u32 symbols; the symbols as u32; per plane u32 zeros, u8 packing
(0 raw, 1 zstandard), u32 size of the packed bits, the bits (first bit lowest), then the block counts as u32.
"""

from __future__ import annotations

import os
import struct
import sys
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidepanel.llm.text import BROADCAST_ROWS, LOOKUP_BYTES, steps, words_of
from tidepanel.sources.staging import staging_path

SHARD_IDS = 1 << 22
BLOCK = 512
END = 2
#: Words whose ids a task remembers at most.
REMEMBERED = 600_000
#: Words that are encoded together.
JOINED = 256
MAGIC = b"WVM2"


# ---- the structure -------------------------------------------------------------------------------


def write_blob(ids: np.ndarray) -> bytes:
    """A sequence of ids as a wavelet matrix."""
    symbols = np.flatnonzero(np.bincount(ids)) if len(ids) else np.zeros(0, np.int64)
    place = np.zeros(int(symbols[-1]) + 1 if len(symbols) else 1, np.uint32)
    place[symbols] = np.arange(len(symbols))
    planes = max(1, int(len(symbols) - 1).bit_length()) if len(symbols) else 1
    now = place[ids].astype(np.uint16 if planes <= 16 else np.uint32)
    squeeze = zstandard.ZstdCompressor(level=1)
    out = [MAGIC, struct.pack("<BII", planes, len(ids), len(symbols)), symbols.astype("<u4").tobytes()]
    for level in range(planes - 1, -1, -1):
        bit = (now & (1 << level)).astype(bool)
        packed = np.packbits(bit, bitorder="little")
        packed = np.concatenate([packed, np.zeros(-len(packed) % (BLOCK // 8), np.uint8)])
        per_block = np.bitwise_count(packed).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.int64)
        raw = packed.tobytes()
        small = squeeze.compress(raw)
        packing, body = (1, small) if len(small) < 0.95 * len(raw) else (0, raw)
        zeros = np.compress(~bit, now)
        out += [struct.pack("<IBI", len(zeros), packing, len(body)), body]
        out.append(np.concatenate([[0], np.cumsum(per_block)]).astype("<u4").tobytes())
        now = np.concatenate([zeros, np.compress(bit, now)])
    return b"".join(out)


class WaveletMatrix:
    """A blob opened for reading."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a wavelet matrix")
        self.planes, self.size, count = struct.unpack_from("<BII", blob, 4)
        at = 13
        self.symbols = np.frombuffer(blob, "<u4", count, at)
        at += 4 * count
        self.bits, self.counts, self.zeros = [], [], []
        opened = zstandard.ZstdDecompressor()
        blocks = -(-(-(-self.size // 8)) // (BLOCK // 8))
        for _ in range(self.planes):
            zeros, packing, length = struct.unpack_from("<IBI", blob, at)
            at += 9
            body = blob[at : at + length]
            at += length
            self.zeros.append(zeros)
            self.bits.append(np.frombuffer(opened.decompress(body) if packing else body, np.uint8))
            self.counts.append(np.frombuffer(blob, "<u4", blocks + 1, at))
            at += 4 * (blocks + 1)

    def _ones(self, plane: int, at: int) -> int:
        """Ones before a position of a plane: the block's count and the bits since."""
        block = at // BLOCK
        low, high = block * BLOCK // 8, at // 8
        ones = int(self.counts[plane][block]) + int(np.bitwise_count(self.bits[plane][low:high]).sum())
        if at % 8:
            ones += (int(self.bits[plane][high]) & ((1 << at % 8) - 1)).bit_count()
        return ones

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.size:
            raise IndexError(at)
        symbol = 0
        for k in range(self.planes):
            bit = int(self.bits[k][at >> 3]) >> (at & 7) & 1
            ones = self._ones(k, at)
            at = self.zeros[k] + ones if bit else at - ones
            symbol = symbol << 1 | bit
        return int(self.symbols[symbol])

    def _symbol(self, token: int) -> int | None:
        k = int(np.searchsorted(self.symbols, token))
        return k if k < len(self.symbols) and self.symbols[k] == token else None

    def count(self, token: int, low: int = 0, high: int | None = None) -> int:
        """How often an id occurs in positions low up to high."""
        symbol, high = self._symbol(token), self.size if high is None else high
        if symbol is None:
            return 0
        for k in range(self.planes):
            a, b = self._ones(k, low), self._ones(k, high)
            bit = symbol >> (self.planes - 1 - k) & 1
            low, high = (self.zeros[k] + a, self.zeros[k] + b) if bit else (low - a, high - b)
        return high - low

    def select(self, token: int, which: int) -> int:
        """The position of the occurrence number ``which`` (from 0) of an id."""
        if not 0 <= which < self.count(token):
            raise IndexError(which)
        symbol = self._symbol(token)
        low, path = 0, []
        for k in range(self.planes):
            bit = symbol >> (self.planes - 1 - k) & 1
            low = self.zeros[k] + self._ones(k, low) if bit else low - self._ones(k, low)
            path.append(bit)
        at = low + which
        for k in range(self.planes - 1, -1, -1):
            wanted = at - self.zeros[k] if path[k] else at
            a, b = 0, self.size
            while a < b:  # the last position with so many equal bits before it
                mid = (a + b) // 2
                before = self._ones(k, mid + 1)
                if (before if path[k] else mid + 1 - before) <= wanted:
                    a = mid + 1
                else:
                    b = mid
            at = a
        return at

    def all(self) -> np.ndarray:
        """Every id, by undoing the planes from the last to the first."""
        symbol = np.zeros(self.size, np.uint16 if self.planes <= 16 else np.uint32)
        for k in range(self.planes - 1, -1, -1):
            bit = np.unpackbits(self.bits[k], count=self.size, bitorder="little").view(bool)
            new = np.empty_like(symbol)
            if self.zeros[k]:
                np.place(new, ~bit, symbol[: self.zeros[k]])
            if self.zeros[k] < self.size:
                np.place(new, bit, symbol[self.zeros[k] :] | symbol.dtype.type(1 << (self.planes - 1 - k)))
            symbol = new
        return self.symbols[symbol]


# ---- encoding ------------------------------------------------------------------------------------


class Encoder:
    """Ids of texts, word by word.

    The tokenizer drops white space and never joins across it, nor a letter or digit with an ASCII mark
    after it but an apostrophe, so texts are cut there and each different word is encoded once. It judges letters
    after normalizing; no cut is made behind one that its normalizer does not turn into one letter or
    digit. Texts that may spell a special token are encoded as they are.
    """

    def __init__(self, path: str, cuts: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tool = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.cuts = cuts or self._cuts()
        mark = getattr(self.tool.model, "end_of_word_suffix", None)
        vocabulary = self.tool.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        if mark:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True

    def _cuts(self) -> str:
        """A pattern of a letter or digit that stays one, and the ASCII mark after it, apostrophes aside."""
        every = pa.array([chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000])
        letters = every.filter(pc.match_substring_regex(every, r"[\p{L}\p{N}]"))
        # All at once, apart from each other.
        normal = " ".join(letters.to_pylist())
        normal = self.tool.normalizer.normalize_str(normal) if self.tool.normalizer else normal
        stays = pc.match_substring_regex(pa.array(normal.split(" ")), r"^[\p{L}\p{N}]$")
        changed = "".join(rf"\x{{{ord(c):x}}}" for c in letters.filter(pc.invert(stays)).to_pylist())
        return rf"([^\P{{L}}{changed}]|[^\P{{N}}{changed}])([!-&(-/:-@\[-`{{-~])"

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tool.encode_batch_fast(texts, add_special_tokens=False)]

    def words(self, words: list[str]) -> dict[str, bytes]:
        """The ids of words. Words of letters alone go many at a time, as an id that ends a word closes each."""
        plain = [w for w in words if w.isalpha() and (w.isascii() or (is_normalized("NFC", w) and w.lower().isalpha()))]
        joined = self.ids([" ".join(plain[i : i + JOINED]) for i in range(0, len(plain), JOINED)])
        flat = np.fromiter(chain.from_iterable(joined), np.uint32)
        stops = np.flatnonzero(self.ends[flat]) + 1
        if len(stops) != len(plain):  # a tokenizer that does not mark them
            stops, plain = [], []
        data, stops = flat.tobytes(), [0, *(4 * np.asarray(stops, np.int64)).tolist()]
        made = {w: data[a:b] for w, a, b in zip(plain, stops[:-1], stops[1:], strict=True)}
        rest = [w for w in words if w not in made]
        return made | {w: np.array(x, np.uint32).tobytes() for w, x in zip(rest, self.ids(rest), strict=True)}

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        texts = pc.fill_null(texts, "")
        special = np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False))
        cut = pc.replace_substring_regex(texts, self.cuts, r"\1 \2")
        words, starts = words_of(pc.ascii_lower(cut))
        coded = words.dictionary_encode()
        different = coded.dictionary.to_pylist()
        known = self.known
        new = [w for w in different if w not in known]
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = different
        known.update(self.words(new))
        parts = [known[w] for w in different]
        length = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        lists = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], np.cumsum(length)]), pa.int32()), pa.array(np.frombuffer(b"".join(parts), np.uint32))
        )
        ids = lists.take(coded.indices).flatten().to_numpy()
        before = np.concatenate([[0], np.cumsum(length[coded.indices.to_numpy()])])
        count = before[starts[1:]] - before[starts[:-1]]
        if len(special):
            rows = np.split(ids, np.cumsum(count)[:-1])
            for k, own in zip(special, self.ids([texts[int(i)].as_py() for i in special]), strict=True):
                rows[k], count[k] = np.array(own, np.uint32), len(own)
            ids = np.concatenate([*rows, np.zeros(0, np.uint32)])
        return ids, count


@lru_cache(maxsize=2)
def encoder(path: str, cuts: str | None = None) -> Encoder:
    return Encoder(path, cuts)


SHARDS = "part int, seq int, first_id long, n_ids long, doc_ids array<long>, lengths array<long>, blob binary"


def _shards(batches: Iterator[pa.RecordBatch], path: str, cuts: str, end: int, shard_ids: int) -> Iterator[pa.RecordBatch]:
    tool, part = encoder(path, cuts), TaskContext.get().partitionId()
    seq, held = 0, []

    def close() -> pa.RecordBatch:
        docs = pa.concat_arrays([d for d, _, _ in held])
        lengths = np.concatenate([n for _, n, _ in held])
        ids = np.concatenate([x for _, _, x in held])
        row = [[part], [seq], [docs[0].as_py()], [len(ids)], [docs], [pa.array(lengths)], [write_blob(ids)]]
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        cells = [
            pa.ListArray.from_arrays(pa.array([0, len(x[0])], pa.int32()), x[0]) if pa.types.is_list(k) else pa.array(x, k)
            for x, k in zip(row, kinds, strict=True)
        ]
        return pa.RecordBatch.from_arrays(cells, names=["part", "seq", "first_id", "n_ids", "doc_ids", "lengths", "blob"])

    for batch in steps(batches, LOOKUP_BYTES):
        ids, count = tool.encode(batch.column("text"))
        ids = np.insert(ids, np.cumsum(count), end)
        held.append((batch.column("doc_id"), count + 1, ids))
        if sum(len(x) for _, _, x in held) >= shard_ids:
            yield close()
            seq, held = seq + 1, []
    if held:
        yield close()


def write_shards(docs: DataFrame, path: str, to: str, end: int = END, shard_ids: int = SHARD_IDS) -> None:
    """Encode ``docs`` (doc_id, text) and write the shards to the folder ``to`` in ascending doc_id order.

    A missing doc_id comes first, rows of one id in the order of their texts; null texts are empty.
    """
    rows = docs.select("doc_id", "text")
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    # Judged once for all tasks.
    cuts = encoder(path).cuts
    rows.mapInArrow(lambda it: _shards(it, path, cuts, end, shard_ids), SHARDS).write.mode("overwrite").parquet(to)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
    for batch in batches:
        for i in range(batch.num_rows):
            ids = WaveletMatrix(batch.column("blob")[i].as_py()).all().astype("<u4")
            lengths = batch.column("lengths")[i].values.to_numpy()
            stops = np.cumsum(lengths)
            start = batch.column("before")[i].as_py() + stops - lengths
            crc = [zlib.crc32(ids[a:b]) for a, b in zip((stops - lengths).tolist(), stops.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_ids")[i].values, pa.array(start), pa.array(lengths), pa.array(crc, pa.int64())], names=names
            )


def read_documents(spark: SparkSession, at: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the shards alone.

    start counts the ids of all documents before. It is summed over the partitions' totals, one row each,
    and within a partition over its shards.
    """
    table = spark.read.parquet(at)
    sizes = table.select("part", "seq", "first_id", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("total"))
    before = F.sum("total").over(Window.orderBy("part")) - F.col("total")
    parts = parts.select("part", before.alias("part_before"))
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("seq")) - F.col("n_ids")
    placed = sizes.withColumn("within", within).join(parts, "part")
    placed = placed.select("part", "seq", (F.col("part_before") + F.col("within")).alias("before"))
    # One row a shard: broadcast while they are few, so that the blobs stay where they are.
    few = table.select("part").limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = table.select("part", "seq", "doc_ids", "lengths", "blob")
    rows = rows.join(F.broadcast(placed) if few else placed, ["part", "seq"])
    return rows.select("doc_ids", "lengths", "blob", "before").mapInArrow(
        _read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def encode_and_read(docs: DataFrame, path: str, end: int = END, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the shards to the staging folder and read the documents back from them.

    Empty tables give no rows; further columns are ignored; repeated rows are documents of their own.
    """
    at = staging_path(docs.sparkSession, "wavelet")
    write_shards(docs, path, at, end, shard_ids)
    return read_documents(docs.sparkSession, at)
