"""Brown class-based bigram language model, learned and applied by blocks of documents.

1. Documents are packed into blocks: the block's different words, how often each occurs in training
   documents, and the texts as indexes into them. Blocks are written once.
2. The different words of all blocks are dealt to buckets by a hash. A bucket sums their counts, not
   tokens, and gives each word of ``MIN_COUNT`` tokens or more a place, the others their form.
3. Every word of ``MIN_COUNT`` tokens or more is put into one of ``CLASSES`` classes by exchange clustering.
   The blocks count pairs of neighbours once; a pair goes to the pieces of both its words, by their
   buckets, and equal pairs of all blocks become one. A word of very many tokens has its neighbours in
   several pieces. A sweep moves a part of the words: their pieces sum the classes of the neighbours,
   the sums of a bucket meet in one task, and it moves its words to the class that raises the
   class-bigram likelihood most, judged against the class-by-class counts, which then change by the
   pairs of those pieces. One byte a word, its class, is what all tasks are told. Rarer words stand for
   the unknown ones: they belong to a class by their form, which is how they end, their length and the
   hash of their last letters.
4. P(word | previous) = P(class | previous class) * P(word | class). Transitions are smoothed towards the
   class unigrams; in form classes an absolute discount leaves mass for one unknown word. The
   probabilities of all known words, the end and the unknown word of each form sum to one.
5. Places and counts go back to the blocks packed by bucket, once; a block is scored in one go.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from math import log10
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.text import LOOKUP_BYTES, give_back, held_out, mix, steps, whole, word_hashes, words_of
from tidepanel.sources.staging import stage, staging_path

BLOCK_WORDS = 750_000
#: Fewest training tokens of a word that is clustered.
MIN_COUNT = 5
CLASSES = 32
SWEEPS = 9
#: A sweep moves one part of the words in so many.
PARTS = 3
#: Tokens of a bucket's words, about.
BUCKET_TOKENS = 1 << 22
#: A word's neighbours are dealt to one piece more for each so many of its training tokens.
SLICE_TOKENS = 1 << 22
#: Neighbour sums that are judged at a time, and sides of words that are summed at a time.
CELLS, SIDES = 1 << 16, 1 << 12
#: Forms: end (letter, . or , or other) x short or long x hash of the last letters.
SUFFIXES = 16
FORMS = 3 * 2 * SUFFIXES
#: Tokens that the class unigrams count for in a transition.
BACK = 50.0

BLOCKS = "part int, seq int, doc_ids array<long>, held array<boolean>, lengths array<long>, words array<string>, train array<long>, tokens binary"


def _packed(x: np.ndarray) -> bytes:
    """Integers with bytes of the same weight together, compressed."""
    return zlib.compress(np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes(), 1)


def _unpacked(cell: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(cell), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _blocks(batches: Iterator[pa.RecordBatch], block_words: int) -> Iterator[pa.RecordBatch]:
    part, seq, held = TaskContext.get().partitionId(), 0, []

    def one(values: pa.Array) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)

    def close() -> pa.RecordBatch:
        coded = pa.concat_arrays([w for w, _, _, _ in held]).dictionary_encode()
        lengths = np.concatenate([n for _, n, _, _ in held])
        out = pa.concat_arrays([h for _, _, h, _ in held])
        index = coded.indices.to_numpy().astype(np.uint32)
        train = np.repeat(~out.to_numpy(zero_copy_only=False).astype(bool), lengths)
        counts = np.bincount(index[train], minlength=len(coded.dictionary)).astype(np.int64)
        cells = [pa.array([part], pa.int32()), pa.array([seq], pa.int32())]
        cells += [one(pa.concat_arrays([d for _, _, _, d in held])), one(out), one(pa.array(lengths)), one(coded.dictionary)]
        cells += [one(pa.array(counts)), pa.array([_packed(index)], pa.binary())]
        return pa.RecordBatch.from_arrays(cells, names=[c.split()[0] for c in BLOCKS.split(", ")])

    for batch in steps(batches, LOOKUP_BYTES):
        words, starts = words_of(pc.ascii_lower(pc.fill_null(whole(batch.column("text")), "")))
        held.append((words, np.diff(starts).astype(np.int64), batch.column("held"), batch.column("doc_id")))
        if sum(len(w) for w, _, _, _ in held) >= block_words:
            yield close()
            seq, held = seq + 1, []
    if held:
        yield close()


def forms(words: pa.Array) -> np.ndarray:
    """The form class of each word."""
    bare = pc.utf8_trim(words, ".,;:!?\"'()[]{}#*$%&|<>")
    tail = pc.utf8_slice_codeunits(bare, start=-2)
    filled = pc.if_else(pc.equal(tail, ""), "-", tail)
    suffix = (word_hashes(whole(filled), 71) % np.uint64(SUFFIXES)).astype(np.int64)
    last = pc.utf8_slice_codeunits(words, start=-1)
    stop = pc.is_in(last, pa.array([".", ","])).to_numpy(zero_copy_only=False)
    changed = pc.not_equal(bare, words).to_numpy(zero_copy_only=False)
    end = np.where(stop, 1, np.where(changed, 2, 0))
    long_word = pc.utf8_length(words).to_numpy(zero_copy_only=False) > 7
    return (end * 2 + long_word) * SUFFIXES + suffix


DEALT = "bucket long, part int, seq int, at binary, words array<string>, train array<long>"


def _dealt(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """The words of each block by bucket, with where they are in the block."""
    for batch in batches:
        for i in range(batch.num_rows):
            words, train = batch.column("words")[i].values, batch.column("train")[i].values
            if not len(words):
                continue
            bucket = (word_hashes(words, 37) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket = bucket[order]
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(order)]])
            offsets, at = pa.array(cuts, pa.int32()), order.astype(np.uint32)
            cells = [pa.array(bucket[cuts[:-1]])]
            cells += [pa.array([batch.column(c)[i].as_py()] * len(cells[0]), pa.int32()) for c in ("part", "seq")]
            cells += [pa.array([_packed(at[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())]
            cells += [pa.ListArray.from_arrays(offsets, x.take(pa.array(order))) for x in (words, train)]
            yield pa.RecordBatch.from_arrays(cells, names=[c.split()[0] for c in DEALT.split(", ")])
    batch = None
    give_back()


#: Sums over the words of a bucket: clustered ones, those of training tokens, and by form, of those that are not
#: clustered, tokens, words, words of one and of two tokens.
SUMS = 2 + 4 * FORMS
PLACED = "part int, seq int, bucket long, at binary, place binary, c binary, sums array<long>"


def _placed(rows: pa.Table) -> pa.Table:
    """The place of each word of a bucket in order of counts, or -1 - its form, for each block; sums are in the first row only."""
    lists = whole(rows.column("words"))
    coded = whole(lists.flatten()).dictionary_encode()
    index, types = coded.indices.to_numpy(), coded.dictionary
    c = np.bincount(index, whole(rows.column("train")).flatten().to_numpy(), len(types)).astype(np.int64)
    order = pc.sort_indices(pa.table({"c": c, "word": types}), [("c", "descending"), ("word", "ascending")]).to_numpy()
    order = order[c[order] >= MIN_COUNT].astype(np.int64)
    form = forms(types)
    place = (-1 - form).astype(np.int32)
    place[order] = np.arange(len(order))
    rare = (c > 0) & (c < MIN_COUNT)
    sums = [np.bincount(form[rare], x[rare], FORMS) for x in (c, np.ones(len(c)), c == 1, c == 2)]
    sums = np.concatenate([[len(order), (c > 0).sum()], *sums]).astype(np.int64)
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    spans = [index[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]
    packed = [pa.array([_packed(x[span]) for span in spans], pa.binary()) for x in (place, c)]
    told = pa.array([sums] + [None] * (len(spans) - 1), pa.list_(pa.int64()))
    cells = [*(whole(rows.column(x)) for x in ("part", "seq", "bucket", "at")), *packed, told]
    return pa.table(cells, names=[x.split()[0] for x in PLACED.split(", ")])


NUMBERED = "doc_ids array<long>, held array<boolean>, lengths array<long>, tokens binary, units binary, counts binary"


def _numbered(batches: Iterator[pa.RecordBatch], size: int, slots: int) -> Iterator[pa.RecordBatch]:
    """Blocks with the unit and training count of each word: its slot, or behind all slots its form."""
    for batch in batches:
        units, counts = [], []
        for found in batch.column("found").to_pylist():
            pieces = [[_unpacked(f[x], kind) for x, kind in (("at", np.uint32), ("place", np.int32), ("c", np.int64))] for f in found or []]
            unit, c = np.zeros(sum(len(at) for at, _, _ in pieces), np.uint32), np.zeros(sum(len(at) for at, _, _ in pieces), np.int64)
            for f, (at, place, n) in zip(found or [], pieces, strict=True):
                unit[at] = np.where(place >= 0, f["bucket"] * size + place, slots - 1 - place.astype(np.int64))
                c[at] = n
            units.append(_packed(unit))
            counts.append(_packed(c))
        cells = [batch.column(c) for c in ("doc_ids", "held", "lengths", "tokens")] + [pa.array(x, pa.binary()) for x in (units, counts)]
        yield pa.RecordBatch.from_arrays(cells, names=[c.split()[0] for c in NUMBERED.split(", ")])
    batch = None
    give_back()


def _cells(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray]:
    units = _unpacked(batch.column("units")[i].as_py(), np.uint32).astype(np.int64)
    return units, _unpacked(batch.column("counts")[i].as_py(), np.int64)


def _pairs(batch: pa.RecordBatch, i: int, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The units of each training token and of the one in front; every document starts after an end."""
    line, ends, _ = _lines(batch, i, _cells(batch, i)[0], end)
    held = batch.column("held")[i].values.to_numpy(zero_copy_only=False).astype(bool)
    train = np.repeat(~held, np.diff(np.append(ends, len(line))))
    before = np.roll(line, 1)
    before[ends] = end
    return before[train], line[train]


def _class_pairs(batches: Iterator[pa.RecordBatch], of: np.ndarray, last: int) -> Iterator[pa.RecordBatch]:
    table = np.zeros(last * last, np.int64)
    for batch in batches:
        for i in range(batch.num_rows):
            x, y = _pairs(batch, i, len(of) - 1)
            table += np.bincount(of[x].astype(np.int64) * last + of[y], minlength=last * last)
    code = np.flatnonzero(table)
    yield pa.RecordBatch.from_arrays([pa.array(code // last), pa.array(code % last), pa.array(table[code])], names=["x", "y", "n"])
    batch = None
    give_back()


#: What a neighbour sum is of: classes behind a word, classes in front of it, the word behind itself.
AFTER, BEFORE, OWN = range(3)

#: Pairs in order of word and other: a word is its place among its part of the bucket's, twice, plus the kind.
PIECES = "part int, bucket long, slice int, word binary, other binary, n binary"


def _piece(part: int, bucket: int, cut: int, word: np.ndarray, other: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    cells = [pa.array([part], pa.int32()), pa.array([bucket], pa.int64()), pa.array([cut], pa.int32())]
    arrays = (word.astype(np.uint32), other.astype(np.uint32), n.astype(np.int64))
    cells += [pa.array([_packed(x)], pa.binary()) for x in arrays]
    return pa.RecordBatch.from_arrays(cells, names=[c.split()[0] for c in PIECES.split(", ")])


def _arrays(batch: pa.RecordBatch | pa.Table, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    word, other = (_unpacked(batch.column(c)[i].as_py(), np.uint32).astype(np.int64) for c in ("word", "other"))
    return word, other, _unpacked(batch.column("n")[i].as_py(), np.int64)


def _block_pieces(batches: Iterator[pa.RecordBatch], size: int, buckets: int, slice_tokens: int) -> Iterator[pa.RecordBatch]:
    """The different training pairs of each block, dealt to the pieces of both words."""
    slots, wide = size * buckets, 2 * (size // PARTS + 1)
    units = slots + FORMS + 1
    for batch in batches:
        for i in range(batch.num_rows):
            unit, c = _cells(batch, i)
            hot = {int(w): int(t) + 1 for w, t in zip(unit, c // slice_tokens, strict=True) if t and w < slots}
            before, line = _pairs(batch, i, units - 1)
            for kind, mine, its in ((AFTER, before, line), (BEFORE, line, before)):
                clustered = mine < slots
                mine, its = mine[clustered], its[clustered]
                bucket, place = mine // size, mine % size
                side = (place % PARTS * buckets + bucket) * wide + place // PARTS * 2 + kind
                code, n = np.unique(side * units + its, return_counts=True)
                side, other = code // units, code % units
                home, word = side // wide, side % wide
                cut = np.zeros(len(home), np.int64)
                for w, times in hot.items():
                    at = (w % size % PARTS * buckets + w // size) * wide + w % size // PARTS * 2 + kind
                    a, b = np.searchsorted(side, [at, at + 1])
                    cut[a:b] = (mix(other[a:b].astype(np.uint64)) % np.uint64(times)).astype(np.int64)
                if hot:
                    order = np.lexsort((cut, home))
                    home, cut, word, other, n = (x[order] for x in (home, cut, word, other, n))
                changes = (home[1:] != home[:-1]) | (cut[1:] != cut[:-1])
                cuts = [0, *(np.flatnonzero(changes) + 1), len(home)] if len(home) else []
                for a, b in zip(cuts, cuts[1:], strict=False):
                    yield _piece(int(home[a] // buckets), int(home[a] % buckets), int(cut[a]), word[a:b], other[a:b], n[a:b])
    batch = None
    give_back()


def _merged(rows: pa.Table, units: int) -> pa.Table:
    """One piece of all blocks, equal pairs as one."""
    word, other, n = (np.concatenate(x) for x in zip(*(_arrays(rows, i) for i in range(rows.num_rows)), strict=True))
    code = word * units + other
    # Of sorted runs, one of each block.
    order = np.argsort(code, kind="stable")
    code, n = code[order], n[order]
    begins = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    code, n = code[begins], np.add.reduceat(n, begins)
    home = [rows.column(c)[0].as_py() for c in ("part", "bucket", "slice")]
    return pa.Table.from_batches([_piece(*home, code // units, code % units, n)])


def pair_pieces(lines: DataFrame, size: int, buckets: int, slice_tokens: int) -> DataFrame:
    """The pieces of all blocks, written by part, since a sweep reads one part."""
    units = size * buckets + FORMS + 1
    pieces = lines.mapInArrow(lambda it: _block_pieces(it, size, buckets, slice_tokens), PIECES)
    pieces = pieces.groupBy("part", "bucket", "slice").applyInArrow(lambda t: _merged(t, units), PIECES)
    path = staging_path(lines.sparkSession, "pairs")
    pieces.write.partitionBy("part").parquet(path)
    return lines.sparkSession.read.schema(pieces.schema).parquet(path)


def _class_sums(batches: Iterator[pa.RecordBatch], of: np.ndarray, size: int) -> Iterator[pa.RecordBatch]:
    """The neighbour sums of each piece's words."""
    for batch in batches:
        for i in range(batch.num_rows):
            part, bucket = batch.column("part")[i].as_py(), batch.column("bucket")[i].as_py()
            word, other, n = _arrays(batch, i)
            place = word // 2 * PARTS + part
            some, sums = [], []
            cuts = np.searchsorted(word, np.arange(0, word[-1] + 1 + SIDES, SIDES))
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b > a:
                    dense = np.bincount((word[a:b] - word[a]) * 256 + of[other[a:b]], n[a:b])
                    some.append(np.flatnonzero(dense))
                    sums.append(dense[some[-1]])
                    some[-1] = some[-1] + word[a] * 256
            some, sums = np.concatenate(some), np.concatenate(sums)
            w, kind, k = some // 512, some // 256 % 2, some % 256
            own = np.flatnonzero((word % 2 == AFTER) & (other == bucket * size + place))
            code = np.concatenate([((w * PARTS + part) * 3 + kind) * 256 + k, (place[own] * 3 + OWN) * 256])
            n = np.concatenate([sums.astype(np.int64), n[own]])
            cells = [pa.array([bucket], pa.int64())]
            cells += [pa.array([x.tobytes()], pa.binary()) for x in (code.astype(np.uint32), n)]
            yield pa.RecordBatch.from_arrays(cells, names=["bucket", "code", "n"])
    batch = None
    give_back()


def _class_changes(batches: Iterator[pa.RecordBatch], old: np.ndarray, new: np.ndarray, size: int, last: int) -> Iterator[pa.RecordBatch]:
    """What the class pairs change by when one part of the words has moved, from the part's pieces."""
    slots, table = len(old) - FORMS - 1, np.zeros(last * last)
    for batch in batches:
        for i in range(batch.num_rows):
            part, bucket = batch.column("part")[i].as_py(), batch.column("bucket")[i].as_py()
            word, other, n = _arrays(batch, i)
            # Of a pair of two words of the part, the first one's piece has it too.
            once = (word % 2 == AFTER) | (other >= slots) | (other % size % PARTS != part)
            word, other, n = word[once], other[once], n[once]
            unit, after = bucket * size + word // 2 * PARTS + part, word % 2 == AFTER
            for of, sign in ((old, -1), (new, 1)):
                mine, its = of[unit].astype(np.int64), of[other].astype(np.int64)
                code = np.where(after, mine * last + its, its * last + mine)
                table += sign * np.bincount(code, n, last * last)
    code = np.flatnonzero(table)
    n = pa.array(table[code].astype(np.int64))
    yield pa.RecordBatch.from_arrays([pa.array(code // last), pa.array(code % last), n], names=["x", "y", "n"])


def _moved(rows: pa.Table, of: np.ndarray, table: np.ndarray, size: int, classes: int) -> pa.Table:
    """The classes of a bucket's words after a sweep."""
    bucket = rows.column("bucket")[0].as_py()
    code = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint32).astype(np.int64)
    n = np.frombuffer(b"".join(rows.column("n").to_pylist()), np.int64)
    code, which = np.unique(code, return_inverse=True)
    n = np.bincount(which, n)
    word, kind, k = code // 768, code // 256 % 3, code % 256
    now = of[bucket * size : (bucket + 1) * size].astype(np.int64)
    there, place = np.unique(word, return_inverse=True)
    sums = [(place[kind == t], k[kind == t], n[kind == t]) for t in (AFTER, BEFORE)]
    own = np.bincount(place[kind == OWN], n[kind == OWN], len(there))
    now[there] = best_classes(table, now[there], *sums, own, classes)
    return pa.table({"bucket": pa.array([bucket], pa.int64()), "classes": pa.array([now.astype(np.uint8).tobytes()], pa.binary())})


def _lines(batch: pa.RecordBatch, i: int, unit: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The block's tokens as numbers with an end after each document, where documents begin, and their words' indexes."""
    index = _unpacked(batch.column("tokens")[i].as_py(), np.uint32)
    lengths = batch.column("lengths")[i].values.to_numpy()
    stops = np.cumsum(lengths)
    line = np.insert(unit[index] if len(index) else np.zeros(0, np.int64), stops, end)
    return line, np.concatenate([[0], np.cumsum(lengths + 1)[:-1]]).astype(np.int64), index


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


Sums = tuple[np.ndarray, np.ndarray, np.ndarray]


def class_gains(table: np.ndarray, g: np.ndarray, after: Sums, before: Sums, own: np.ndarray, classes: int) -> np.ndarray:
    """For words of classes ``g`` and each class the log likelihood with the word in it, up to a constant.

    ``table`` counts class pairs, words in their classes; after and before are (word, class, n) in order of words,
    with the word's pairs with itself, which ``own`` counts, among them.
    """
    m, all_words = len(g), np.arange(len(g))
    dense = []
    for word, k, n in (after, before):
        d = np.zeros((m, len(table)))
        np.add.at(d, (word, k), n)
        d[all_words, g] -= own
        dense.append(d)
    out, into = dense
    gain = np.zeros((m, classes))
    # Cells of the class's row and column, but for the diagonal: those that the word has pairs in.
    for counts, (word, k, n), side, other in ((table, after, out, into), (table.T, before, into, out)):
        for a in range(0, len(word), CELLS):
            w, h = word[a : a + CELLS], k[a : a + CELLS]
            x = side[w, h]
            at, own_class = np.arange(len(w)), g[w]
            cell = counts[:classes, h].T.copy()
            cell[at, own_class] -= x
            home = np.flatnonzero(h == own_class)
            cell[home] -= other[w[home], :classes]
            change = _xlogx(cell + x[:, None]) - _xlogx(cell)
            diagonal = np.flatnonzero(h < classes)
            change[diagonal, h[diagonal]] = 0
            begins = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1]]))
            gain[w[begins]] += np.add.reduceat(change, begins)
    both = out[:, :classes] + into[:, :classes] + own[:, None]
    cell = np.tile(np.diag(table)[:classes], (m, 1))
    cell[all_words, g] -= both[all_words, g]
    gain += _xlogx(cell + both) - _xlogx(cell)
    for total, d in ((table.sum(axis=1), out), (table.sum(axis=0), into)):
        size = d.sum(axis=1) + own
        margin = np.tile(total[:classes], (m, 1))
        margin[all_words, g] -= size
        gain -= _xlogx(margin + size[:, None]) - _xlogx(margin)
    return gain


def best_classes(table: np.ndarray, g: np.ndarray, after: Sums, before: Sums, own: np.ndarray, classes: int) -> np.ndarray:
    """The class of each word after the move that raises the likelihood most, if one does."""
    gain = class_gains(table, g, after, before, own, classes)
    best, at = gain.argmax(axis=1), np.arange(len(g))
    return np.where(gain[at, best] > gain[at, g] + 1e-6, best, g)


class Model(NamedTuple):
    #: Class of each unit: slots of clustered words, forms, the end. Transition log10 by class; tokens of each class.
    of: np.ndarray
    transition: np.ndarray
    class_tokens: np.ndarray
    #: By form: discount, tokens, log10 of the unknown word's share.
    discount: np.ndarray
    form_tokens: np.ndarray
    unknown: np.ndarray
    tokens: int
    types: int
    documents: int


def cluster(numbered: DataFrame, words: int, size: int, buckets: int, slice_tokens: int = SLICE_TOKENS) -> tuple[np.ndarray, np.ndarray]:
    """The class of each unit and the class pairs; the words have the slots bucket * size + place.

    All moves of a sweep are judged by the class pairs at its start, so only every third word moves in it.
    """
    context = numbered.sparkSession.sparkContext
    classes = min(CLASSES, max(1, words))
    last, slots = classes + FORMS + 1, size * buckets
    of = np.concatenate([np.arange(slots) % size % classes, classes + np.arange(FORMS + 1)]).astype(np.uint8)
    lines = numbered.select("held", "lengths", "tokens", "units", "counts")

    def total(sums: DataFrame) -> np.ndarray:
        table = np.zeros((last, last))
        for r in sums.groupBy("x", "y").agg(F.sum("n").alias("n")).collect():  # classes x classes cells
            table[r["x"], r["y"]] = r["n"]
        return table

    def moved(pieces: DataFrame, told, judged) -> DataFrame:
        sums = pieces.mapInArrow(lambda it: _class_sums(it, told.value, size), "bucket long, code binary, n binary")
        return sums.groupBy("bucket").applyInArrow(
            lambda t: _moved(t, told.value, judged.value, size, classes), "bucket long, classes binary"
        )

    def changes(pieces: DataFrame, before, after) -> DataFrame:
        return pieces.mapInArrow(
            lambda it: _class_changes(it, before.value, after.value, size, last), "x long, y long, n long"
        )

    told = context.broadcast(of)
    table = total(lines.mapInArrow(lambda it: _class_pairs(it, told.value, last), "x long, y long, n long"))
    if words < 2:
        return of, table
    pairs = pair_pieces(lines, size, buckets, slice_tokens)
    for sweep in range(SWEEPS):
        pieces, judged = pairs.filter(F.col("part") == sweep % PARTS), context.broadcast(table)
        of = of.copy()
        for r in moved(pieces, told, judged).collect():  # a byte a word
            of[r["bucket"] * size : (r["bucket"] + 1) * size] = np.frombuffer(r["classes"], np.uint8)
        before, told = told, context.broadcast(of)
        table += total(changes(pieces, before, told))
        before.unpersist()
        judged.unpersist()
    return of, table


def fit(blocks: DataFrame) -> tuple[Model, DataFrame]:
    """The model of the blocks' training documents and the numbered blocks."""
    docs = F.size(F.filter("held", lambda h: ~h))
    all_tokens = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    train = F.aggregate("train", F.lit(0).cast("long"), lambda a, x: a + x)
    documents, all_tokens, tokens = (x or 0 for x in blocks.agg(F.sum(docs), F.sum(all_tokens), F.sum(train)).first())
    buckets = all_tokens // BUCKET_TOKENS + 1
    dealt = blocks.select("part", "seq", "words", "train").mapInArrow(lambda it: _dealt(it, buckets), DEALT)
    placed = stage(dealt.groupBy("bucket").applyInArrow(_placed, PLACED), "places")
    sums = placed.filter("sums is not null").select(F.posexplode("sums").alias("i", "n"))
    stats, most = np.zeros(SUMS), 0
    for r in sums.groupBy("i").agg(F.sum("n").alias("n"), F.max("n").alias("most")).collect():  # SUMS rows
        stats[r["i"]], most = r["n"], r["most"] if r["i"] == 0 else most
    words, types, size = int(stats[0]), int(stats[1]) + (documents > 0), most + 1
    tokens += documents
    # As many rows as the block has buckets.
    found = placed.groupBy("part", "seq").agg(F.collect_list(F.struct("bucket", "at", "place", "c")).alias("found"))
    joined = blocks.select("part", "seq", "doc_ids", "held", "lengths", "tokens").join(found, ["part", "seq"], "left")
    numbered = stage(joined.drop("part", "seq").mapInArrow(lambda it: _numbered(it, size, size * buckets), NUMBERED), "numbered")

    of, table = cluster(numbered, words, size, buckets)
    last = len(table)
    unigram = (table.sum(axis=0) + 0.5) / (table.sum() + 0.5 * last)
    transition = np.log10((table + BACK * unigram) / (table.sum(axis=1, keepdims=True) + BACK))
    n, kinds, once, twice = stats[2:].reshape(4, FORMS)
    discount = np.clip((once + 0.5) / (once + 2 * twice + 1), 0.05, 0.95)
    unknown = np.where(n > 0, discount * kinds / np.maximum(n, 1), 1.0)
    # Every training token is behind another one or an end, so a class's column has all its tokens.
    model = Model(of, transition, table.sum(axis=0), discount, n, np.log10(unknown), int(tokens), int(types), int(documents))
    return model, numbered


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scored(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    end = len(model.of) - 1
    slots = end - FORMS
    spread = model.tokens + model.types + 1
    for batch in batches:
        for i in range(batch.num_rows):
            unit, c = _cells(batch, i)
            rare = unit >= slots
            given = np.zeros(len(unit))
            given[~rare] = np.log10(c[~rare] / model.class_tokens[model.of[unit[~rare]]])
            f = unit[rare] - slots
            share = np.maximum(c[rare] - model.discount[f], 1e-9) / np.maximum(model.form_tokens[f], 1)
            given[rare] = np.where(c[rare] > 0, np.log10(share), model.unknown[f])
            line, begins, index = _lines(batch, i, unit, end)
            at_end = line == end
            base_word = np.log10((c + 1) / spread)
            base, emitted, known = (np.zeros(len(line)) for _ in range(3))
            base[at_end], known[at_end] = log10((model.documents + 1) / spread), model.documents > 0
            base[~at_end], emitted[~at_end], known[~at_end] = base_word[index], given[index], c[index] > 0
            of = model.of[line]
            previous = np.roll(of, 1)
            previous[begins] = model.of[end]
            score = model.transition[previous, of] + emitted
            sums = [np.add.reduceat(x, begins) if len(begins) else np.zeros(0) for x in (known, base, score)]
            lengths = batch.column("lengths")[i].values.to_numpy() + 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_ids")[i].values,
                    batch.column("held")[i].values,
                    pa.array(lengths),
                    pa.array(np.rint(sums[0]).astype(np.int64)),
                    pa.array(np.full(len(lengths), model.tokens, np.int64)),
                    pa.array(sums[1]),
                    pa.array(sums[2]),
                ],
                names=[c.split()[0] for c in SCORES.split(", ")],
            )


def score(docs: DataFrame, of: int = 7, remainder: int = 2, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score and the model's score.

    Learns from rows whose id is not held out (crc32 of the id as text leaves ``remainder``); a missing id
    is not. A null, empty or blank text is one end token. Rows may repeat and count as often; further
    columns are ignored; without rows there are none, without training rows all tokens are unknown.
    """
    rows = docs.select("doc_id", held_out("doc_id", of, remainder).alias("held"), "text")
    blocks = stage(rows.mapInArrow(lambda it: _blocks(it, block_words), BLOCKS), "blocks")
    model, numbered = fit(blocks)
    told = docs.sparkSession.sparkContext.broadcast(model)
    return numbered.mapInArrow(lambda it: _scored(it, told.value), SCORES)
