"""SentencePiece encoding with seeded merge-dropout, and decoding.

The pieces of a byte-pair model are merged from an agenda by score; a candidate merge is skipped
when a keyed hash of (seed, document, chunk, place, left, right) falls below ``dropout``: a word is segmented
anew each time it occurs. The hash is of the document's id and the chunk's number in it, so an epoch
is repeatable on any machine and another seed gives other segmentations. All of them decode to the text.

No piece of the model has a word mark after another character, so text between word marks is
encoded on its own. The chunks of a batch that have the same characters share an agenda until one of
them skips a merge that another takes; from there on the agenda is two. Agendas of chunks of one length
take their steps together, as rows of a matrix; a chunk beyond ``LONG`` characters has a heap for its
own. Ids are gathered, and decoded again, for a whole batch at a time.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from tidepanel.llm.text import LOOKUP_BYTES, constants, mix, steps, whole

MARK = "▁"
DROPOUT, SEED, STREAMS = 0.1, 7, 4
#: Longest chunk, in characters, whose agenda is a row of a matrix, and characters that share a matrix.
LONG, CELLS = 64, 4_000_000
#: What a chunk's number in its document and a place in a chunk count for in the key.
CHUNK, PLACE = constants(2, 83)


class Merger:
    """The pieces, scores and byte pieces of a model file, and which pairs of parts make a piece."""

    def __init__(self, path: str, dropout: float, seed: int):
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(sentencepiece.SentencePieceProcessor(model_file=path).serialized_model_proto())
        if proto.normalizer_spec.name != "identity":
            raise ValueError("the model changes texts before it encodes them, so decoding would not give them back")
        kinds = sentencepiece_model_pb2.ModelProto.SentencePiece
        self.score: dict[str, float] = {}
        self.number: dict[str, int] = {}
        self.bytes_number = np.zeros(256, np.int32)
        self.decoded: list[bytes] = []
        for i, piece in enumerate(proto.pieces):
            if piece.type == kinds.BYTE:
                value = int(piece.piece[3:5], 16)
                self.bytes_number[value] = i
                self.decoded.append(bytes([value]))
            elif piece.type in (kinds.NORMAL, kinds.USER_DEFINED):
                self.score[piece.piece], self.number[piece.piece] = piece.score, i
                self.decoded.append(piece.piece.replace(MARK, " ").encode())
            else:
                self.decoded.append(b"")
        if any(MARK in p.lstrip(MARK) for p in self.number):
            raise ValueError("a piece has a word mark inside")
        # A newline that stands alone in the pieces ends what is encoded together as well.
        self.lines = not any("\n" in p and p != "\n" for p in self.number)
        self.pieces = pa.array(self.decoded, pa.binary())
        self.limit, self.salt = np.uint64(dropout * 2**32), constants(1, seed)[0]
        # Parts are single characters and pieces; any other character is the last number and merges with nothing.
        parts = sorted({c for piece in self.number for c in piece} | set(self.number))
        place = {part: i for i, part in enumerate(parts)}
        self.kinds = len(parts) + 1
        self.id_of = np.array([*(self.number.get(part, -1) for part in parts), -1], np.int32)
        self.part_of = np.full(0x110000, len(parts), np.int32)
        for part in parts:
            if len(part) == 1:
                self.part_of[ord(part)] = place[part]
        # A space stands for the word mark; one in the text itself is spelled in bytes, to come back as it was.
        self.part_of[ord(" ")] = place.get(MARK, len(parts))
        self.part_of[ord(MARK)] = len(parts)
        self.pairs: dict[int, tuple[float, int]] = {}
        for piece, score in self.score.items():
            for k in range(1, len(piece)):
                if piece[:k] in place and piece[k:] in place:
                    self.pairs[place[piece[:k]] * self.kinds + place[piece[k:]]] = (score, place[piece])
        self.codes = np.array(sorted(self.pairs), np.int64)
        self.scores = np.array([self.pairs[c][0] for c in self.codes.tolist()])
        self.makes = np.array([self.pairs[c][1] for c in self.codes.tolist()], np.int32)

    def skipped(self, stream: np.ndarray, at: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the keyed hash skips merging two parts, the left one at that place of its chunk."""
        code = (left.astype(np.int64) * self.kinds + right).astype(np.uint64)
        key = mix(at.astype(np.uint64) * PLACE + stream.astype(np.uint64) + self.salt)
        return mix(key + code) >> np.uint64(32) < self.limit

    def candidates(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score of merging two parts, minus infinity where they make no piece, and the piece."""
        code = left.astype(np.int64) * self.kinds + right
        if not len(self.codes):
            return np.full(code.shape, -np.inf), np.zeros(code.shape, np.int32)
        i = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[i] == code, self.scores[i], -np.inf), self.makes[i]

    def merged_long(self, parts: list[int], stream: np.integer) -> list[tuple[int, int]]:
        """The agenda of one chunk as a heap: best score first, the leftmost of equals; a skipped pair
        comes up no more. (place, part) of what is left."""
        n = len(parts)
        # Where the part that starts at a place ends, and where the one in front of it starts.
        end, front = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = []

        def offer(i: int, j: int) -> None:
            found = self.pairs.get(parts[i] * self.kinds + parts[j])
            if found:
                heappush(agenda, (-found[0], i, j, end[j], found[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, i, j, stop, makes = heappop(agenda)
            # One of the two may have been merged since; the part at j then ends elsewhere or is gone.
            if parts[i] < 0 or end[i] != j or end[j] != stop:
                continue
            if self.limit and self.skipped(*(np.array([x]) for x in (stream, i, parts[i], parts[j])))[0]:
                continue
            parts[i], parts[j], end[i] = makes, -1, stop
            if stop < n:
                front[stop] = i
                offer(i, stop)
            if front[i] >= 0:
                offer(front[i], i)
        return [(i, part) for i, part in enumerate(parts) if part >= 0]

    def merged(self, parts: np.ndarray, row: np.ndarray, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The agendas of chunks of one length, a row each and a step at a time; order and skips as in
        ``merged_long``. ``row`` and ``stream`` are of the occurrences; a row is doubled when only some of its
        occurrences skip. (row of each occurrence; row, place, part of what is left, by row and place)."""
        m, n = parts.shape
        # One more column stands for the end; nothing merges with it.
        parts = np.column_stack([parts, np.full(m, self.kinds - 1, np.int32)])
        end, front = (np.tile(np.arange(a, a + n + 1, dtype=np.int32), (m, 1)) for a in (1, -1))
        score, makes = self.candidates(parts[:, :-1], parts[:, 1:])
        left = np.ones((m, n), bool)
        row, rows, going = row.copy(), np.arange(m), np.arange(len(row))
        while len(rows):
            at = score[rows].argmax(axis=1)
            open_ = score[rows, at] > -np.inf
            rows, at = rows[open_], at[open_]
            # By row: its step's place among the open ones.
            step = np.full(len(parts), -1)
            step[rows] = np.arange(len(rows))
            mine = step[row[going]]
            going, mine = going[mine >= 0], mine[mine >= 0]
            j = end[rows, at]
            left_part, right_part = parts[rows, at], parts[rows, j]
            skip = self.skipped(stream[going], at[mine], left_part[mine], right_part[mine])
            skips, takes = (np.bincount(mine[x], minlength=len(rows)) > 0 for x in (skip, ~skip))
            both = np.flatnonzero(skips & takes)
            if len(both):
                twin = np.zeros(len(rows), np.int64)
                twin[both] = len(parts) + np.arange(len(both))
                parts, end, front, score, makes, left = (np.concatenate([x, x[rows[both]]]) for x in (parts, end, front, score, makes, left))
                moved = skip & takes[mine]
                row[going[moved]] = twin[mine[moved]]
                score[twin[both], at[both]] = -np.inf
            only = skips & ~takes
            score[rows[only], at[only]] = -np.inf
            r, i, j = rows[takes], at[takes], j[takes]
            rows = np.concatenate([rows, twin[both]]) if len(both) else rows
            stop = end[r, j]
            parts[r, i] = makes[r, i]
            end[r, i], front[r, stop] = stop, i
            left[r, j], score[r, j] = False, -np.inf
            score[r, i], makes[r, i] = self.candidates(parts[r, i], parts[r, stop])
            before = front[r, i]
            r, i, before = (x[before >= 0] for x in (r, i, before))
            score[r, before], makes[r, before] = self.candidates(parts[r, before], parts[r, i])
        at_row, place = np.nonzero(left)
        return row, at_row, place, parts[at_row, place]

    def paths(self, chunks: list[str], owner: np.ndarray, streams: np.ndarray) -> tuple[pa.ListArray, np.ndarray]:
        """The different segmentations of chunks as lists of ids, and which of them each occurrence has;
        ``owner`` is the chunk of each occurrence and ``streams`` its key."""
        size = np.array([len(c) for c in chunks], np.int64)
        begin = np.append(0, np.cumsum(size))
        points = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)
        parts = self.part_of[points]
        path, found, made = np.zeros(len(owner), np.int64), [], 0
        order = np.lexsort([owner, size[owner]])
        of_order = size[owner[order]]
        for n in np.unique(of_order[of_order <= LONG]).tolist():
            low, high = np.searchsorted(of_order, (n, n + 1))
            for some in np.array_split(order[low:high], (high - low) * n // CELLS + 1):
                own, which = np.unique(owner[some], return_inverse=True)
                row, at_row, place, part = self.merged(parts[begin[own][:, None] + np.arange(n)], which, streams[some])
                # Rows of the matrix that were doubled stand behind the first ones.
                chunk = np.zeros(int(at_row[-1]) + 1, np.int64)
                chunk[row] = owner[some]
                path[some] = made + row
                found.append((made + at_row, begin[chunk[at_row]] + place, part))
                made += len(chunk)
        for k in order[np.searchsorted(of_order, LONG, side="right") :].tolist():
            a, b = begin[owner[k]], begin[owner[k] + 1]
            place, part = np.array(self.merged_long(parts[a:b].tolist(), streams[k])).T
            path[k] = made
            found.append((np.full(len(place), made), a + place, part))
            made += 1
        of_path, place, part = (np.concatenate(x) for x in zip(*found, strict=True))
        ids = self.id_of[part]
        # A character without a piece is spelled in bytes.
        spelled = "".join(map(chr, np.where(points == ord(" "), ord(MARK), points)[place[ids < 0]].tolist()))
        point = points[place]
        count = np.where(ids < 0, np.where(point == ord(" "), 3, 1 + (point >= 0x80) + (point >= 0x800) + (point >= 0x10000)), 1)
        out = np.repeat(ids, count)
        out[out < 0] = self.bytes_number[np.frombuffer(spelled.encode(), np.uint8)]
        lengths = np.add.reduceat(count, np.searchsorted(of_path, np.arange(made)))
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), pa.array(out)), path

    def numbers(self, chunks: list[str], streams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of chunks one after another, and how many each has."""
        lists, path = self.paths(chunks, np.arange(len(chunks)), streams)
        own = lists.take(pa.array(path))
        return own.flatten().to_numpy(), own.value_lengths().to_numpy()

    def chunks(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where what is encoded together begins in the bytes of texts, a space standing for a word mark."""
        space = data == ord(" ")
        start = space.copy()
        start[1:] &= ~space[:-1]
        if self.lines:
            line = data == ord("\n")
            start |= line
            start[1:] |= line[:-1]
        a, b, c = MARK.encode()
        mark = np.flatnonzero((data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c))
        start[mark] = True
        start[mark[mark + 3 < len(data)] + 3] = True
        start[offsets[:-1][np.diff(offsets) > 0]] = True
        return np.flatnonzero(start)

    def encode(self, texts: pa.Array, streams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, and where those of each begin, with the end of the last; ``streams`` are the texts' keys."""
        marked = pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(" ", texts, ""))
        offsets = np.frombuffer(marked.buffers()[1], np.int32)[: len(marked) + 1]
        if not len(marked) or not offsets[-1]:
            return np.zeros(0, np.int32), np.zeros(len(marked) + 1, np.int64)
        data = np.frombuffer(marked.buffers()[2], np.uint8)[: offsets[-1]]
        at = self.chunks(data, offsets)
        cuts = pa.py_buffer(np.append(at, len(data)).astype(np.int32))
        coded = pa.Array.from_buffers(pa.binary(), len(at), [None, cuts, pa.py_buffer(data)]).dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        plain = coded.dictionary.cast(pa.string()).to_pylist()
        first = np.searchsorted(at, offsets)
        if self.limit:
            owner = np.searchsorted(offsets, at, side="right") - 1
            number = (np.arange(len(at)) - first[owner]).astype(np.uint64)
            lists, path = self.paths(plain, code, mix(streams[owner].astype(np.uint64) + number * CHUNK))
        else:
            lists, path = self.paths(plain, np.arange(len(plain)), np.zeros(len(plain), np.int64))
            path = path[code]
        size = lists.value_lengths().to_numpy()
        ids = lists.take(pa.array(path)).flatten().to_numpy()
        return ids, np.append(0, np.cumsum(size[path], dtype=np.int64))[first]

    def decode(self, ids: np.ndarray, begins: np.ndarray) -> list[bytes]:
        """The bytes of the texts whose ids begin there, without the word mark in front."""
        pieces = self.pieces.take(pa.array(ids))
        ends = np.frombuffer(pieces.buffers()[1], np.int32) if len(ids) else np.zeros(1, np.int32)
        data = memoryview(pieces.buffers()[2]) if len(ids) else memoryview(b"")
        cuts = ends[begins].tolist()
        return [bytes(data[a + 1 : b]) for a, b in zip(cuts, cuts[1:], strict=False)]


@lru_cache(maxsize=2)
def merger(path: str, dropout: float, seed: int) -> Merger:
    return Merger(path, dropout, seed)


def _encoded(batches: Iterator[pa.RecordBatch], path: str, dropout: float, seed: int, full: bool) -> Iterator[pa.RecordBatch]:
    tool = merger(path, dropout, seed)
    for batch in steps(batches, LOOKUP_BYTES // 2):
        numbers = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        keys = mix(numbers + constants(1, seed)[0])
        texts = pc.fill_null(whole(batch.column("text")), "")
        ids, begins = tool.encode(texts, keys)
        back = tool.decode(ids, begins)
        same = [x == y for x, y in zip(back, texts.cast(pa.binary()).to_pylist(), strict=True)]
        cuts = begins.tolist()
        columns = {
            "doc_id": batch.column("doc_id"),
            "stream": pa.array((keys % np.uint64(STREAMS)).astype(np.int32)),
            "n_ids": pa.array(np.diff(begins), pa.int64()),
            "ids_crc32": pa.array([zlib.crc32(ids[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)], pa.int64()),
            "lossless": pa.array(same, pa.bool_()),
        }
        if full:
            columns["ids"] = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids))
            columns["decoded"] = pa.array([x.decode("utf-8", "replace") for x in back], pa.string())
        yield pa.RecordBatch.from_pydict(columns)


def encode(docs: DataFrame, path: str, dropout: float = DROPOUT, seed: int = SEED, full: bool = True) -> DataFrame:
    """Per row: doc_id, stream, n_ids, ids_crc32 (of the ids as little-endian 32-bit), lossless and,
    with ``full``, ids and the text decoded from them.

    lossless says that decoding gave the text back, which holds for every text; null counts as
    empty and has no ids. Rows may repeat; a missing doc_id has the key of id 0; stream is one of
    ``STREAMS`` groups that the documents fall into by their keys; further columns are ignored; no rows give none. dropout 0 is the model's own segmentation.
    """
    schema = "doc_id long, stream int, n_ids long, ids_crc32 long, lossless boolean"
    schema += ", ids array<int>, decoded string" if full else ""
    return docs.select("doc_id", "text").mapInArrow(lambda it: _encoded(it, path, dropout, seed, full), schema)
