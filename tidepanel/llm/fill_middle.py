"""Fill-in-the-middle by displacement scatter.

A text is cut at two of its tokens into prefix, middle and suffix, and written in the order prefix, suffix,
middle (psm) or suffix, prefix, middle (spm) with a marker before each part; some texts stay plain. The
texts of a batch are one run of bytes. A difference array holds, at the first byte of every part, by how
much its shift differs from that of the part before; its running sum is every byte's way to the output,
where numpy scatters all bytes at once. Restoring finds the markers in the outputs, builds the same
difference array from the lengths of the parts, and gathers. Both go through long texts by windows, so
that they hold a few bytes for each byte of text whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.text import steps, whole

#: Text that one step of a batch works on, and the bytes whose shifts are held at a time.
STEP_BYTES, WINDOW = 4 << 20, 1 << 20
#: Percent of the texts that stay plain, and of the others that are spm.
PLAIN, SPM = 10, 20
SEED = 1
FORMS = ("plain", "psm", "spm")
#: The markers in the order in which their parts stand in the text.
MARKERS = (b"<P>", b"<M>", b"<S>")
PREFIX, MIDDLE, SUFFIX = range(3)
#: The parts in the order of each form's output.
ORDERS = {1: (PREFIX, SUFFIX, MIDDLE), 2: (SUFFIX, PREFIX, MIDDLE)}


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one run of bytes, and where each begins (one more for the end). Null: empty."""
    texts = pc.fill_null(whole(texts), "").cast(pa.string())
    at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)), at - at[0]


def strings_of(data: np.ndarray, at: np.ndarray) -> pa.Array:
    return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data))


def count_before(marks: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many marks lie before each of the ascending positions."""
    found, total = np.zeros(len(at), np.int64), 0
    for a in range(0, len(marks), WINDOW):
        run = np.concatenate([[total], total + np.cumsum(marks[a : a + WINDOW], dtype=np.int64)])
        low, high = np.searchsorted(at, [a, a + len(run) - 1])
        found[low:high] = run[at[low:high] - a]
        total = int(run[-1])
    found[np.searchsorted(at, len(marks)) :] = total
    return found


def place_of(marks: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Where the marks of these ascending numbers (from 0) are; the end of all for a number beyond the last."""
    found, total = np.full(len(numbers), len(marks), np.int64), 0
    for a in range(0, len(marks), WINDOW):
        own = np.flatnonzero(marks[a : a + WINDOW])
        low, high = np.searchsorted(numbers, [total, total + len(own)])
        found[low:high] = a + own[numbers[low:high] - total]
        total += len(own)
    return found


def token_starts(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marks of the first bytes of the tokens ``[A-Za-z]+|[^A-Za-z]``, and of the code points."""
    first = (data & 0xC0) != 0x80
    letter = ((data | 0x20) >= ord("a")) & ((data | 0x20) <= ord("z"))
    inside = np.zeros(len(data), bool)
    inside[1:] = letter[1:] & letter[:-1]
    inside[at[:-1][np.diff(at) > 0]] = False
    return first & ~inside, first


def markers_in(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The markers that lie inside one text: their places, their texts and which marker each is."""
    if len(data) < 3:
        return (np.zeros(0, np.int64),) * 3
    place = np.flatnonzero((data[:-2] == ord("<")) & (data[2:] == ord(">")))
    kind = np.full(256, -1)
    for k, marker in enumerate(MARKERS):
        kind[marker[1]] = k
    which = kind[data[place + 1]]
    text = np.searchsorted(at, place, side="right") - 1
    good = (which >= 0) & (place + 3 <= at[text + 1])
    return place[good], text[good], which[good]


def targets(sizes: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For part sizes (texts x 3): where the outputs begin, and where parts and markers go (-1: no marker)."""
    marked = form > 0
    out_at = np.concatenate([[0], np.cumsum(sizes.sum(axis=1) + 9 * marked)])
    base = out_at[:-1]
    part = base[:, None] + np.cumsum(sizes, axis=1) - sizes
    marker = np.full(sizes.shape, -1, np.int64)
    for number, order in ORDERS.items():
        rows = np.flatnonzero(form == number)
        cursor = base[rows].copy()
        for p in order:
            marker[rows, p], part[rows, p] = cursor, cursor + 3
            cursor = cursor + 3 + sizes[rows, p]
    return out_at, part, marker


def shift_windows(sizes: np.ndarray, part: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Windows of text bytes: where each begins and the place in the outputs of all of its bytes."""
    length = sizes.ravel()
    begin = np.cumsum(length) - length
    full = length > 0
    begin, shift = begin[full], part.ravel()[full] - begin[full]
    step = np.diff(shift, prepend=0)
    total, carry = int(length.sum()), 0
    for a in range(0, total, WINDOW):
        moved = np.zeros(min(WINDOW, total - a), np.int64)
        low, high = np.searchsorted(begin, [a, a + len(moved)])
        moved[begin[low:high] - a] = step[low:high]
        moved[0] += carry
        np.cumsum(moved, out=moved)
        carry = int(moved[-1])
        moved += np.arange(a, a + len(moved))
        yield a, moved


def scatter(data: np.ndarray, sizes: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The outputs of texts whose parts have these sizes, as bytes and offsets."""
    out_at, part, marker = targets(sizes, form)
    out = np.empty(out_at[-1], np.uint8)
    for a, to in shift_windows(sizes, part):
        out[to] = data[a : a + len(to)]
    for p, text in enumerate(MARKERS):
        at = marker[:, p]
        at = at[at >= 0]
        for k in range(3):
            out[at + k] = text[k]
    return out, out_at


def gather(out: np.ndarray, out_at: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of outputs, as bytes and offsets, from the markers of each that is not plain."""
    rows = len(form)
    place, text, which = markers_in(out, out_at)
    keep = form[text] > 0
    found = np.full((rows, 3), -1, np.int64)
    # A part holds no marker, so there is one of each; an output without them is refused.
    found[text[keep], which[keep]] = place[keep]
    if np.any(found[form > 0] < 0) or keep.sum() != 3 * np.count_nonzero(form):
        raise ValueError("an output that is not plain must have each marker once")
    sizes = np.zeros((rows, 3), np.int64)
    plain = form == 0
    sizes[plain, 0] = np.diff(out_at)[plain]
    for number, order in ORDERS.items():
        own = np.flatnonzero(form == number)
        ends = [*[found[own, p] for p in order[1:]], out_at[own + 1]]
        for p, end in zip(order, ends, strict=True):
            sizes[own, p] = end - found[own, p] - 3
    _, part, _ = targets(sizes, form)
    at = np.concatenate([[0], np.cumsum(sizes.sum(axis=1))])
    data = np.empty(at[-1], np.uint8)
    for a, place in shift_windows(sizes, part):
        data[a : a + len(place)] = out[place]
    return data, at


def cut(data: np.ndarray, at: np.ndarray, draws: Sequence[np.ndarray], plain: int, spm: int) -> dict[str, np.ndarray]:
    """Tokens, form, part sizes in bytes and prefix and middle in code points of each text."""
    starts, first = token_starts(data, at)
    before = count_before(starts, at)
    n = np.diff(before)
    h1, h2, h3, h4 = draws
    cuts = np.sort(np.stack([h1 % (n + 1), h2 % (n + 1)], axis=1), axis=1)
    form = np.where(h4 % 100 < spm, 2, 1)
    form[(n == 0) | (h3 % 100 >= 100 - plain)] = 0
    form[markers_in(data, at)[1]] = 0
    # The token after a text's last one begins where the next text does.
    edges = place_of(starts, (before[:-1, None] + cuts).ravel()).reshape(-1, 2)
    edges = np.concatenate([at[:-1, None], edges, at[1:, None]], axis=1)
    # An empty text has no token of its own to look up.
    edges[n == 0] = at[:-1][n == 0, None]
    chars = np.diff(count_before(first, edges.ravel()).reshape(-1, 4), axis=1)
    sizes = np.diff(edges, axis=1)
    return {"n": n, "form": form, "sizes": sizes, "prefix_chars": chars[:, 0], "middle_chars": chars[:, 1]}


def draws(doc_id: str = "doc_id", seed: int = SEED) -> list[Column]:
    """The four numbers that decide about a text: 8 hex digits each of the sha256 of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"_h{k + 1}") for k in range(4)]


def _transform(batches: Iterator[pa.RecordBatch], plain: int, spm: int) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, STEP_BYTES):
        data, at = bytes_of(batch.column("text"))
        hashes = [batch.column(f"_h{k}").to_numpy(zero_copy_only=False) for k in (1, 2, 3, 4)]
        made = cut(data, at, hashes, plain, spm)
        out, out_at = scatter(data, made["sizes"], made["form"])
        uncut = pa.array(made["form"] == 0)
        columns = {
            "doc_id": batch.column("doc_id"),
            "n": pa.array(made["n"]),
            "form": pa.array(FORMS).take(pa.array(made["form"])),
            **{c: pc.if_else(uncut, None, pa.array(made[c])) for c in ("prefix_chars", "middle_chars")},
            "output": strings_of(out, out_at),
        }
        yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def transform(docs: DataFrame, plain: int = PLAIN, spm: int = SPM, seed: int = SEED) -> DataFrame:
    """doc_id, n (tokens), form, prefix_chars, middle_chars and output of each whole text of ``docs``.

    A null or empty text is plain and empty, as is one that holds a marker plain; a missing doc_id draws
    as an empty one. Repeated rows are transformed alike. Other columns are ignored. One row in, one out,
    without a shuffle: a lost executor costs its tasks.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *draws("doc_id", seed))
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(lambda it: _transform(it, plain, spm), schema)


def _restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches, STEP_BYTES, "output"):
        out, out_at = bytes_of(batch.column("output"))
        form = pc.index_in(batch.column("form"), pa.array(FORMS))
        data, at = gather(out, out_at, pc.fill_null(form, 0).to_numpy(zero_copy_only=False))
        yield pa.RecordBatch.from_arrays([*batch.columns, strings_of(data, at)], names=[*batch.schema.names, "restored"])


def restore(rows: DataFrame) -> DataFrame:
    """``rows`` of ``transform`` with ``restored``, the text that output and form alone give back."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(_restore, f"{kinds}, restored string")
