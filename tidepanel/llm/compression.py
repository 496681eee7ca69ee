"""Compression classifier: two zstandard dictionaries, built from good and from bad labelled text.

A text is compressed whole with each dictionary. The difference of the two compressed sizes per byte
of text, with the sizes themselves, goes through a logistic calibration fitted on labelled texts that
the dictionaries have not seen.

The fit uses a bounded sample (``SAMPLE`` rows a class, by a hash of the id, of texts up to
``SAMPLE_CHARS`` code points); scoring has no bound on anything.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.text import held_out, steps

#: Labelled rows of each class that the fit uses at most.
SAMPLE = 2000
#: Longest text that the sample takes; longer labelled texts are left to the rest of the sample.
SAMPLE_CHARS = 20_000
DICTIONARY_BYTES = 112 << 10
LEVEL = 3


class Model(NamedTuple):
    good: bytes
    bad: bytes
    weights: tuple[float, ...]
    prior: float


def sizes(texts: list[str | None], dictionaries: tuple[bytes, ...]) -> np.ndarray:
    """Row per text: its bytes, then its compressed size with each dictionary."""
    tools = []
    for content in dictionaries:
        data = zstandard.ZstdCompressionDict(content)
        data.precompute_compress(level=LEVEL)
        tools.append(zstandard.ZstdCompressor(dict_data=data, write_content_size=False, write_checksum=False))
    out = np.zeros((len(texts), 1 + len(tools)))
    for i, text in enumerate(texts):
        raw = (text or "").encode("utf-8", "surrogatepass")
        out[i, 0] = len(raw)
        for k, tool in enumerate(tools):
            out[i, k + 1] = len(tool.compress(raw)) if raw else 0
    return out


def _features(size: np.ndarray) -> np.ndarray:
    n = np.maximum(size[:, 0], 1.0)
    good, bad = size[:, 1] / n, size[:, 2] / n
    gap = (bad - good) / np.maximum(bad + good, 1e-9)
    length = np.log1p(n)
    return np.stack([np.ones(len(n)), gap, good, bad, good * good, good * length / 10, length / 10, gap * length / 10], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression with a small ridge, by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - p)) - 1e-2 * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _dictionary(texts: list[str]) -> bytes:
    """The passages that the whole texts share most, or the texts themselves where they are few."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, raw, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"\n".join(raw)[-DICTIONARY_BYTES:].rjust(8, b"\n")


def sample_labelled(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[list[tuple[str, int]], float]:
    """At most ``per_class`` (text, label) rows of each class, by a hash of the id, and the share of label 1.

    ``labels`` has doc_id and the label (0 or 1; other values and missing ids are ignored).
    """
    clean = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("label in (0, 1) and doc_id is not null")
    counts = {r["label"]: r["n"] for r in clean.groupBy("label").agg(F.count("*").alias("n")).collect()}
    rows: list[tuple[str, int]] = []
    for value in (0, 1):
        # Hash order first on the ids alone; texts are fetched for a bounded number of them.
        ids = clean.filter(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
        texts = texts.filter((F.length("text") > 0) & (F.length("text") <= SAMPLE_CHARS))
        got = texts.select(F.xxhash64("doc_id").alias("h"), "doc_id", "text").limit(2 * per_class).collect()
        rows += [(r["text"], value) for r in sorted(got, key=lambda r: (r["h"], r["doc_id"], r["text"]))]
    total = sum(counts.values())
    return rows, (counts.get(1, 0) + 1) / (total + 2)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_class: int = SAMPLE) -> Model:
    """Dictionaries from one half of the sample, calibration from the other.

    Without labelled text, or with one class only, every score is the smoothed share of label 1.
    """
    rows, prior = sample_labelled(docs, labels, label, per_class)
    parts = {v: [t for t, y in rows if y == v] for v in (0, 1)}
    build = {v: parts[v][0::2] for v in parts}
    rest = [(t, v) for v in (0, 1) for t in parts[v][1::2]]
    good, bad = _dictionary(build[1]), _dictionary(build[0])
    y = np.array([v for _, v in rest], float)
    if not len(y) or y.min() == y.max():
        return Model(good, bad, (), prior)
    share = y.mean()
    # The sample is even by class; the weights bring back the share of the classes among the labels.
    weight = np.where(y == 1, prior / share, (1 - prior) / (1 - share))
    x = _features(sizes([t for t, _ in rest], (good, bad)))
    return Model(good, bad, tuple(_logistic(x, y, weight)), prior)


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        size = sizes(batch.column("text").to_pylist(), (model.good, model.bad))
        score = np.full(len(size), model.prior)
        if model.weights:
            full = size[:, 0] > 0
            z = _features(size[full]) @ np.array(model.weights)
            score[full] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0 to 1) for every row. A null or empty text gets the share of label 1."""
    return docs.select("doc_id", "text").mapInArrow(lambda it: _score(it, model), "doc_id long, score double")


def _accepted(batches: Iterator[pa.RecordBatch], model: Model, least: float) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        pieces = _score(iter([batch.select(["doc_id", "text"])]), model)
        score = np.concatenate([piece.column("score").to_numpy() for piece in pieces])
        yield batch.filter(pa.array(score >= least))


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a score of at least ``least``, all columns kept, in one pass."""
    return docs.mapInArrow(lambda it: _accepted(it, model, least), docs.schema)


def training_rows(labels: DataFrame, out: Column) -> DataFrame:
    return labels.filter(~out)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", of: int = 3, remainder: int = 1) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted. Labels of held-out ids are never read.

    Held out is an id whose crc32 (as text) leaves ``remainder``; a missing id is not. Rows may
    repeat and are scored one by one; further columns are ignored; no rows give no rows.
    """
    model = fit(docs, training_rows(labels, held_out("doc_id", of, remainder)), label)
    scored = scores(docs, model)
    return scored.select(
        "doc_id", held_out("doc_id", of, remainder).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
