"""Toxic terms, misspelled ones included, weighed by their context.

* The lexicon is a trie of terms learned from labelled texts: words far more frequent in toxic
  texts than in others, next to terms the caller names.
* A Levenshtein automaton for one edit (insert, delete, replace), intersected with the trie, is
  made into one deterministic table. All distinct words of a batch walk it together, one character
  a step, and leave it as soon as no term can match.
* Each hit is looked at in a window of words: quotation marks and reporting words speak for a
  quotation, direct address and shouting for abuse. The share of each kind of hit, with how pure
  its term was in training, goes through a logistic calibration.

Fitting uses a bounded sample of labelled rows (``SAMPLE`` a class); scoring has no bound.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.compression import _logistic, sample_labelled
from tidepanel.llm.text import LOOKUP_BYTES, held_out, steps, whole, words_of

#: Labelled rows of each class that the fit uses at most.
SAMPLE = 3000
#: Terms that the lexicon holds at most, the purest and most frequent first.
TERMS = 400
#: Shortest word that becomes a term, and shortest term that may be misspelled.
SHORTEST, FUZZY_FROM = 4, 5
#: Words on either side of a hit that its context score looks at.
WINDOW = 6

# Characters stripped from the ends of a word.
EDGES = ".,;:!?\"'()[]{}<>«»„“”‘’‚‹›…·-–—*#$%&|~_+=/\\@^`"
# Quotation marks.
QUOTES = "\"«»„“”‘’‚‹›"
# Words that report what somebody else said, and words that address the reader.
REPORTING = frozenset("said says say called calls quote quoted quotes wrote writes word term sagte schrieb zitat wort dit disait mot citation dijo palabra cita".split())
ADDRESS = frozenset("you your you're youre u ur du dich dein ihr euch tu toi ton vous votre tú tu usted ustedes vosotros".split())


class Automaton(NamedTuple):
    """state x class -> state (0: dead, 1: start); accept: term number + 1 and edits by state."""

    classes: dict[str, int]
    step: np.ndarray
    term: np.ndarray
    edits: np.ndarray
    longest: int


def automaton(terms: Sequence[str], fuzzy_from: int = FUZZY_FROM) -> Automaton:
    """The one-edit Levenshtein automaton of all terms at once, over their trie, as a table."""
    trie: list[dict[str, int]] = [{}]
    ends: dict[int, int] = {}
    # Per node: whether a term long enough to be misspelled lies below it.
    below: list[bool] = [False]
    for number, term in enumerate(terms):
        node = 0
        below[0] |= len(term) >= fuzzy_from
        for char in term:
            if char not in trie[node]:
                trie[node][char] = len(trie)
                trie.append({})
                below.append(False)
            node = trie[node][char]
            below[node] |= len(term) >= fuzzy_from
        ends[node] = number

    def closed(places: set[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        """With what deleting a character of the term reaches."""
        more = {(child, 1) for node, edit in places if not edit for child in trie[node].values() if below[child]}
        both = places | more
        return frozenset(p for p in both if not (p[1] and (p[0], 0) in both))

    classes = {char: i + 1 for i, char in enumerate(sorted({c for t in terms for c in t}))}
    start = closed({(0, 0)})
    numbers = {frozenset(): 0, start: 1}
    queue, step = [start], {0: [0] * (len(classes) + 1)}
    while queue:
        state = queue.pop()
        row = []
        for char in ["", *classes]:
            after: set[tuple[int, int]] = set()
            for node, edit in state:
                if char in trie[node]:
                    after.add((trie[node][char], edit))
                if not edit and below[node]:
                    after.add((node, 1))
                    after |= {(child, 1) for child in trie[node].values() if below[child]}
            after_closed = closed(after)
            if after_closed not in numbers:
                numbers[after_closed] = len(numbers)
                queue.append(after_closed)
            row.append(numbers[after_closed])
        step[numbers[state]] = row
    term, edits = np.zeros(len(numbers), np.int32), np.zeros(len(numbers), np.int8)
    for state, number in numbers.items():
        found = [(e, ends[n]) for n, e in state if n in ends and (not e or len(terms[ends[n]]) >= fuzzy_from)]
        if found:
            e, t = min(found)
            term[number], edits[number] = t + 1, e
    table = np.array([step[i] for i in range(len(numbers))], np.int32)
    return Automaton(classes, table, term, edits, max(map(len, terms), default=0) + 1)


def matches(words: list[str], dfa: Automaton) -> tuple[np.ndarray, np.ndarray]:
    """For each word the matched term's number + 1 (0: none) and its edits."""
    term, edits = np.zeros(len(words), np.int32), np.zeros(len(words), np.int8)
    fit_length = np.array([SHORTEST - 1 <= len(w) <= dfa.longest for w in words], bool)
    alive = np.flatnonzero(fit_length)
    if not len(alive):
        return term, edits
    table = np.zeros(0x110000, np.int32)
    for char, number in dfa.classes.items():
        table[ord(char)] = number
    chosen = [words[i] for i in alive]
    points = table[np.frombuffer("".join(chosen).encode("utf-32-le", "surrogatepass"), np.uint32)]
    size = np.array([len(w) for w in chosen])
    begin = np.concatenate([[0], np.cumsum(size)[:-1]])
    state = np.ones(len(alive), np.int32)
    for i in range(dfa.longest):
        done = size == i
        if done.any():
            term[alive[done]], edits[alive[done]] = dfa.term[state[done]], dfa.edits[state[done]]
        state = np.where(done, 0, dfa.step[state, points[np.minimum(begin + i, len(points) - 1)]])
        live = state > 0
        alive, size, begin, state = alive[live], size[live], begin[live], state[live]
        if not len(alive):
            return term, edits
    done = size == dfa.longest
    term[alive[done]], edits[alive[done]] = dfa.term[state[done]], dfa.edits[state[done]]
    return term, edits


class Model(NamedTuple):
    dfa: Automaton
    terms: tuple[str, ...]
    purity: tuple[float, ...]
    weights: tuple[float, ...]
    prior: float


def quoted(words: Sequence[str], at: int, window: int = WINDOW) -> float:
    """Between 0 (abuse) and 1 (quotation): what the words around a hit say."""
    low, high = max(0, at - window), min(len(words), at + window + 1)
    score = 0.5
    word = words[at]
    before = sum(w[:1] in QUOTES for w in words[low : at + 1]) - sum(w.rstrip(".,;:!?")[-1:] in QUOTES for w in words[low:at])
    after = any(w.rstrip(".,;:!?")[-1:] in QUOTES for w in words[at:high] if w)
    if before > 0 and after or word[:1] in QUOTES and word.rstrip(".,;:!?")[-1:] in QUOTES:
        score += 0.3
    around = {w.strip(EDGES).lower() for w in words[low:high]}
    score += 0.2 * bool(around & REPORTING)
    score -= 0.2 * bool(around & ADDRESS)
    score -= 0.2 * any("!" in w for w in words[at:high])
    score -= 0.1 * (len(word) > 2 and word.isupper())
    return min(1.0, max(0.0, score))


FEATURES = 7


def _features(texts: pa.Array, dfa: Automaton, purity: np.ndarray) -> np.ndarray:
    """Per text: constant, purest exact and misspelled hit, weighed hits, quoted hits, density."""
    words, starts = words_of(texts)
    out = np.zeros((len(starts) - 1, FEATURES))
    out[:, 0] = 1
    if not len(words) or not len(purity):
        return out
    coded = words.dictionary_encode()
    bare = pc.utf8_trim(pc.utf8_lower(coded.dictionary), EDGES).to_pylist()
    term, edits = matches(bare, dfa)
    index = coded.indices.to_numpy()
    hits = np.flatnonzero(term[index])
    total = np.diff(starts)
    owner = np.searchsorted(starts, hits, side="right") - 1
    for doc in np.unique(owner):
        low, high = int(starts[doc]), int(starts[doc + 1])
        places = hits[owner == doc] if len(hits) < 64 else hits[np.searchsorted(owner, doc) : np.searchsorted(owner, doc, "right")]
        exact = fuzzy = weighed = cited = 0.0
        for place in places.tolist():
            # The window alone is made into Python strings, whatever the text's length.
            a, b = max(low, place - WINDOW), min(high, place + WINDOW + 1)
            around = words.slice(a, b - a).to_pylist()
            share = purity[term[index[place]] - 1]
            cite = quoted(around, place - a)
            weighed += share * (1 - cite)
            cited += share * cite
            if edits[index[place]]:
                fuzzy = max(fuzzy, share * (1.5 - cite))
            else:
                exact = max(exact, share * (1.5 - cite))
        out[doc, 1:] = exact, fuzzy, np.log1p(weighed), np.log1p(cited), np.log1p(1000 * weighed / total[doc]), np.log1p(total[doc]) / 10
    return out


def learn_terms(rows: list[tuple[str, int]], prior: float, named: Sequence[str] = ()) -> tuple[list[str], list[float]]:
    """Terms and their purity: the smoothed share of toxic texts among those that have the term."""
    seen: dict[int, Counter] = defaultdict(Counter)
    texts = Counter(y for _, y in rows)
    for text, y in rows:
        seen[y].update({w for w in {x.strip(EDGES).lower() for x in text.split()} if len(w) >= SHORTEST})
    # The sample is even by class; rates are weighed back to the share of the classes.
    found = []
    for word, n in seen[1].items():
        rate = [seen[y][word] / max(1, texts[y]) for y in (0, 1)]
        lift = (rate[1] + 0.2 / max(1, texts[1])) / (rate[0] + 0.6 / max(1, texts[0]))
        if n >= max(4, 0.004 * texts[1]) and lift >= 8:
            share = lift * prior / (lift * prior + 1 - prior)
            found.append((share, n, word))
    found.sort(reverse=True)
    terms = {word: share for share, _, word in found[:TERMS]}
    for word in named:
        terms.setdefault(word.lower(), 0.5)
    return list(terms), list(terms.values())


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", named: Sequence[str] = (), per_class: int = SAMPLE) -> Model:
    """Learn terms from one half of the sample and the calibration from the other.

    Without both classes among the labels every score is the smoothed share of label 1.
    """
    rows, prior = sample_labelled(docs, labels, label, per_class)
    by = {v: [r for r in rows if r[1] == v] for v in (0, 1)}
    terms, purity = learn_terms(by[0][0::2] + by[1][0::2], prior, named)
    dfa = automaton(terms)
    rest = by[0][1::2] + by[1][1::2]
    y = np.array([v for _, v in rest], float)
    if not len(y) or y.min() == y.max():
        return Model(dfa, tuple(terms), tuple(purity), (), prior)
    share = y.mean()
    weight = np.where(y == 1, prior / share, (1 - prior) / (1 - share))
    x = _features(pa.array([t for t, _ in rest]), dfa, np.array(purity))
    return Model(dfa, tuple(terms), tuple(purity), tuple(_logistic(x, y, weight)), prior)


def _score(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    dfa, purity = model.dfa, np.array(model.purity)
    for batch in steps(batches, LOOKUP_BYTES):
        x = _features(whole(batch.column("text")), dfa, purity)
        score = np.full(len(x), model.prior)
        if model.weights:
            score = 1 / (1 + np.exp(-np.clip(x @ np.array(model.weights), -30, 30)))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", of: int = 5, remainder: int = 0) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted. Labels of held-out ids are never read.

    Held out is an id whose crc32 (as text) leaves ``remainder``; a missing id is not. A text that
    is null or has no words is scored as one without hits. Rows may repeat and are scored one by
    one; further columns are ignored; no rows give no rows.
    """
    out = held_out("doc_id", of, remainder)
    model = fit(docs, labels.filter(~out), label)
    # Its size is bounded by TERMS and the terms' length, whatever the corpus.
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = docs.select("doc_id", "text").mapInArrow(lambda it: _score(it, shared.value), "doc_id long, score double")
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
