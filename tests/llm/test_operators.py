"""Each operator against brute force or a round trip, and on awkward rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidepanel.llm import (
    brown,
    components,
    compression,
    decontaminate,
    merge_dropout,
    minhash,
    substring,
    toxicity,
    url_tree,
    wavelet,
    weak_rules,
)
from tidepanel.llm.text import hot_limit, join_one

SCHEMA = "doc_id long, text string, told string, n_words int, bands string, d string, _d int, row string"
WORDS = [f"w{i}" for i in range(200)]
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("word_bpe_49k.json")


def text_of(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] for i in rng.integers(0, len(WORDS), n))


def awkward_rows() -> list[tuple]:
    shared, long_text = text_of(1, 40), text_of(2, 6000)
    texts = [
        shared, shared, shared.replace("w1 ", "x1 "), text_of(3, 30) + "\n" + shared, None, "", " \t\n", "one", "one",
        long_text, long_text + " end", text_of(4, 19), text_of(5, 60) + " " + text_of(5, 60), "Ä é ▁ \U0001f600 it's <|endoftext|>",
    ]
    rows = [(i, t) for i, t in enumerate(texts)]
    # A repeated row, and a row without an id.
    rows += [(3, texts[3]), (None, text_of(6, 25))]
    return [(i, t, "x", 5, "y", "z", 1, "r") for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, (i + 1) % 2) for i in range(14)] + [(None, 1, 1), (3, None, None), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_minhash_equals_brute_force(docs, empty):
    for size in (2, 5):
        sets = defaultdict(set)
        for i, t, *_ in awkward_rows():
            w = (t or "").encode().lower().split()
            own = {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} - {()}
            sets[i] = own
        parent = {i: i for i in sets if i is not None}
        for a in parent:
            for b in parent:
                both = sets[a] | sets[b]
                if a < b and both and 100 * len(sets[a] & sets[b]) >= 80 * len(both):
                    low, high = sorted((parent[a], parent[b]))
                    parent = {k: low if v == high else v for k, v in parent.items()}
        found = minhash.near_duplicates(docs, size).collect()
        assert len(found) == len(awkward_rows())
        for r in found:
            assert r.n_shingles == len(sets[r.doc_id])
            assert r.component_id == (parent[r.doc_id] if r.doc_id is not None else None)
            assert r.kept == (r.doc_id is None or r.doc_id == r.component_id)
    assert minhash.near_duplicates(empty).count() == 0


def test_open_group_links_through_members(spark):
    """Copies that the centre does not reach are still found, through each other."""
    base = text_of(7, 100).split()
    rows = [(i, " ".join([*base[:40], *[f"c{i}x{k}" for k in range(7)], *base[47:]])) for i in range(30)]
    edited = [*base[:20], *[f"s{k}" for k in range(16)], *base[36:]]
    rows += [(100 + i, " ".join([*edited, f"tail{i}"])) for i in range(5)]
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    assert {found[100 + i] for i in range(5)} == {100}


def test_components_of_a_chain(spark):
    edges = [(i, i + 1) for i in range(40)] + [(50, 51), (51, 50), (7, 7), (None, 3)]
    found = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {**dict.fromkeys(range(41), 0), 50: 50, 51: 50}


def test_repeats_equal_brute_force(docs, empty):
    order = sorted({(i, t) for i, t, *_ in awkward_rows()}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, want = set(), {}
    for i, t in order:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for a in range(len(w) - 19):
            window = tuple(w[a : a + 20])
            if window in seen:
                gone[a : a + 20] = [True] * 20
            seen.add(window)
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        want[i] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    found = substring.remove_repeats(docs).collect()
    assert len(found) == len(awkward_rows())
    assert all((r.n_words, r.n_removed, r.kept_sha256) == want[r.doc_id] for r in found)
    whole = substring.without_repeats(docs)
    assert whole.columns == docs.columns and whole.count() == docs.count()
    assert substring.remove_repeats(empty).count() == 0


def test_repeats_of_one_frequent_phrase_are_split(spark, monkeypatch):
    monkeypatch.setattr(substring, "SHARD_WORDS", 500)
    rng, phrase = np.random.default_rng(4), " ".join(f"p{i}" for i in range(8))
    # Ever different surroundings of a phrase, copies of a passage with small edits, and some true repeats.
    passage = [f"q{i}" for i in range(40)]
    texts = []
    for i in range(150):
        edited = [f"e{rng.integers(0, 9)}" if j in (i % 40, i * 7 % 40) else x for j, x in enumerate(passage)]
        sides = [" ".join(f"w{x}" for x in rng.integers(0, 3, 16)) for _ in range(2)]
        texts.append(f"{sides[0]} {phrase} {sides[1]} {' '.join(edited)}")
    texts += [texts[7] + " end", "start " + texts[30]]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    seen, want = set(), {}
    for i, t in enumerate(texts):
        w, windows = t.split(), [tuple(t.split()[a : a + 20]) for a in range(len(t.split()) - 19)]
        gone = {a + k for a, x in enumerate(windows) for k in range(20) if x in seen or x in windows[:a]}
        seen |= set(windows)
        want[i] = hashlib.sha256(" ".join(x for a, x in enumerate(w) if a not in gone).encode()).hexdigest()
    assert {r.doc_id: r.kept_sha256 for r in substring.remove_repeats(rows).collect()} == want

    cut = []
    for d, t in enumerate(texts):
        w = t.split()
        for a, n, key in zip(*substring.segments(substring.word_hashes(pa.array(w)), 20, 8), strict=True):
            part = " ".join(w[a : a + n + 19])
            cut.append((int(key.view(np.int64)), zlib.crc32(part.encode()), d, 0, 0, int(a), int(n), part))
    size = Counter()
    for c in cut:
        size[c[0]] += c[6] + 20
    assert max(size.values()) > 1500
    entry, _ = substring.entries(spark.createDataFrame(cut, substring.CUT), 20, 8)
    sums = entry.groupBy("shard_key").agg(F.sum(F.col("windows") + 20).alias("n")).collect()
    assert all(r.n <= 500 for r in sums)


def test_index_finds_every_earlier_window():
    rng = np.random.default_rng(3)
    texts = [rng.integers(1, 4, int(n)) for n in rng.integers(8, 30, 60)]
    order = np.arange(sum(len(t) + 1 for t in texts))
    seen, at = {}, 0
    found = substring.repeated_windows(texts, order, 6)
    for t, hits in zip(texts, found, strict=True):
        want = []
        for a in range(len(t) - 5):
            if seen.setdefault(tuple(t[a : a + 6]), at + a) < at + a:
                want.append(a)
        assert hits.tolist() == want
        at += len(t) + 1


def test_decontamination_tolerates_substitutions(spark, docs, empty):
    item = text_of(11, 40)
    changed = item.split()
    changed[5] = changed[17] = changed[29] = "other"
    rows = [(1, item), (2, text_of(12, 50) + " " + " ".join(changed)), (3, text_of(13, 300)), (4, None), (None, item), (5, "w1 w2")]
    bench = spark.createDataFrame([(7, item), (8, None), (9, "too short"), (None, "")], "item_id long, text string")
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.contaminated, r.first_item) for r in decontaminate.contamination(frame, bench).collect()}
    assert found == {1: (True, 7), 2: (True, 7), 3: (False, None), 4: (False, None), None: (True, 7), 5: (False, None)}
    assert {r.doc_id for r in decontaminate.without_contaminated(frame, bench).collect()} == {3, 4, 5}
    clean = decontaminate.without_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    assert decontaminate.contamination(empty, bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).filter("contaminated").count() == 0


def test_wavelet_matrix_access_count_select():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 300, 5000)
    matrix = wavelet.WaveletMatrix(wavelet.write_blob(ids))
    assert (matrix.all() == ids).all()
    assert [matrix.access(i) for i in range(0, 5000, 97)] == ids[::97].tolist()
    assert matrix.count(7) == (ids == 7).sum() and matrix.count(7, 100, 900) == (ids[100:900] == 7).sum()
    assert [matrix.select(7, k) for k in range(matrix.count(7))] == np.flatnonzero(ids == 7).tolist()
    assert matrix.count(1000) == 0
    for n in (0, 1):
        assert wavelet.WaveletMatrix(wavelet.write_blob(ids[:n])).all().tolist() == ids[:n].tolist()


def test_token_files_round_trip(docs, empty):
    tool = Tokenizer.from_file(BPE)
    found = wavelet.encode_and_read(docs, BPE, shard_ids=1000).collect()
    start = 0
    rows = sorted(((i, t) for i, t, *_ in awkward_rows()), key=lambda r: (r[0] is not None, r[0] or 0))
    for (i, t), r in zip(rows, sorted(found, key=lambda r: r.start), strict=True):
        ids = np.array([*tool.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (i, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert wavelet.encode_and_read(empty, BPE).count() == 0


def test_brown_base_and_distribution(docs, empty):
    def out(i):
        return i is not None and zlib.crc32(str(i).encode()) % 7 == 2

    rows = [(i, (t or "").encode().lower().split()) for i, t, *_ in awkward_rows()]
    c = Counter(x for i, w in rows if not out(i) for x in [*w, None])
    n, v = sum(c.values()), len(c)
    found = defaultdict(list)
    for r in brown.score(docs, block_words=3000).collect():
        found[r.doc_id].append(r)
    for i, w in rows:
        r = found[i][0]
        base = sum(log10((c[x] + 1) / (n + v + 1)) for x in [*w, None])
        assert r.base_score == pytest.approx(base) and r.held_out == out(i) and r.train_tokens == n
        assert (r.n_tokens, r.n_known) == (len(w) + 1, sum(c[x] > 0 for x in [*w, None])) and r.score < 0
    assert brown.score(empty).count() == 0
    blank = docs.sparkSession.createDataFrame([(1, ""), (2, None), (2, " \n")], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_tokens) for r in brown.score(blank).collect()) == [(1, 1), (2, 1), (2, 1)]


def numbered_lines(spark, lines, block_words=500):
    """Blocks of the lines with a slot for every word in order of its name, as one bucket of an even and one of an odd name."""
    vocabulary = sorted({w for line in lines for w in line})
    size = (len(vocabulary) + 1) // 2
    slot = {w: i % 2 * size + i // 2 for i, w in enumerate(vocabulary)}
    c = Counter(w for line in lines for w in line)
    docs = [(i, False, " ".join(line)) for i, line in enumerate(lines)]
    rows = spark.createDataFrame(docs, "doc_id long, held boolean, text string").repartition(3)
    blocks = rows.mapInArrow(lambda it: brown._blocks(it, block_words), brown.BLOCKS)

    def found(words):
        places = [slot[w] % size if slot[w] // size == b else None for b in range(2) for w in words]
        cells = []
        for b in range(2):
            here = [(at, p) for at, p in enumerate(places[b * len(words) : (b + 1) * len(words)]) if p is not None]
            at, place = (np.array([h[k] for h in here], t) for k, t in ((0, np.uint32), (1, np.int32)))
            n = np.array([c[words[i]] for i in at], np.int64)
            cells.append((b, brown._packed(at), brown._packed(place), brown._packed(n)))
        return cells

    told = F.udf(found, "array<struct<bucket: long, at: binary, place: binary, c: binary>>")("words")
    blocks = blocks.withColumn("found", told)
    return blocks.mapInArrow(lambda it: brown._numbered(it, size, 2 * size), brown.NUMBERED).cache(), slot, size


def class_table(lines, slot, of, last):
    table, end = np.zeros((last, last)), len(of) - 1
    for line in lines:
        units = [end, *(slot[w] for w in line), end]
        for x, y in zip(units, units[1:], strict=False):
            table[of[x], of[y]] += 1
    return table


def test_cluster_counts_class_pairs_and_raises_the_likelihood(spark, monkeypatch):
    rng = np.random.default_rng(2)
    # Words of two kinds take turns, some twice in a row; the first word is by far the most frequent.
    lines = []
    for _ in range(120):
        line = [f"{'ab'[j % 2]}{int(rng.integers(0, 40) * rng.integers(0, 2)):02}" for j in range(60)]
        lines.append([w for w in line for _ in range(1 + (w == "a07"))])
    numbered, slot, size = numbered_lines(spark, lines)
    monkeypatch.setattr(brown, "CLASSES", 2)
    of, table = brown.cluster(numbered, len(slot), size, 2)
    last = len(table)
    assert (table == class_table(lines, slot, of, last)).all()
    first = of.copy()
    first[: 2 * size] = np.arange(2 * size) % size % 2

    def likelihood(t):
        return brown._xlogx(t).sum() - brown._xlogx(t.sum(axis=0)).sum() - brown._xlogx(t.sum(axis=1)).sum()

    assert likelihood(table) > likelihood(class_table(lines, slot, first, last))
    kinds = {k: {int(of[i]) for w, i in slot.items() if w[0] == k} for k in "ab"}
    assert len(kinds["a"]) == len(kinds["b"]) == 1 and kinds["a"] != kinds["b"]
    # Words cut into many pieces give the same classes.
    again, pairs = brown.cluster(numbered, len(slot), size, 2, slice_tokens=20)
    assert (again == of).all() and (pairs == table).all()
    pieces = brown.pair_pieces(numbered, size, 2, 20).collect()
    assert max(r.slice for r in pieces) > 20 and {r.part for r in pieces} == {0, 1, 2}
    lists = [tuple(brown._unpacked(r[c], t) for c, t in (("word", np.uint32), ("other", np.uint32), ("n", np.int64))) for r in pieces]
    counted = Counter()
    for r, (word, other, n) in zip(pieces, lists, strict=True):
        for w, o, k in zip(word.tolist(), other.tolist(), n.tolist(), strict=True):
            unit = r.bucket * size + w // 2 * brown.PARTS + r.part
            assert (unit, o, w % 2) not in counted
            counted[unit, o, w % 2] = k
    end = 2 * size + brown.FORMS
    expected = Counter()
    for line in lines:
        units = [end, *(slot[w] for w in line), end]
        for x, y in zip(units, units[1:], strict=False):
            expected[x, y, brown.AFTER] += x != end
            expected[y, x, brown.BEFORE] += y != end
    assert counted == +expected


def test_brown_clusters_every_word_of_five_tokens(spark):
    rng = np.random.default_rng(3)
    # Words of two kinds take turns; of 3000 words none has 1 / 2048 of the tokens by much, and most far less.
    texts = [" ".join(f"{'ab'[j % 2]}{rng.integers(0, 1500)}" for j in range(100)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    c = Counter(w for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2 for w in t.split())
    rows = docs.select("doc_id", brown.held_out("doc_id", 7, 2).alias("held"), "text")
    blocks = rows.mapInArrow(lambda it: brown._blocks(it, 5000), brown.BLOCKS).cache()
    model, numbered = brown.fit(blocks)
    clustered, forms, often = set(), len(model.of) - 1 - brown.FORMS, {}
    for r in numbered.collect():
        units, n = brown._unpacked(r.units, np.uint32), brown._unpacked(r.counts, np.int64)
        assert ((units < forms) == (n >= brown.MIN_COUNT)).all()
        clustered |= set(units[units < forms].tolist())
        often |= dict(zip(units[units < forms].tolist(), n[units < forms].tolist(), strict=True))
    assert len(clustered) == sum(n >= brown.MIN_COUNT for n in c.values()) > 2000
    assert model.class_tokens.sum() == model.tokens
    # Probabilities sum to one: of classes behind each class, of the words of a class, of a form's words and its unknown one.
    assert (10**model.transition).sum(axis=1) == pytest.approx(np.ones(len(model.transition)))
    share = np.zeros(len(model.class_tokens))
    for unit, n in often.items():
        share[model.of[unit]] += n / model.class_tokens[model.of[unit]]
    assert share[share > 0] == pytest.approx(np.ones((share > 0).sum())) and (share > 0).sum() == brown.CLASSES
    rare = [w for w in c if c[w] < brown.MIN_COUNT]
    form = brown.forms(pa.array(rare))
    left = (np.array([c[w] for w in rare]) - model.discount[form]) / model.form_tokens[form]
    assert np.bincount(form, left, brown.FORMS) + 10**model.unknown == pytest.approx(np.ones(brown.FORMS)) and rare


def test_class_gains_equal_likelihoods(monkeypatch):
    monkeypatch.setattr(brown, "CELLS", 7)
    rng = np.random.default_rng(5)
    pairs = rng.integers(0, 4, (9, 9)).astype(float)
    of = np.array([0, 1, 2, 0, 1, 2, 0, 3, 4])

    def table(of):
        out = np.zeros((5, 5))
        np.add.at(out, (of[:, None], of[None, :]), pairs)
        return out

    def likelihood(t):
        return brown._xlogx(t).sum() - brown._xlogx(t.sum(axis=0)).sum() - brown._xlogx(t.sum(axis=1)).sum()

    after, before = ([pairs[:, of == k].sum(axis=1) for k in range(5)], [pairs[of == k].sum(axis=0) for k in range(5)])
    sums = [(*np.nonzero(x), x[np.nonzero(x)]) for x in (np.array(after).T[:7], np.array(before).T[:7])]
    gains = brown.class_gains(table(of), of[:7], *sums, np.diag(pairs)[:7], 3)
    for w in range(7):
        with_word = [likelihood(table(np.where(np.arange(9) == w, k, of))) for k in range(3)]
        assert np.diff(gains[w]) == pytest.approx(np.diff(with_word))


def test_toxicity_automaton_equals_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    terms = ["idiot", "trash", "scum", "idiots"]
    words = ["idiot", "idiott", "idot", "1diot", "dioti", "trash", "crash", "scum", "scam", "idiots", "idiotsx", "tra", "", "ïdiot"]
    term, edits = toxicity.matches(words, toxicity.automaton(terms))
    for w, t, e in zip(words, term, edits, strict=True):
        best = min((distance(w, x), k) for k, x in enumerate(terms) if len(x) >= toxicity.FUZZY_FROM or w == x)
        assert (t > 0) == (best[0] <= 1) and (not t or e == best[0]), w
    assert toxicity.quoted('he said "idiot" to them'.split(), 2) > 0.5 > toxicity.quoted("you idiot !".split(), 1)


def test_classifiers_score_every_row(docs, labels, empty):
    for module, column in ((compression, "quality"), (toxicity, "toxic")):
        rows = module.classify(docs, labels.select("doc_id", column)).collect()
        assert len(rows) == len(awkward_rows())
        assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
        assert module.classify(docs, labels.limit(0)).count() == len(rows)
        assert module.classify(empty, labels).count() == 0


def test_held_out_accuracy(spark):
    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.1"
    marks = spark.read.parquet(f"{folder}/labels.parquet")
    for name, column, least in (("op7_compression_quality", "quality", 0.95), ("op4_toxicity_automata", "toxic", 0.95)):
        scored = entry.queries()[name](spark, folder).join(marks, "doc_id").filter("held_out")
        assert scored.agg(F.avg((F.col("predicted") == F.col(column)).cast("int"))).first()[0] > least


def test_url_rules_and_templates(spark):
    urls = [
        "http://A.Example.com/en/1?x#y", "https://www.example.com/en/1", "ftp://x.net/es/2", "x.net/es/2", None, "",
        "http://b.com", "http://b.org/de/3/", "http://b.org//3#a?b", "http://example.com/en/", "http://notexample.com/en/",
    ]
    pages = spark.createDataFrame([(i, u, 1, 2) for i, u in enumerate(urls)], "page_id long, url string, host int, template int")
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_tree.judge(pages).collect()}
    assert found[0] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert found[1] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert found[2] == ("x.net", "/es/2", "net/es/", "block")
    assert found[3][:3] == found[4][:3] == found[5][:3] == ("", "", None)
    assert found[6][:3] == ("b.com", "", None) and found[10][2] == "com/"
    many = [(i, f"http://s.org/{'bad' if i % 2 else 'ok'}/p{i}-x", 0, 0) for i in range(200)]
    frame = spark.createDataFrame(many, pages.schema)
    marks = frame.select("page_id", (F.col("page_id") % 2 == 0).cast("int").alias("good"))
    by_path = {(r.path.split("/")[1], r.verdict) for r in url_tree.judge(frame, marks).collect()}
    assert by_path == {("ok", "allow"), ("bad", "block")}
    # Every host and template hot, and no table small enough to broadcast: the same verdicts.
    want = sorted(map(tuple, url_tree.judge(frame, marks).collect()))
    for key, value in (("spark.tidepanel.hotRows", "20"), ("spark.tidepanel.broadcastBytes", "1")):
        spark.conf.set(key, value)
    try:
        assert sorted(map(tuple, url_tree.judge(frame, marks).collect())) == want
    finally:
        spark.conf.unset("spark.tidepanel.hotRows")
        spark.conf.unset("spark.tidepanel.broadcastBytes")
    assert url_tree.judge(pages.limit(0)).count() == 0


def test_weak_rules_equal_brute_force(docs, empty):
    found = weak_rules.judge(docs).collect()
    texts = {i: t or "" for i, t, *_ in awkward_rows()}
    assert len(found) == len(awkward_rows())
    for r in found:
        t = texts[r.doc_id]
        w = t.encode().split()
        lines = [x for x in t.split("\n") if x.encode().split()]
        tri = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        repeats = {k + j for k in range(len(w) - 2) if tri[tuple(w[k : k + 3])] > 1 for j in range(3)}
        want = (len(w), sum(len(x.decode()) for x in w), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)), len(repeats))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (len(w) < 50 or 100 * len(repeats) > 50 * len(w)) and not (r.base_failed and r.kept)
    assert weak_rules.judge(empty).count() == 0


def test_words_are_cut_where_the_library_does_not_join(spark):
    """Every letter and digit before a full stop, and random texts of those that normalizing changes."""
    tool = wavelet.encoder(BPE)

    def same(texts):
        ids, count = tool.encode(pa.array(texts))
        own = np.split(ids, np.cumsum(count)[:-1])
        for text, a, b in zip(texts, tool.tool.encode_batch(texts, add_special_tokens=False), own, strict=True):
            assert a.ids == b.tolist(), text

    letters = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalnum()]
    for i in range(0, len(letters), 20_000):
        same([f"{c}. a{c}, b" for c in letters[i : i + 20_000]])
    rng = np.random.default_rng(0)
    alphabet = [*"aB1.,,*$%&#!?;:()[]_`~|<>@\\/- \u0130\u03a3\u03c2\u0958\u09dc\u0a33\u05e9\u00e9'\u2019\u00a0\n\u0144\u01c5\u1e9e\ufb01\u212b\u2460\u00b2\u2167\uac00\u1100\u1161", "'s"]
    same(["".join(rng.choice(alphabet, rng.integers(1, 14))) for _ in range(20_000)])


def test_long_texts_have_no_false_repeats(spark):
    """Half a million distinct words repeat nothing; a known run of them, repeated, does."""
    words = [f"x{i}" for i in range(500_000)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, *words[100:110]])), (3, "a b c a b c"), (4, "a a a a")]
    found = {r.doc_id: r.n_repeat_words for r in weak_rules.measures(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {1: 0, 2: 20, 3: 6, 4: 4}
    # What decides is the whole hash: the position takes none of its bits.
    plan = weak_rules.measures(spark.createDataFrame(rows[:1], "doc_id long, text string"))._jdf.queryExecution().analyzed().toString()
    assert "shiftright" not in plan


def test_blocks_of_a_centre_are_dealt_by_block(spark, monkeypatch):
    """The exchange before the comparison is by (centre, block), and hot centres, buckets and hubs change nothing."""
    plans, plain = [], minhash.stage

    def watched(frame, tag):
        if tag == "links":
            plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return plain(frame, tag)

    base = text_of(17, 120).split()
    rows = [(i, " ".join([*base[:50], *[f"c{i}x{k}" for k in range(6)], *base[56:]])) for i in range(60)]
    rows += [(100 + i, " ".join([*base[:20], *[f"s{k}" for k in range(20)], *base[40:], f"t{i}"])) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 2).collect()}
    monkeypatch.setattr(minhash, "stage", watched)
    for module in (minhash, components):
        monkeypatch.setattr(module, "hot_limit", lambda rows: 3)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    found = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 2).collect()}
    assert found == wanted
    grouped = [p for p in plans if "FlatMapGroupsInArrow" in p]
    assert grouped and all(re.search(r"Exchange hashpartitioning\(a#\d+L?, x#\d+L?, y#\d+L?", p) for p in grouped)


def test_hot_keys_are_looked_up(spark):
    rows = spark.createDataFrame([(k, i) for k, n in (("hot", 50), ("warm", 3), ("none", 4)) for i in range(n)], "k string, i int")
    table = spark.createDataFrame([("hot", 1.0, 50), ("warm", 2.0, 3), ("other", 3.0, 9)], "k string, w double, n long")
    for limit in (1, 10, 100):
        found = join_one(rows, table, "k", limit)
        assert found.columns == ["k", "i", "w"]
        assert sorted(map(tuple, found.collect())) == sorted([("hot", i, 1.0) for i in range(50)] + [("warm", i, 2.0) for i in range(3)])
    assert hot_limit(10) == 2000 and (1 << 50) // hot_limit(1 << 50) <= 1 << 20


def test_merge_dropout_round_trip(docs, empty):
    rows = merge_dropout.encode(docs, PIECES).collect()
    texts = {i: t or "" for i, t, *_ in awkward_rows()}
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert all(r.lossless and r.decoded == texts[r.doc_id] and library.decode(r.ids) == r.decoded.replace("▁", "▁") for r in rows if "▁" not in r.decoded)
    assert all(r.lossless for r in rows)
    plain = {r.doc_id: r.ids for r in merge_dropout.encode(docs, PIECES, dropout=0.0).collect()}
    for i, t in texts.items():
        if "▁" not in t:
            assert plain[i] == library.encode(t)
    other = {r.doc_id: r.ids for r in merge_dropout.encode(docs, PIECES, seed=8).collect()}
    assert any(other[r.doc_id] != r.ids for r in rows) and any(plain[r.doc_id] != r.ids for r in rows)
    assert merge_dropout.encode(empty, PIECES).count() == 0


def test_merge_dropout_varies_by_occurrence(spark):
    text = " ".join(["understanding"] * 60)
    rows = merge_dropout.encode(spark.createDataFrame([(i, text) for i in range(12)], "doc_id long, text string"), PIECES).collect()
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)

    def words(ids):
        return [tuple(w.split()) for w in " ".join(map(pieces.id_to_piece, ids)).split("▁")[1:]]

    found = [words(r.ids) for r in rows]
    assert all(len(w) == 60 and len(set(w)) > 1 for w in found)
    assert len({tuple(r.ids) for r in rows}) == 12 > merge_dropout.STREAMS
    # Occurrences that share agendas have what each has alone.
    tool, rng = merge_dropout.Merger(PIECES, 0.3, 7), np.random.default_rng(9)
    chunks = [" understanding", " a", " the\U0001f600", " international", "x" * 70]
    owner, keys = rng.integers(0, 5, 400), rng.integers(0, 1 << 62, 400)
    lists, path = tool.paths(chunks, owner, keys)
    for k in range(400):
        assert lists[int(path[k])].as_py() == tool.numbers([chunks[owner[k]]], keys[k : k + 1])[0].tolist()


def test_agenda_equals_scanning_for_the_best_pair():
    def scanned(tool, chunk, stream):
        parts, places, skipped = list(chunk), list(range(len(chunk))), set()
        names = {**{c: int(tool.part_of[ord(c)]) for c in chunk}, "▁": int(tool.part_of[ord(" ")])}
        number = lambda p: names[p] if p in names else int(np.flatnonzero(tool.id_of == tool.number[p])[0])
        while True:
            found = [
                (-tool.score[a + b], i)
                for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))
                if a + b in tool.score and (places[i], a, b) not in skipped
            ]
            if not found:
                return [x for p in parts for x in ([tool.number[p]] if p in tool.number else tool.bytes_number[list(p.encode())].tolist())]
            i = min(found)[1]
            a, b = parts[i : i + 2]
            if tool.skipped(*(np.array([x]) for x in (stream, places[i], number(a), number(b))))[0]:
                skipped.add((places[i], a, b))
            else:
                parts[i : i + 2] = [a + b]
                del places[i + 1]

    tool = merge_dropout.Merger(PIECES, 0.3, 7)
    rng = np.random.default_rng(1)
    chunks = [" " + "".join(rng.choice(list("etaoinshrdluä1.\U0001f600"), n)) for n in (0, 1, 2, 7, 7, 7, 30, 63, 64, 120)]
    for stream in range(merge_dropout.STREAMS):
        ids, size = tool.numbers(chunks, np.full(len(chunks), stream))
        cuts = np.append(0, np.cumsum(size))
        for chunk, a, b in zip(chunks, cuts, cuts[1:], strict=False):
            assert ids[a:b].tolist() == scanned(tool, chunk.replace(" ", "▁"), stream)
    # A very long text without a space is one agenda; word marks, spaces and lines meet in any order.
    plain = merge_dropout.Merger(PIECES, 0.0, 7)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    texts = ["".join(rng.choice(list("etaoinshrdlu"), 200_000)), "", " ", "\n", "a  b\n \n\nc ", "", "  ä\n"]
    texts += ["".join(rng.choice(list("ab1 \n\u00e4\U0001f600"), 50)) for _ in range(40)]
    ids, begins = plain.encode(pa.array(texts), np.zeros(len(texts), np.int64))
    assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:], strict=False)] == library.encode(texts)
    texts += ["▁", "▁▁ ▁a▁\n▁ ", *["".join(rng.choice(list("ab ▁\n"), 50)) for _ in range(40)]]
    for one in (plain, tool):
        made = one.encode(pa.array(texts), np.arange(len(texts)) % merge_dropout.STREAMS)
        assert [x.decode() for x in one.decode(*made)] == texts


def test_pipeline_stages_keep_columns(spark, docs):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    frame = corpus_pipeline.documents(spark, folder)
    for name, function in corpus_pipeline.STAGES[:-1]:
        assert function(spark, frame.limit(40), folder).columns == frame.columns, name
    ids = {r.doc_id for r in frame.select("doc_id").collect()}
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and {r.doc_id for r in rows} <= ids and all(r.lossless for r in rows)


def test_words_are_ascii_separated():
    from tidepanel.llm.text import words_of

    texts = ["a b c\x0bd", None, "  x\r\n\ty ", "\x1cz"]
    words, starts = words_of(pa.array(texts))
    assert words.to_pylist() == [w.decode() for t in texts for w in (t or "").encode().split()]
    assert starts.tolist() == [0, 3, 3, 5, 6]
