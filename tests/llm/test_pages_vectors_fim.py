"""Hard negatives, main text and fill-in-the-middle against brute force, a round trip and planted pages."""

from __future__ import annotations

import hashlib
import re
from math import floor, inf, isfinite, nan

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidepanel.llm import fill_middle, hard_negatives, main_text
from tidepanel.sources.staging import stage

VECTORS = "vec_id long, embedding array<float>, label int, score long, rank int, owner string"


def brute_negatives(rows: list[tuple], every: int = 100) -> list[tuple]:
    kept = []
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not isfinite(x) for x in vector):
            continue
        kept.append((vec_id, (label + 1) % 10 if vec_id % 7 == 0 else label, [floor(256 * float(np.float32(x))) for x in vector]))
    found = []
    for a, (anchor, label, vector) in enumerate(kept):
        if anchor % every:
            continue
        scored = [(sum(x * y for x, y in zip(vector, v)), i, own) for b, (i, own, v) in enumerate(kept) if b != a]  # noqa: B905
        scored.sort(key=lambda x: (-x[0], x[1]))
        for positive_score, positive, _ in [x for x in scored if x[2] == label][:5]:
            fits = [x for x in scored if x[2] != label and 30 * positive_score <= 100 * x[0] <= 90 * positive_score]
            found += [(anchor, positive, k + 1, x[1], positive_score, x[0]) for k, x in enumerate(fits[:10])]
    return found


def vector_rows(seed: int, n: int, width: int = 12) -> list[tuple]:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(10, width))
    labels = rng.integers(0, 10, n)
    made = centres[labels] * 0.5 + rng.normal(size=(n, width))
    return [(i, [float(np.float32(x)) for x in made[i]], int(labels[i])) for i in range(n)]


def found_negatives(spark, rows, **how) -> list[tuple]:
    frame = spark.createDataFrame([(*r, 1, 2, "o") for r in rows], VECTORS).repartition(3)
    frame = frame.select("*", hard_negatives.shifted_labels().alias("moved"), hard_negatives.whole_entries().alias("entries"))
    made = hard_negatives.mine(frame.drop("label").withColumnRenamed("moved", "label"), **how)
    assert made.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in made.collect())


@pytest.mark.parametrize("how", [{}, {"block": 37, "bundle": 3}])
def test_hard_negatives_equal_brute_force(spark, how):
    rows = vector_rows(1, 500)
    # One vector shared by a third of the rows, awkward rows, a repeated row and a repeated anchor.
    rows += [(1000 + i, rows[5][1], i % 10) for i in range(250)]
    rows += [(2000, None, 1), (2001, [1.0, None], 2), (2002, [nan] * 12, 3), (2003, [inf] * 12, 3), (2004, rows[0][1], None), (None, rows[0][1], 2)]
    rows += [(2100, [], 4), (2101, [0.5], 4), (2102, [0.0] * 12, 5), rows[3], rows[100], (-100, rows[7][1], 2)]
    found = found_negatives(spark, rows, **how)
    assert found == sorted(brute_negatives(rows)) and len(found) > 100


def test_hard_negatives_in_several_passes(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "PASS", 1)
    monkeypatch.setattr(hard_negatives, "TASK_PAIRS", 50)
    rows = vector_rows(2, 900, 5)
    assert found_negatives(spark, rows, block=64, bundle=2) == sorted(brute_negatives(rows))


def test_hard_negatives_without_anchors_or_rows(spark):
    assert found_negatives(spark, [(1, [1.0], 1)]) == [] == found_negatives(spark, [(100, [1.0], 1)])
    assert found_negatives(spark, []) == []
    big = spark.createDataFrame([(0, [3e9], 1)], "vec_id long, entries array<double>, label int")
    with pytest.raises(Exception, match="exact scores"):
        hard_negatives.mine(big)


def test_scan_drops_rows_before_all_dimensions_are_read():
    """The bitmap shrinks: with one heavy dimension the rows outside the window go after the first step."""
    rng = np.random.default_rng(3)
    entries = rng.integers(-3, 4, (64, 4096)).astype(np.int32)
    entries[9] = rng.integers(-1000, 1000, 4096)
    block = hard_negatives.Vertical(4096, 64, np.arange(4096).tobytes(), np.zeros(4096, np.int64).tobytes(), entries.tobytes())
    anchor = rng.integers(-3, 4, 64).astype(float)
    anchor[9] = 500.0
    read = []
    block.entries = Reads(block.entries, read)
    exact = anchor.astype(np.int64) @ entries.astype(np.int64)
    rows, score = block.scan(anchor, np.ones(4096, bool), np.array([100_000]), np.array([300_000]), 10)
    best = sorted(exact[(exact >= 100_000) & (exact <= 300_000)])[-10:]
    assert sorted(score[score <= 300_000])[-10:] == best and np.array_equal(score, exact[rows])
    assert read[0] == 8 * 4096 and sum(read) < 1.3 * read[0]


class Reads:
    """An array that notes how many entries are taken from it."""

    def __init__(self, array, read):
        self.array, self.read = array, read

    def __getitem__(self, key):
        part = self.array[key]
        self.read.append(part.size)
        return part


def test_registered_hard_negatives_have_no_python_over_pairs_in_the_plan(spark):
    """The joined result is small tables only; no task holds more than its blocks' share of matches."""
    rows = spark.createDataFrame([(i, [float(i % 13), 1.0], i % 10) for i in range(300)], "vec_id long, entries array<double>, label int")
    plan = hard_negatives.mine(rows)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


LONG = "The story of the town is that it was built on the hill by the river and it has been there for a long time, as they say in the books."
OTHER = "And so it was that the people of the valley came to the town with all of their things, and built a bridge that is still there."
GERMAN = "Die Stadt ist auf dem Berg und der Fluss ist nicht weit von der Stadt, und das Haus in der Stadt ist auch von den Leuten für die Stadt."
FEW = "Quartz vow jumbled fox, sphinx judge big black waltz nymph; glib jocks quiz quick frozen hymn gravel."


def text_of(page):
    return main_text.main_text(page, main_text.stop_word_sets())


def test_main_text_of_marked_pages():
    page = f"""<!doctype html><html><head><title>Not this</title><style>p{{}}</style></head><body class="has-sidebar no-comments">
    <header><a href=/>Home</a><p>{OTHER}</p></header><nav><ul><li><a href="a">One</a><li><a href="b">Two</ul></nav>
    <div class="cookie-notice"><p>{LONG}</p></div><script>var x = "</p><p>{LONG}</p>";</script><!-- {LONG} -->
    <article class="post"><header><h1>A   title</h1></header><p>{LONG}</p><p>Short one.</p><aside class=ad>{OTHER}</aside>
    <p>{OTHER}<br>after&nbsp;a break &lt;b&gt; &amp;amp; &eacute;</p><p>{FEW}</p><p>End.</p><figcaption>A <i>cap</i>tion</figcaption>
    <div id="replies"><p>{LONG}</p></div><h2>3 Comments</h2><div><p>{OTHER}</p></div></article>
    <section class="comments"><article><p>{LONG}</p></article></section><form><label>Name</label><textarea>{LONG}</textarea></form>
    <div class="sideBar"><p>{OTHER}</p></div><p hidden>{LONG}</p><footer>&copy; {LONG}</footer></body></html>"""
    assert text_of(page).split("\n") == [
        "A title", LONG, "Short one.", f"{OTHER} after a break <b> &amp; é", FEW, "End.", "A caption",
    ]


def test_main_text_of_unmarked_pages():
    menu = '<div><a href="x">Home</a> <a href="y">News</a></div>'
    page = f"<body>{menu}<div><h1>A heading</h1><p>{LONG * 2}</p><p>Short.</p><p>{OTHER}</p></div><div>Copyright © 2020</div>{menu}</body>"
    assert text_of(page).split("\n") == ["A heading", LONG * 2, "Short.", OTHER]
    german = f"<div>{menu}</div><div><p>{GERMAN * 2}<p>{FEW}<p>{GERMAN}</div>{menu}"
    assert text_of(german).split("\n") == [GERMAN * 2, FEW, GERMAN]
    # The same block beside the text, in an element of its own between menus, is none.
    assert text_of(f"<div>{menu}{FEW}{menu}</div><div><p>{LONG * 2}</div>{menu}") == LONG * 2
    # Without a known language the stop words say nothing.
    assert text_of(f"{menu}<div><p>{FEW * 3}</p></div>").split("\n") == [FEW * 3]


def test_main_text_of_broken_pages():
    assert text_of(None) == text_of("") == text_of("<script>x") == text_of("<!-- x") == text_of("<p hidden>x") == ""
    assert text_of("only &lt;text") == "only <text" and text_of("<article><p>Be.") == "Be."
    assert text_of('<p title="a > b">one < two</p><p class=\'x\'>&#x41;&#0;</p>') == "one < two\nA�"
    assert text_of(f"<nav><ul><li><a href=x>One</a><article><p>{LONG}</p></article>") == LONG
    assert text_of(f'<article><div class="ad"><p>Buy<div>now</div></div><p>{LONG}</b></i></article>') == LONG
    for page in ('<a ="' * 50_000, "<" * 100_000, "<div>" * 50_000 + "</i>" * 50_000, "<article>x" * 10_000, "<p class=ad>" * 50_000):
        text_of(page)


def test_main_text_rows(spark):
    schema = "page_id long, url string, html string, text string, n_chars int, label string"
    rows = [(1, "u", f"<p>{LONG * 2}</p>"), (1, "u", f"<p>{LONG * 2}</p>"), (None, None, None), (3, "v", ""), (4, "w", "<p>" + "word of the text " * 200_000)]
    frame = spark.createDataFrame([(*r, "x", 7, "y") for r in rows], schema)
    found = {(r.page_id, r.url): r for r in main_text.extract(frame).collect()}
    assert main_text.extract(frame).count() == 5 and main_text.extract(frame).columns == ["page_id", "url", "text", "n_chars"]
    assert found[1, "u"].text == LONG * 2 and found[1, "u"].n_chars == len(LONG * 2)
    assert found[None, None].text == found[3, "v"].text == "" and found[4, "w"].n_chars == 17 * 200_000 - 1
    assert main_text.extract(frame.limit(0)).count() == 0


def test_main_text_of_all_pages_is_their_articles(spark):
    """The generated pages hold their text in one article, whose blocks can be taken out by a pattern."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    from html import unescape

    found = {r.page_id: r.text for r in main_text.extract(pages).collect()}
    for r in pages.collect():
        blocks = re.split(r"</?p>|</?h1>|<br>", re.search(r"<article>(.*)</article>", r.html, re.S)[1].replace("<b>", ""))
        assert found[r.page_id] == "\n".join(x for x in (" ".join(unescape(b).split()) for b in blocks) if x)


def brute_middle(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return len(units), "plain", None, None, text
    if h4 % 100 < 20:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def middle_texts() -> list:
    rng = np.random.default_rng(4)
    letters = list("abZ  \n<>PSM1é́\U0001f600")
    texts = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(1500)]
    return [*texts, "", None, "a<P>b", "<M>", "<S", "<P", "word " * 300_000, "é" * 100_001, "<" * 5000]


def test_fill_middle_equals_brute_force(spark):
    texts = middle_texts()
    rows = [(i, t, "f", 3, "o") for i, t in enumerate(texts)] + [(0, texts[0], "f", 3, "o"), (None, "no id at all", "f", 3, "o"), (-5, "minus five", "", 0, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, form string, n int, output string").repartition(4)
    made = fill_middle.restore(fill_middle.transform(frame))
    found = made.collect()
    given = {r[0]: r[1] for r in rows}
    assert len(found) == len(rows) and {r.form for r in found} == {"plain", "psm", "spm"}
    for r in found:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute_middle(r.doc_id, given[r.doc_id])
        assert r.restored == (given[r.doc_id] or "")
    assert fill_middle.restore(fill_middle.transform(frame.limit(0))).count() == 0


def test_fill_middle_by_small_windows(monkeypatch):
    monkeypatch.setattr(fill_middle, "WINDOW", 7)
    texts = [t for t in middle_texts() if t is None or len(t) < 5000]
    data, at = fill_middle.bytes_of(pa.array(texts))
    digests = [hashlib.sha256(f"1:{i}".encode()).hexdigest() for i in range(len(texts))]
    draws = [np.array([int(d[8 * k : 8 * k + 8], 16) for d in digests]) for k in range(4)]
    made = fill_middle.cut(data, at, draws, fill_middle.PLAIN, fill_middle.SPM)
    out, out_at = fill_middle.scatter(data, made["sizes"], made["form"])
    assert fill_middle.strings_of(out, out_at).to_pylist() == [brute_middle(i, t)[4] for i, t in enumerate(texts)]
    back, back_at = fill_middle.gather(out, out_at, made["form"])
    assert np.array_equal(back, data) and np.array_equal(back_at, at)


def test_restore_refuses_outputs_without_markers(spark):
    broken = spark.createDataFrame([("psm", "<P>a<S>b")], "form string, output string")
    with pytest.raises(Exception, match="each marker once"):
        stage(fill_middle.restore(broken), "broken")
    kept = spark.createDataFrame([("plain", "<P>a<S>b", 1), (None, None, 2)], "form string, output string, row int")
    assert {r.row: r.restored for r in fill_middle.restore(kept).collect()} == {1: "<P>a<S>b", 2: ""}


def test_seed_and_shares_are_parameters(spark):
    frame = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("some words to cut into parts").alias("text"))
    assert fill_middle.transform(frame, plain=0, spm=100).filter("form != 'spm'").count() == 0
    assert fill_middle.transform(frame, plain=100).filter("form != 'plain'").count() == 0
    assert fill_middle.transform(frame, seed=2).exceptAll(fill_middle.transform(frame)).count() > 100
