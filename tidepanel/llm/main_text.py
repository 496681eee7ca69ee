"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block elements. The first pass decides blocks by their share of stop words,
their length, their share of link text and what their elements say of themselves; short blocks and those
with few stop words stay open. The second pass gives open blocks the label of the nearest decided
neighbour, where a neighbour in the same element is nearer than any other.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.text import steps

#: The most frequent function words of each language.
STOP_WORDS = {
    "en": "the of and to in a is that for it was on with as be by at this are from or an not have has but they which you his her",
    "fr": "le la les de des du un une et en est que qui dans pour sur avec pas ce il au aux se ne par plus son sont",
    "de": "der die das und in zu den von mit ist für auf des im nicht ein eine dem sich auch als an es war bei wie aus",
    "es": "el la de que y a en un ser se no los las por con para una su al lo del como más es",
}
#: Blocks below SHORT characters stay open, those above LONG with many stop words are good at once.
SHORT, LONG = 70, 200
#: Shares of stop words above which a block may be or is text; below NO_LANGUAGE on the whole page they say nothing.
LOW, HIGH, NO_LANGUAGE = 0.08, 0.18, 0.03
#: Share of link text above which a block is no text, outside and inside an article.
LINKS, LINKS_IN_ARTICLE = 0.33, 0.6

BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td"
    " tfoot th thead tr ul".split()
)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Elements whose neighbouring blocks belong together.
HOLDERS = frozenset(
    "article aside blockquote body details dialog div dl fieldset figure footer form header main menu nav ol section table ul".split()
)
#: Elements without text of their own, and those whose content is not markup.
UNSEEN = frozenset("script style noscript template svg iframe object canvas audio video title textarea select button".split())
#: Elements that stand for something else than the article.
OUTSIDE = frozenset(("nav", "footer", "aside", "form", "dialog", "menu"))
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSED_BY_NEXT = frozenset(("p", "li", "dt", "dd", "tr", "td", "th"))
COMMENT_NAMES = frozenset("comment comments reply replies respond disqus discussion".split())
OUTSIDE_NAMES = COMMENT_NAMES | frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo banner cookie cookies consent gdpr notice notification"
    " alert popup modal newsletter subscribe subscription signup nav navbar navigation menu breadcrumb breadcrumbs sidebar footer"
    " share sharing social related recommended login search pagination pager copyright legal disclaimer"
    " contentinfo complementary".split()
)
HEADER_NAMES = frozenset(("header", "masthead", "topbar"))
COMMENTS_TITLE = re.compile(r"\W*(\d+\s+|reader\s+)?(comments|replies|responses|kommentare?|commentaires?|comentarios?)(\s*\(?\d+\)?)?\W*", re.I)

#: One piece of markup; every alternative takes what it has looked at, so a page is read once.
MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)|<[!?/][^>]*+(?:>|\Z)", re.S
)
ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|itemprop|style|hidden|aria-hidden|href)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    linked: int
    heading: bool
    outside: bool
    article: int
    holder: int
    words: int = 0
    hits: Counter = field(default_factory=Counter)
    label: str = ""


@lru_cache(maxsize=4096)
def _names(attributes: str) -> tuple[frozenset, bool, bool, bool]:
    """Names in class, id, role and itemprop; whether it is hidden, the main part of the page, a link."""
    names, hidden, main, link = set(), False, False, False
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "href":
            link = True
        elif key == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        elif key in ("hidden", "aria-hidden"):
            hidden |= value.lower() != "false"
        else:
            names.update(x.lower() for x in NAME.findall(value))
            main |= (key == "role" and value.lower() == "main") or (key == "itemprop" and value.lower() == "articlebody")
    return frozenset(names), hidden, main, link


class _Page:
    """The blocks of a page in order, read in one pass over its markup."""

    def __init__(self, page: str) -> None:
        self.blocks: list[Block] = []
        #: Open elements that hold blocks or are marked: tag, outside, of comments, article, number.
        self.open: list[list] = [["", False, False, 0, 0]]
        self.count: Counter = Counter()
        self.pieces: list[str] = []
        self.linked, self.link, self.link_depth, self.breaks = 0, False, 0, 0
        self.heading, self.numbers = False, 0
        at, ends = 0, len(page)
        while at < ends:
            found = MARKUP.search(page, at)
            self._text(page[at : found.start()] if found else page[at:])
            if not found:
                break
            at = found.end()
            if found[2]:
                tag = found[2].lower()
                if found[1]:
                    self._end(tag)
                elif tag in UNSEEN and not found[3].endswith("/"):
                    if tag in BLOCKS:
                        self._close()
                    close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
                    if not close:
                        break
                    at = page.find(">", close.end()) + 1 or ends
                else:
                    self._start(tag, found[3])
        self._close()

    def _text(self, raw: str) -> None:
        if not raw:
            return
        text = unescape(raw)
        if not text.isspace():
            self.breaks = 0
        self.pieces.append(text)
        if self.link:
            self.linked += len("".join(text.split()))

    def _close(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            _, outside, _, article, number = self.open[-1]
            if self.heading and len(text) < SHORT and len(self.open) > 1 and COMMENTS_TITLE.fullmatch(text):
                # What follows in the same element are the comments.
                self.open[-1][1] = self.open[-1][2] = outside = True
            self.blocks.append(Block(text, self.linked, self.heading, outside, article, number))
        self.pieces, self.linked, self.breaks, self.heading = [], 0, 0, False

    def _pop(self) -> str:
        tag = self.open.pop()[0]
        self.count[tag] -= 1
        if len(self.open) < self.link_depth:
            self.link = False
        return tag

    def _start(self, tag: str, attributes: str) -> None:
        names, hidden, main, link = _names(attributes) if attributes.strip() else (frozenset(), False, False, False)
        if tag == "br":
            self.breaks += 1
            self.pieces.append(" ")
            if self.breaks > 1:
                self._close()
            return
        if tag in VOID and tag not in BLOCKS:
            self.pieces.append("")
            return
        if tag in BLOCKS:
            self._close()
            self.heading = tag in HEADINGS
            if self.open[-1][0] == "p" or (self.open[-1][0] == tag and tag in CLOSED_BY_NEXT):
                self._pop()
        if tag == "a":
            self.link, self.link_depth = link, len(self.open)
        _, outside, comments, article, _ = self.open[-1]
        main |= tag in ("article", "main")
        marked = bool(names & OUTSIDE_NAMES) or hidden or tag in OUTSIDE or (bool(names & HEADER_NAMES) or tag == "header") and not article
        if tag in ("html", "body") or (main and not names & COMMENT_NAMES and not hidden):
            # Themes list what a page has or lacks in the classes of its outermost elements.
            marked = False
        if main:
            # An article inside an article is a comment on it; one inside an unclosed menu is not part of that.
            comments |= tag == "article" and article > 0 and self.count["article"] > 0
            asides = self.count["aside"] + self.count["footer"] + self.count["form"]
            outside = comments or (outside and asides > 0)
        marked |= outside
        comments |= bool(names & COMMENT_NAMES) and tag not in ("html", "body")
        if tag in HOLDERS or marked != self.open[-1][1]:
            if tag in VOID:
                return
            self.numbers += 1
            self.count[tag] += 1
            self.open.append([tag, marked or comments, comments, self.numbers if main else article, self.numbers])

    def _end(self, tag: str) -> None:
        if tag in BLOCKS:
            self._close()
        if tag == "a":
            self.link = False
        if self.count[tag] > 0:
            while self._pop() != tag:
                pass


def _first_pass(blocks: list[Block], stop_words: dict[str, frozenset]) -> None:
    every = frozenset().union(*stop_words.values())
    total, seen = Counter(), 0
    for b in blocks:
        words = WORD.findall(b.text.lower())
        b.words = len(words)
        hits = Counter(w for w in words if w in every)
        b.hits = Counter({k: sum(n for w, n in hits.items() if w in own) for k, own in stop_words.items()})
        total.update(b.hits)
        seen += b.words
    language = max(sorted(stop_words), key=lambda k: total[k])
    known = total[language] >= NO_LANGUAGE * seen
    for b in blocks:
        size = len(b.text)
        share = b.hits[language] / max(b.words, 1)
        inked = sum(map(len, b.text.split()))
        if b.outside or b.linked > (LINKS_IN_ARTICLE if b.article else LINKS) * inked:
            b.label = "bad"
        elif not b.article and size < LONG and ("©" in b.text or (size < SHORT and b.linked)):
            b.label = "bad"
        elif size < SHORT:
            b.label = "short"
        elif not known or share >= LOW:
            b.label = "good" if b.article or (share >= HIGH and size > LONG) else "near"
        else:
            # Few stop words with links are a list; without, the neighbours decide.
            b.label = "bad" if b.linked and not b.article else "short"
    inside = sum(len(b.text) for b in blocks if b.article and b.label != "bad")
    beside = sum(len(b.text) for b in blocks if not b.article and b.label != "bad")
    if inside > beside:
        # The page says where its article is, and most of the text is there.
        for b in blocks:
            if not b.article:
                b.label = "bad"


def _nearest(blocks: list[Block], decided: list[bool]) -> list[tuple[int, int]]:
    """The nearest decided block before and after each (-1: none)."""
    before, last = [], -1
    for i, known in enumerate(decided):
        before.append(last)
        last = i if known else last
    after, last = [], -1
    for i in range(len(decided) - 1, -1, -1):
        after.append(last)
        last = i if decided[i] else last
    return list(zip(before, after[::-1], strict=True))


def _second_pass(blocks: list[Block]) -> None:
    good_anywhere = any(b.label == "good" for b in blocks)
    sides = _nearest(blocks, [b.label in ("good", "bad") for b in blocks])
    near = [i for i, b in enumerate(blocks) if b.label == "near"]
    made = {i: "bad" if good_anywhere and all(j < 0 or blocks[j].label == "bad" for j in sides[i]) else "good" for i in near}
    for i, label in made.items():
        blocks[i].label = label
    # Inside an article, what is marked as something else says nothing of its neighbours.
    groups = {0: list(range(len(blocks)))}
    for i, b in enumerate(blocks):
        if b.article:
            groups.setdefault(b.article, []).append(i)
    for article, own in groups.items():
        part = [blocks[i] for i in own]
        sides = _nearest(part, [b.label in ("good", "bad") and not (article and b.outside) for b in part])
        found = {}
        for i, b in enumerate(part):
            if b.label != "short" or b.article != article:
                continue
            candidates = [(part[j].holder != b.holder, abs(i - j), part[j].label) for j in sides[i] if j >= 0]
            if b.heading and sides[i][1] >= 0:
                # A heading belongs to what follows.
                candidates = [c for c in candidates if c[1] == sides[i][1] - i] or candidates
            best = min((c[:2] for c in candidates), default=None)
            labels = {c[2] for c in candidates if c[:2] == best}
            # A page on which nothing is decided has no menus either.
            found[own[i]] = labels.pop() if len(labels) == 1 else ("good" if article or not labels else "bad")
        for i, label in found.items():
            blocks[i].label = label


def stop_word_sets(stop_words: dict[str, str] = STOP_WORDS) -> dict[str, frozenset]:
    return {k: frozenset(v.split()) for k, v in stop_words.items()}


def main_text(page: str | None, stop_words: dict[str, frozenset]) -> str:
    """The good blocks of a page, one a line."""
    blocks = _Page(page).blocks if page else []
    if not blocks:
        return ""
    _first_pass(blocks, stop_words)
    _second_pass(blocks)
    return "\n".join(b.text for b in blocks if b.label == "good")


def _extract(batches: Iterator[pa.RecordBatch], stop_words: dict[str, str]) -> Iterator[pa.RecordBatch]:
    sets = stop_word_sets(stop_words)
    for batch in steps(batches, text="html"):
        texts = [main_text(h.as_py(), sets) for h in batch.column("html")]
        columns = [*batch.select(["page_id", "url"]).columns, pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])


def extract(pages: DataFrame, stop_words: dict[str, str] = STOP_WORDS) -> DataFrame:
    """page_id, url, text and n_chars of every page of ``pages`` (page_id, url, html).

    A null or empty page, or one without any text, has an empty text. Ties between a good and a bad
    neighbour are good inside an article and bad outside. Repeated pages give repeated rows; other columns
    are ignored. One row in, one out, without a shuffle; a worker holds one step of pages or one long page.
    """
    kind = {f.name: f.dataType.simpleString() for f in pages.schema}
    rows = pages.select("page_id", F.col("url"), "html")
    schema = f"page_id {kind['page_id']}, url string, text string, n_chars long"
    return rows.mapInArrow(lambda it: _extract(it, stop_words), schema)
