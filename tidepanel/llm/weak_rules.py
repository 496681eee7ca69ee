"""Quality rules as weak supervision, with built-in functions only.

Rules vote good, bad or abstain on each text. Expectation-maximisation over the counted vote patterns
(3 ** rules at most, whatever the corpus) estimates how often each rule votes how on good and on bad
texts; the posterior probability of good replaces an all-must-pass filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import exp, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.sources.staging import stage

SPACE = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: The same symbol twice in a row.
RUN = r"([#*$%&|<>])\1"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
VOTES = (-1, 1)
ROUNDS = 30
TOLERANCE = 1e-5
#: First guess of how often a rule that votes does so on (bad, good) texts: a vote for bad is rare on
#: good texts, whichever rule gives it; a vote for good says little. An abstention says nothing.
START = {-1: (0.4, 0.001), 1: (0.6, 0.999)}
#: Weight of the first guess against the votes in every round.
ANCHOR = 0.5
START_GOOD = 0.9


def _without(text: str, characters: str) -> Column:
    return F.length(F.translate(text, characters, ""))


def measures(docs: DataFrame, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns and counts of each whole text: words, characters, symbols, repeats.

    Everything stays inside the row, so there is no shuffle: repeated three-word windows are found by
    sorting (64-bit window hash, position) and comparing neighbours.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(*keep, text.alias("text"))
    lines = F.filter(F.split("text", "\n"), lambda x: F.translate(x, SPACES, "") != "")
    rows = rows.select(
        *keep,
        "text",
        F.array_remove(F.split("text", SPACE), "").alias("words"),
        lines.alias("lines"),
        F.length("text").alias("n_chars"),
        _without("text", SPACES).alias("word_chars"),
        _without("text", SYMBOLS).alias("no_symbols"),
        _without("text", CAPITALS).alias("no_capitals"),
        F.regexp_count("text", F.lit(RUN)).alias("n_runs"),
    )
    rows = rows.withColumns(
        {
            "n_words": F.size("words"),
            "n_lines": F.size("lines"),
            "n_own_lines": F.size(F.array_distinct("lines")),
            "n_own_words": F.size(F.array_distinct("words")),
            "n_ended": F.size(F.filter("lines", lambda x: F.substring(F.rtrim(x), -1, 1).isin(".", "!", "?"))),
        }
    )
    key = F.expr(
        "sort_array(transform(if(n_words < 3, cast(array() as array<int>), sequence(0, n_words - 3)),"
        " i -> struct(xxhash64(words[i], words[i + 1], words[i + 2]) as h, i as i)))"
    )
    rows = rows.withColumn("keys", key)
    same = "(i > 0 and keys[i - 1].h = k.h) or (i < n_words - 3 and keys[i + 1].h = k.h)"
    at = F.expr(f"sort_array(transform(filter(keys, (k, i) -> {same}), k -> cast(k.i as bigint)))")
    rows = rows.withColumn("at", at)
    covered = F.expr("aggregate(transform(at, (p, i) -> least(3L, coalesce(get(at, i + 1) - p, 3L))), 0L, (s, x) -> s + x)")
    return rows.select(
        *keep,
        F.col("n_words").cast("long").alias("n_words"),
        F.col("word_chars").cast("long").alias("word_chars"),
        (F.col("n_chars") - F.col("no_symbols")).cast("long").alias("n_symbols"),
        (F.col("n_lines") - F.col("n_own_lines")).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        (F.col("n_chars") - F.col("no_capitals")).cast("long").alias("n_capitals"),
        "n_runs",
        "n_lines",
        "n_own_words",
        "n_ended",
    )


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes() -> dict[str, Column]:
    """The rules over the columns of ``measures``: -1 bad, 1 good, 0 abstains."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    length = F.col("word_chars") / words
    symbols = F.col("n_symbols") / words
    lines = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    repeats = F.col("n_repeat_words") / words
    capitals = F.col("n_capitals") / chars
    own = F.col("n_own_words") / words
    ended = F.col("n_ended") / F.greatest(F.col("n_lines"), F.lit(1))
    long_enough = F.col("n_words") >= 100
    return {
        "v_length": _vote(F.col("n_words") < 50, F.col("n_words") >= 100),
        "v_word_length": _vote((length < 2.5) | (length > 14), length.between(3, 11)),
        "v_symbols": _vote(symbols > 0.1, symbols < 0.02),
        "v_runs": _vote(F.col("n_runs") > 0.05 * words, F.col("n_runs") == 0),
        "v_lines": _vote(lines > 0.3, (lines == 0) & (F.col("n_lines") >= 3)),
        "v_repeats": _vote(repeats > 0.3, repeats < 0.15),
        "v_capitals": _vote(capitals > 0.4, capitals < 0.15),
        "v_ended": _vote(ended < 0.1, ended >= 0.6),
        "v_variety": _vote(own < 0.15, (own > 0.3) & long_enough),
    }


def _posterior(parts: Sequence[dict], prior: float, names: Sequence[str]) -> Column:
    """Probability of good given the votes, from each rule's shares by vote on (bad, good) texts."""
    odds = F.lit(log(prior / (1 - prior)))
    for name, part in zip(names, parts, strict=True):
        term = F.lit(0.0)
        for vote, (bad, good) in part.items():
            term = F.when(F.col(name) == vote, log(good / bad)).otherwise(term)
        odds = odds + term
    return 1 / (1 + F.exp(-odds))


def estimate(patterns: Sequence[tuple[Sequence[int], int]], rules: int, rounds: int = ROUNDS) -> tuple[list[dict], float]:
    """By rule the shares of each vote, where given, on (bad, good) texts, and the share of good ones.

    ``patterns`` are the different vote patterns with their counts. EM from START on, which also
    anchors the shares. No patterns: the first guess.
    """
    parts, prior = [START] * rules, START_GOOD
    for _ in range(rounds):
        n = [0.0, 0.0]
        sums = [{vote: [0.0, 0.0] for vote in VOTES} for _ in range(rules)]
        for votes_given, count in patterns:
            odds = log(prior / (1 - prior))
            odds += sum(log(part[v][1] / part[v][0]) for v, part in zip(votes_given, parts, strict=True) if v)
            good = 1 / (1 + exp(-max(-50.0, min(50.0, odds))))
            for side, weight in enumerate((count * (1 - good), count * good)):
                n[side] += weight
                for v, total in zip(votes_given, sums, strict=True):
                    if v:
                        total[v][side] += weight
        parts = []
        for total in sums:
            cast = [sum(total[v][side] for v in VOTES) for side in (0, 1)]
            parts.append(
                {
                    v: tuple((total[v][k] + (1 + ANCHOR * cast[k]) * START[v][k]) / (cast[k] * (1 + ANCHOR) + 1) for k in (0, 1))
                    for v in VOTES
                }
            )
        before, prior = prior, (n[1] + 9) / (n[0] + n[1] + 10)
        if abs(before - prior) < TOLERANCE:
            break
    return parts, prior


def judge(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, the counts, base_failed, kept and the posterior probability of good.

    A null or empty text has no words and fails the base rule. kept is false where the base rule
    fails, otherwise whether the posterior is at least 0.5. Rows may repeat; a missing doc_id stays
    missing; further columns are ignored; no rows give no rows.
    """
    rules = votes()
    voted = stage(measures(docs).select("*", *[c.alias(name) for name, c in rules.items()]), "votes")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    # The verdict is asked for texts that pass the base rule, so their votes are what is learned from.
    patterns = voted.filter(~failed).groupBy(*rules).agg(F.count("*").alias("n"))
    # At most 3 ** len(rules) rows, however many texts there are.
    counted = [(tuple(r)[:-1], r["n"]) for r in patterns.collect()]
    parts, prior = estimate(counted, len(rules))
    scored = voted.withColumn("posterior", _posterior(parts, prior, list(rules)))
    return scored.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("posterior") >= 0.5)).alias("kept"),
        "posterior",
    )
