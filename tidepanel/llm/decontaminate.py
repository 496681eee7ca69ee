"""Benchmark decontamination by spaced seeds, with built-in functions only.

Each mask of ``MASKS`` looks at some of the tokens of a short window and ignores the rest, so a
replaced token spoils only the windows in which a mask looks at it. Hashes of the masked windows of
benchmark items are joined with those of the documents; around each hit the item is laid on the
document and compared token by token, which tolerates substitutions.

The seeds of the benchmark are counted before the join: few are broadcast, many are joined by shuffle.
Hits are reduced to (document, item, offset) before anything else is joined to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.text import BROADCAST_ROWS
from tidepanel.sources.staging import stage

#: Windows of nine tokens, six of which count.
MASKS = ("111001011", "110100111", "101110101")
#: An overlap counts with so many equal tokens (percent) in a window of so many, or in a shorter item.
WINDOW, PERCENT = 12, 80
#: What a missing id is joined as.
NO_ID = -(1 << 63)


def tokens(text: str = "text") -> Column:
    """Lower-case runs of letters and digits."""
    bare = F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+", " ")
    return F.array_remove(F.split(bare, " ", -1), "")


def seeds(rows: DataFrame, keep: list[str]) -> DataFrame:
    """(keep..., at, seed): the masked windows of each row's ``tokens``."""
    span = len(MASKS[0])
    rows = rows.withColumn("hashes", F.transform("tokens", lambda t: F.xxhash64(t)))
    rows = rows.withColumn("windows", F.size("hashes") - (span - 1)).filter("windows > 0")
    parts = []
    for number, mask in enumerate(MASKS):
        chosen = ", ".join(f"hashes[i + {k}]" for k, bit in enumerate(mask) if bit == "1")
        parts.append(f"transform(sequence(0, windows - 1), i -> xxhash64({number}, {chosen}))")
    rows = rows.select(*keep, "windows", F.posexplode(F.expr(f"concat({', '.join(parts)})")).alias("place", "seed"))
    return rows.select(*keep, (F.col("place") % F.col("windows")).alias("at"), "seed")


def _small(table: DataFrame) -> DataFrame:
    """Marked for broadcast where its counted rows allow it."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(d, item, equal): verified overlaps of documents with items, the best one of each pair.

    ``d`` is doc_id, a missing one NO_ID; ``benchmark`` has item_id and text.
    """
    items = benchmark.select(F.coalesce("item_id", F.lit(NO_ID)).alias("item"), tokens().alias("tokens"))
    items = stage(items.distinct(), "items")
    item_seeds = stage(seeds(items, ["item"]).select("seed", "item", F.col("at").alias("item_at")).distinct(), "seeds")
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("d"), "text")
    found = seeds(rows.select("d", tokens().alias("tokens")), ["d"]).join(_small(item_seeds), "seed")
    hits = stage(found.select("d", "item", (F.col("at") - F.col("item_at")).alias("offset")).distinct(), "hits")
    near = rows.join(_small(hits), "d").select("d", "item", "offset", tokens().alias("tokens"))
    laid = near.join(_small(items.select("item", F.col("tokens").alias("wanted"))), "item")
    flags = F.expr(
        "transform(wanted, (t, i) -> if(offset + i >= 0 and get(tokens, cast(offset + i as int)) <=> t, 1, 0))"
    )
    laid = laid.select("d", "item", flags.alias("flags")).withColumn("width", F.least(F.lit(WINDOW), F.size("flags")))
    best = F.expr(
        "array_max(transform(sequence(0, size(flags) - width),"
        " i -> aggregate(slice(flags, i + 1, width), 0, (s, x) -> s + x)))"
    )
    laid = laid.withColumn("best", best).filter(100 * F.col("best") >= PERCENT * F.col("width"))
    return laid.groupBy("d", "item").agg(F.max(F.aggregate("flags", F.lit(0), lambda s, x: s + x)).alias("equal"))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, contaminated, n_items, first_item, most_equal (tokens).

    An item is in a document if, laid on it at a seed hit, 80 percent of some 12 consecutive tokens
    (of all, in a shorter item) are equal. Items or documents of fewer than nine tokens, null and
    empty texts have no seeds and match nothing. Rows that share a doc_id get the findings of all
    of them; a missing doc_id counts as one id. Further columns are ignored; no rows give none.
    """
    found = stage(overlaps(docs, benchmark), "overlaps").groupBy("d")
    found = found.agg(F.count("*").alias("n"), F.min("item").alias("first_item"), F.max("equal").alias("most_equal"))
    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("d")).join(found, "d", "left")
    return rows.select(
        "doc_id",
        F.col("n").isNotNull().alias("contaminated"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n_items"),
        "first_item",
        "most_equal",
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap no item, all columns kept."""
    found = stage(overlaps(docs, benchmark).select(F.col("d").alias("_d")).distinct(), "leaks")
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_d"), F.struct(*docs.columns).alias("_row"))
    rows = rows.join(_small(found), "_d", "left_anti")
    return rows.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
