"""URL filter: rules, then a tree of path templates per host, with built-in functions only.

* Segment by segment, paths of a host share a node. A segment with digits becomes its shape
  (``{n}``); a node whose children are nearly all different becomes one wildcard child (``*``).
* A template whose labelled purity does not differ from that of its host's templates of the
  same form (literal segments starred) by a two-proportion test is merged with them.
* Purity is smoothed from the whole table to the host, the merged branch and the template;
  a template below one half is rejected.

Paths are counted before anything is joined, so a host with a third of all rows is as many rows as it
has different paths. What is known of a node or template is broadcast where its counted size allows
it; beyond that the rows of hot hosts and templates are salted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.operators.skew import attach, attach_all
from tidepanel.sources.staging import stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Levels of the tree; what lies deeper is one further wildcard.
DEPTH = 6
#: A node with at least so many children of which none is usual becomes a wildcard.
FAN_OUT, DIFFERENT = 16, 0.2
#: Rows that the purity of the level above counts for.
SMOOTH = 20.0
#: Standard errors by which a branch must differ to stay apart.
APART = 2.58

#: (host and path, verdict): a rule fits its host and all subdomains where the path starts with its own.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a url; both empty without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits host and path, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, says in sorted(rules, key=lambda r: len(r[0])):
        host, slash, path = text.partition("/")
        fits = (F.col("host") == host) | F.col("host").endswith("." + host)
        fits = fits & F.col("path").startswith(slash + path)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _shape(segment: Column) -> Column:
    return F.regexp_replace(segment, "[0-9]+", "{n}")


def templates(paths: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``paths`` (host, path, n, ...) with the template of each path."""
    parts = F.split(F.regexp_replace("path", "^/", ""), "/")
    rows = paths.withColumn("parts", parts).withColumn("template", F.lit(""))
    for level in range(depth):
        segment = F.get("parts", F.lit(level))
        rows = rows.withColumn("segment", _shape(segment))
        # Children of a node, and how many of its rows they cover.
        node = rows.filter("segment is not null").groupBy("host", "template", "segment").agg(F.sum("n").alias("n"))
        node = node.groupBy("host", "template").agg(F.count("*").alias("children"), F.sum("n").alias("rows"))
        wild = node.filter((F.col("children") >= FAN_OUT) & (F.col("children") >= DIFFERENT * F.col("rows")))
        rows = attach(rows, wild.select("host", "template", F.lit(True).alias("wild")), ["host", "template"])
        child = F.when(F.col("wild") & ~F.col("segment").contains("{n}"), "*").otherwise(F.col("segment"))
        grown = F.when(F.col("segment").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), child))
        rows = stage(rows.withColumn("template", grown).drop("wild", "segment"), "url-level")
    deeper = F.size("parts") > depth
    return rows.withColumn("template", F.when(deeper, F.concat("template", F.lit("/**"))).otherwise(F.col("template"))).drop("parts")


def _purity(good: str, labelled: str, above: Column | str) -> Column:
    above = F.col(above) if isinstance(above, str) else above
    return (F.col(good) + SMOOTH * above) / (F.col(labelled) + SMOOTH)


def rated(paths: DataFrame) -> DataFrame:
    """(host, template, merged, purity) of every template, from labelled and good counts of paths."""
    counts = (F.sum("labelled").alias("labelled"), F.sum("good").alias("good"))
    leaf = stage(paths.groupBy("host", "template").agg(*counts), "templates")
    # The form: literal segments starred, shapes and wildcards kept.
    form = F.regexp_replace("template", r"/(?![^/]*[{*])[^/]+", "/*")
    leaf = leaf.withColumn("merged", form)
    branch = leaf.groupBy("host", "merged").agg(F.sum("labelled").alias("b_labelled"), F.sum("good").alias("b_good"))
    host = leaf.groupBy("host").agg(F.sum("labelled").alias("h_labelled"), F.sum("good").alias("h_good"))
    all_rows = leaf.agg(F.sum("labelled").alias("a_labelled"), F.sum("good").alias("a_good"))
    rows = attach_all(leaf, [(branch, ["host", "merged"]), (host, ["host"])]).crossJoin(F.broadcast(all_rows))
    rows = rows.withColumn("of_all", (F.col("a_good") + 1) / (F.col("a_labelled") + 1))
    rows = rows.withColumn("of_host", _purity("h_good", "h_labelled", "of_all"))
    rows = rows.withColumn("of_branch", _purity("b_good", "b_labelled", "of_host"))
    spread = F.sqrt(F.col("of_branch") * (1 - F.col("of_branch")) / F.greatest(F.col("labelled"), F.lit(1)))
    own = F.col("good") / F.greatest(F.col("labelled"), F.lit(1))
    apart = (F.col("labelled") > 0) & (F.abs(own - F.col("of_branch")) > APART * spread)
    purity = F.when(apart, _purity("good", "labelled", "of_branch")).otherwise(F.col("of_branch"))
    return rows.select(
        "host",
        "template",
        F.when(apart, F.col("template")).otherwise(F.col("merged")).alias("branch"),
        purity.alias("purity"),
    )


def judge(
    pages: DataFrame, labels: DataFrame | None = None, rules: Sequence[tuple[str, str]] = RULES, least: float = 0.5
) -> DataFrame:
    """Per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, branch, purity.

    ``labels`` (page_id, good 0/1) may cover some pages; pages that a rule decides count as labelled
    by it. The verdict is the longest fitting rule's, else ``block`` where the purity of the
    page's branch is below ``least``. A null url or one without ``://`` has host and path empty. With
    no labels at all purity is 1. Rows may repeat; further columns are ignored; no rows give none.
    """
    host, path = host_and_path()
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(rules)
    rows = rows.withColumns({"rule": rule, "said": verdict})
    if labels is None:
        labels = pages.select("page_id").limit(0).withColumn("good", F.lit(0))
    known = labels.filter("page_id is not null").groupBy("page_id").agg(F.min("good").alias("own_good"))
    rows = stage(rows.join(known, "page_id", "left"), "urls")
    good = F.coalesce(F.col("own_good").cast("int"), F.when(F.col("said") == "allow", 1).when(F.col("said") == "block", 0))
    counted = rows.withColumn("is_good", good).groupBy("host", "path")
    counted = counted.agg(F.count("*").alias("n"), F.count("is_good").alias("labelled"), F.coalesce(F.sum("is_good"), F.lit(0)).alias("good"))
    paths = stage(templates(counted), "paths")
    made = attach(paths.select("host", "path", "template"), rated(paths), ["host", "template"])
    out = attach(rows, made.select("host", "path", "branch", "purity"), ["host", "path"])
    by_tree = F.when(F.col("purity") < least, "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("said", by_tree).alias("verdict"), "branch", "purity")
