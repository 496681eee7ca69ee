"""MinHash near-duplicates: many universal hash minima, banding, signature check, exact check.

1. One pass over the texts gives each row its set size, a 128-bit key of the set and, from ``HASHES``
   minima of universal hash functions (multiply, add, shift), the hashes of its bands.
2. Rows with equal sets fall into one class by an aggregate with map-side combine, so a group of
   exact copies is one row from here on.
3. ``HASHES / ROWS`` bands give buckets. A bucket's least class is linked to each
   other member, not all pairs: candidates grow with the number of members.
4. Candidates are dropped by set sizes that rule the similarity out, then by the share of equal
   minima, seven standard deviations below the threshold; the rest are compared by their full sets.
5. Alternating large-star and small-star give components. A bucket whose members all fell into one
   is done. For a centre whose group still spans several, every member outside the largest
   component is a query against the whole group, in blocks: with D(x) the symmetric difference of
   a set with the centre's, |x ^ y| = |D(x) ^ D(y)|, so short difference lists decide exactly, and
   only links leave the task. Afterwards no candidate pair is undecided.

With 40 bands of 5 a pair of similarity 0.8 shares no bucket with a chance of 1.3e-7.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.components import components
from tidepanel.llm.text import constants, hot_limit, join_one, keep_rows, mix, steps, whole, word_hashes, words_of
from tidepanel.sources.staging import stage

HASHES = 200
ROWS = 5
THRESHOLD_PERCENT = 80
#: Documents of one centre's group that a task compares at a time.
BLOCK = 2000


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its shingles of ``size`` words, A-Z lowered.

    A text with fewer words has one shingle, all its words; one without words has none.
    """
    words, starts = words_of(pc.ascii_lower(pc.fill_null(whole(texts), "")))
    hashed = word_hashes(words)
    factor = constants(size + 1, 17)
    n = len(hashed)
    rolled = np.zeros(max(0, n - size + 1), np.uint64)
    for i in range(size):
        rolled += hashed[i : i + len(rolled)] * factor[i]
    rolled = mix(rolled)
    out = []
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        if b - a >= size:
            own = np.sort(rolled[a : b - size + 1])
            out.append(own[np.concatenate([[True], own[1:] != own[:-1]])])
        elif b > a:
            short = (hashed[a:b] * factor[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([short], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """HASHES minima of each set, 32 bits each; zeros for an empty one."""
    a, b = constants(HASHES, 29), constants(HASHES, 31)
    count = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(count)
    minima = np.zeros((len(sets), HASHES), np.uint32)
    if len(full):
        flat = np.concatenate([sets[i] for i in full])
        begin = np.concatenate([[0], np.cumsum(count[full])[:-1]])
        for j in range(HASHES):
            least = np.minimum.reduceat(flat * a[j] + b[j], begin)
            minima[full, j] = (least >> np.uint64(32)).astype(np.uint32)
    return minima


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in rows], pa.binary())


def _signed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    bands = HASHES // ROWS
    factor, salt = constants(ROWS, 37), constants(bands, 41)
    for batch in steps(batches):
        sets = shingle_sets(batch.column("text"), size)
        count = np.array([len(s) for s in sets], np.int64)
        full = np.flatnonzero(count)
        keys = np.zeros((2, len(sets)), np.uint64)
        if len(full):
            flat = np.concatenate([sets[i] for i in full])
            begin = np.concatenate([[0], np.cumsum(count[full])[:-1]])
            keys[0, full] = np.add.reduceat(flat, begin)
            keys[1, full] = np.add.reduceat(mix(flat + factor[0]), begin)
        minima = signatures(sets).reshape(-1, bands, ROWS).astype(np.uint64)
        banded = mix((minima * factor).sum(axis=2, dtype=np.uint64) + salt)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(count),
                pa.array(keys[0].view(np.int64)),
                pa.array(keys[1].view(np.int64)),
                _binary(banded),
            ],
            names=["doc_id", "n_shingles", "key_a", "key_b", "bands"],
        )


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        banded = np.frombuffer(b"".join(batch.column("bands").to_pylist()), np.int64)
        ids = np.repeat(batch.column("class").to_numpy(), HASHES // ROWS)
        yield pa.RecordBatch.from_arrays([pa.array(banded), pa.array(ids)], names=["bucket", "class"])


def _set_rows(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in steps(batches):
        sets = shingle_sets(batch.column("text"), size)
        yield pa.RecordBatch.from_arrays(
            [batch.column("class"), _binary(signatures(sets)), _binary(sets)],
            names=["class", "minima", "members"],
        )


def _sorted_values(cell: pa.Scalar) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), np.uint64)


def _confirmed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs by set sizes, then by equal minima, then by the full sets."""
    rate = percent / 100
    least = HASHES * (rate - 7 * (rate * (1 - rate) / HASHES) ** 0.5)
    for batch in batches:
        keep = []
        for ma, mb, x, y in zip(*[batch.column(c) for c in ("ma", "mb", "sa", "sb")], strict=True):
            x, y = _sorted_values(x), _sorted_values(y)
            ma, mb = (np.frombuffer(m.as_buffer(), np.uint32) for m in (ma, mb))
            possible = 100 * min(len(x), len(y)) >= percent * max(len(x), len(y))
            if possible and (ma == mb).sum() >= least:
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                shared = int((both[1:] == both[:-1]).sum())
                possible = 100 * shared >= percent * (len(both) - shared)
            else:
                possible = False
            keep.append(possible)
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, lists = [], []
        for x, y in zip(batch.column("sa"), batch.column("sb"), strict=True):
            x, y = _sorted_values(x), _sorted_values(y)
            sizes.append(len(y))
            lists.append(np.setxor1d(x, y, assume_unique=True).tobytes())
        rest = batch.select(["a", "b", "component", "query", "blocks", "query_blocks"])
        yield pa.RecordBatch.from_arrays(
            [*rest.columns, pa.array(sizes, pa.int64()), pa.array(lists, pa.binary())],
            names=[*rest.schema.names, "n", "d"],
        )


def _block_links(block: pa.Table, percent: int) -> pa.Table:
    """Links of the block's queries to its members, at most one for a query and a component."""
    d = [_sorted_values(c) for c in block.column("d").combine_chunks()]
    flat, begin = np.unique(np.concatenate(d), return_inverse=True)[1], np.cumsum([0, *map(len, d)])
    length = np.diff(begin)
    n, component = (block.column(c).to_numpy() for c in ("n", "component"))
    ids, query = block.column("b").to_numpy(), block.column("as_query").to_numpy()
    members = np.flatnonzero(~query)
    has = np.zeros(int(flat.max()) + 1 if len(flat) else 1, np.int64)
    out: list[tuple[int, int]] = []
    for q in np.flatnonzero(query):
        own = flat[begin[q] : begin[q + 1]]
        has[own] = 1
        total = np.concatenate([[0], np.cumsum(has[flat])])
        shared = total[begin[members + 1]] - total[begin[members]]
        has[own] = 0
        apart = length[q] + length[members] - 2 * shared
        sizes = n[q] + n[members]
        linked = 100 * (sizes - apart) >= percent * (sizes + apart)
        hits = members[linked & (component[members] != component[q])]
        first = hits[np.unique(component[hits], return_index=True)[1]]
        out += [(int(ids[q]), int(ids[m])) for m in first]
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})


def _links_between(star: DataFrame, sets: DataFrame, found: DataFrame, percent: int) -> DataFrame:
    """Links between different components inside the group of a centre: (a, b), one per pair of document and component."""
    groups = star.union(star.select("a", "a").distinct())
    groups = groups.join(found.withColumnRenamed("node", "b"), "b", "left")
    groups = groups.select("a", "b", F.coalesce("component", "b").alias("component"))
    parts = groups.groupBy("a", "component").agg(F.count("*").alias("rows"))
    of_centre = parts.groupBy("a").agg(
        F.sum("rows").alias("rows"), F.max_by("component", F.struct("rows", "component")).alias("main"), F.max("rows").alias("most")
    )
    of_centre = of_centre.filter("most < rows").select(
        "a",
        "main",
        "rows",
        F.ceil(F.col("rows") / BLOCK).alias("blocks"),
        F.ceil((F.col("rows") - F.col("most")) / BLOCK).alias("query_blocks"),
    )
    # A centre's group is its pairs and itself.
    of_centre = stage(of_centre, "centres")
    still = join_one(groups, of_centre.withColumn("n", F.col("rows")).drop("rows"), "a", hot_limit(2 * star.count()))
    still = stage(still.withColumn("query", F.col("component") != F.col("main")), "open")
    # The rows of one centre meet its set in as many tasks as it has blocks.
    zero = F.lit(0).cast("long")
    salts = of_centre.select("a", F.explode(F.sequence(zero, F.col("blocks") - 1)).alias("salt"))
    centre, member = (sets.select(F.col("class").alias(x), F.col("members").alias(f"s{x}")) for x in "ab")
    lists = still.withColumn("salt", F.pmod(F.xxhash64("b"), "blocks")).join(salts.join(centre, "a"), ["a", "salt"]).join(member, "b")
    lists = lists.select("a", "b", "component", "query", "blocks", "query_blocks", "sa", "sb")
    kinds = "a long, b long, component long, query boolean, blocks long, query_blocks long, n long, d binary"
    rows = stage(lists.mapInArrow(_differences, kinds), "differences")
    spread = {
        False: (F.pmod(F.xxhash64("b"), "blocks"), F.explode(F.sequence(zero, F.col("query_blocks") - 1))),
        True: (F.explode(F.sequence(zero, F.col("blocks") - 1)), F.pmod(F.xxhash64("b"), "query_blocks")),
    }
    dealt = [
        (rows.filter("query") if as_query else rows).select(
            "a", "b", "component", "n", "d", F.lit(as_query).alias("as_query"), x.alias("x"), y.alias("y")
        )
        for as_query, (x, y) in spread.items()
    ]
    # Dealt by block: what came before is dealt by centre, which would do for the grouping as well.
    blocks = dealt[0].union(dealt[1]).repartition("a", "x", "y").groupBy("a", "x", "y")
    return stage(blocks.applyInArrow(lambda t: _block_links(t, percent), "a long, b long"), "links")


def _with_centres(star: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) with minima and set of a; those of a centre with very many pairs in several tasks."""
    limit = hot_limit(star.count())
    heavy = star.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / F.lit(limit)).alias("salts"))
    heavy = F.broadcast(stage(heavy.filter("salts > 1"), "centres"))
    zero = F.lit(0).cast("long")
    salted = star.join(heavy, "a", "left").withColumn("salt", F.pmod(F.xxhash64("b"), F.coalesce("salts", F.lit(1).cast("long"))))
    copies = sets.toDF("a", "ma", "sa").join(heavy, "a", "left")
    copies = copies.withColumn("salt", F.explode(F.sequence(zero, F.coalesce("salts", F.lit(1).cast("long")) - 1))).drop("salts")
    return salted.drop("salts").join(copies, ["a", "salt"]).drop("salt")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * shared shingles >= percent * all shingles of the two. Case: A-Z
    are lowered. component_id is the least doc_id reachable by links, itself included; kept says
    that this is the document's own. Without words (null, empty, blank) a row has no shingles and no
    links. Rows that share a doc_id are one document. A row without doc_id is linked with nothing:
    component_id null, kept true. Other columns are ignored; an empty table gives no rows.
    """
    signed = docs.select("doc_id", "text").mapInArrow(
        lambda it: _signed(it, size), "doc_id long, n_shingles long, key_a long, key_b long, bands binary"
    )
    signed = stage(signed, "signed")
    by_set = ["key_a", "key_b", "n_shingles"]
    named = signed.filter("doc_id is not null and n_shingles > 0")
    of_set = named.groupBy(*by_set).agg(F.min(F.struct("doc_id", "bands")).alias("first"))
    classes = stage(of_set.select(*by_set, F.col("first.doc_id").alias("class"), F.col("first.bands").alias("bands")), "classes")
    own = named.select("doc_id", *by_set).join(classes.select("class", *by_set), by_set)
    own = stage(own.select("doc_id", "class").distinct(), "own-class")
    texts = docs.select(F.col("doc_id").alias("class"), "text")

    banded = stage(classes.select("class", "bands").mapInArrow(_buckets, "bucket long, class long"), "bands")
    shared = banded.groupBy("bucket").agg(F.min("class").alias("first"), F.max("class").alias("last"), F.count(F.lit(1)).alias("n"))
    shared = shared.filter("first < last").select("bucket", "first", "n")
    members = stage(join_one(banded, shared, "bucket", hot_limit(banded.count())), "buckets")
    star = members.filter("first <> class").select(F.col("first").alias("a"), F.col("class").alias("b")).distinct()
    star = stage(star, "pairs")
    wanted = stage(star.select(F.explode(F.array("a", "b")).alias("class")).distinct(), "wanted")
    sets = keep_rows(texts, wanted, "class").mapInArrow(
        lambda it: _set_rows(it, size), "class long, minima binary, members binary"
    )
    sets = stage(sets, "sets")
    full = _with_centres(star, sets).join(sets.toDF("b", "mb", "sb"), "b")
    links = stage(full.mapInArrow(lambda it: _confirmed(it, percent), "a long, b long"), "links")
    # A document on several rows joins their classes.
    several = own.groupBy("doc_id").agg(F.min("class").alias("a")).join(own, "doc_id")
    several = several.filter("a <> class").select("a", F.col("class").alias("b"))
    links = links.union(several)
    found = stage(components(links), "components")

    more = _links_between(star, sets, found, percent)
    if not more.isEmpty():
        found = stage(components(links.union(more)), "components")

    placed = own.join(found.withColumnRenamed("node", "class"), "class", "left")
    placed = placed.select("doc_id", F.coalesce("component", "class").alias("component_id")).groupBy("doc_id")
    placed = placed.agg(F.min("component_id").alias("component_id"))
    rows = signed.select("doc_id", "n_shingles").join(placed, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    kept = F.coalesce(F.col("doc_id") == component, F.lit(True))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), kept.alias("kept"))
