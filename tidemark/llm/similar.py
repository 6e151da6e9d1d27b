"""Near copies by the Jaccard similarity of five-word shingles: candidates by fingerprints, then by MinHash bands, decided exactly.

A text is its set of shingles' hashes; texts with equal sets are one node. Operator 6's byte-position index over the nodes'
fingerprints (simhash.links) gives those within four bits, which are verified and linked first. At similarity 0.8 fingerprints
differ in more bits than an index by bytes can reach, so MinHash bands give what it does not. A signature has BANDS x ROWS minima, and
nodes that agree in all minima of a band meet in a bucket: at similarity 0.8 two meet in some bucket with
probability 1 - (1 - 0.8 ** 6) ** 20 = 0.998. Sets are alike if weight * |x ^ y| <= slack * (|x| + |y|), ^ being
what only one of them holds; weight and slack are 180 and 20 at 0.8.

The few pairs of a bucket of up to SMALL nodes are verified one by one. Crowded buckets that share nodes become one
list (cut by size, so that all that can be alike share one), in which no pair is made. A list has a base: what most
of a few of its sets hold. x ^ y is (x ^ base) ^ (y ^ base), so what a set has against the base, its difference, is all
that counts, and its excess is weight * |difference| - slack * |x|:

* Two sets are surely alike if their excesses add up to 0 or less. So all sets whose excess and the least one of the
  list do are linked to the set with the least one: a link per set, however large the list.
* Any other set must share some elements of its difference with whatever it is alike to: (excess + least) / (2 *
  weight) at least. So in a common order, rare elements first, one of the first few (length - that number + 1) is
  shared. Of two, the one with the lower excess shares excess / weight at least, so a list needs one with the element
  among these fewer places. Elements that one set alone has take up places and lead nowhere, which leaves variants of
  one text that lie below the limit with nothing.
* Before that, sets that cannot have a partner are taken out by their numbers alone: two share as many elements as the one with
  fewer shared ones has at most. What they held counts for the others no longer, so this is done ROUNDS times.

The sets that share such an element are a new, smaller list whose base holds that element; the sets of a list up to
SMALL are compared in one task. Sets that are alike and not linked yet share such a list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import discard, row_key, stored, whole
from tidemark.llm.components import components
from tidemark.llm.simhash import links, majority

SHINGLE = 5
PERCENT = 80
SEED = 42
BANDS = 20
ROWS = 6
SMALL = 8
VOTERS = 15  # sets that make up a base; which ones only matters for the work
SALTS = 8  # tasks that a list is spread over
ROUNDS = 2  # times that sets without a possible partner are taken out; more would only save work
_CHUNK = 4096
_RANDOM = np.random.default_rng(SEED)
_MASKS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64)
_FACTORS = _RANDOM.integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: bytes, shingle: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of the shingles, sorted; a text of fewer words is one shingle, one without words has none."""
    words = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    if not words:
        return np.array([], np.uint64)
    joined = b" ".join(words)
    stops = list(accumulate(len(w) + 1 for w in words))
    n = max(1, len(words) - shingle + 1)
    starts, ends = [0, *stops[: n - 1]], stops[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(joined[a:b - 1], SEED) for a, b in zip(starts, ends)), np.uint64, n))


def alike(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether the sets' Jaccard similarity is at least percent / 100."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _bands(own: np.ndarray) -> list[int]:
    """The bucket of each band; none for an empty set."""
    if not len(own):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), _CHUNK):
        part = own[at:at + _CHUNK]
        least = np.minimum(least, ((part[None, :] ^ _MASKS[:, None]) * _FACTORS[:, None]).min(axis=1))
    return [xxhash.xxh64_intdigest(least[i * ROWS:(i + 1) * ROWS].tobytes(), i) for i in range(BANDS)]


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, sizes, prints, bands = [], [], [], []
        for text in batch.column(3).cast(pa.binary()):
            own = shingles(text.as_py())
            nodes.append(xxhash.xxh64_intdigest(own.tobytes(), SEED))
            sizes.append(len(own))
            prints.append(majority(own))
            bands.append(np.array(_bands(own), np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(np.array(nodes, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()),
             pa.array(np.array(prints, np.uint64).view(np.int64)), pa.array(bands, pa.list_(pa.int64()))],
            ["doc_id", "_id", "_hash", "node", "size", "print", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        sets = [shingles(t.as_py()).view(np.int64) for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), _lists(sets)], ["node", "own"])


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(x) for x in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def _arrays(column: pa.ListArray) -> list[np.ndarray]:
    """Sorted sets of hashes."""
    flat, at = column.values.to_numpy(zero_copy_only=False), np.asarray(column.offsets)
    return [flat[i:j] for i, j in zip(at, at[1:])]


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [alike(x, y, percent) for x, y in zip(_arrays(batch.column(2)), _arrays(batch.column(3)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))
    return run


def _base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a list one after the other -> what more than half of its sets hold."""
    last, held = None, []

    def out() -> pa.RecordBatch:
        values, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), _lists([values[2 * n > len(held)]])], ["list", "base"])
    for batch in batches:
        for at, own in zip(batch.column(0).to_pylist(), _arrays(batch.column(1))):
            if at != last and held:
                yield out()
                held = []
            last = at
            held.append(own)
    if held:
        yield out()


def _differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [np.setxor1d(x, y, assume_unique=True) for x, y in zip(_arrays(batch.column(3)), _arrays(batch.column(4)))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], _lists(found)], ["list", "node", "size", "difference"])


def _counted(postings: DataFrame, key: str) -> DataFrame:
    """postings of keys with two nodes or more, with `members`, their number."""
    sizes = postings.groupBy(key).agg(F.count("*").alias("members")).where("members > 1")
    return postings.join(sizes, key)


def _of_list(rows: DataFrame, per_list: DataFrame) -> DataFrame:
    """rows joined with the row of their list; a crowded list is spread over SALTS tasks. Lists have more rows than SALTS."""
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS))
    spread = per_list.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return rows.withColumn("_salt", salt).join(spread, ["list", "_salt"]).drop("_salt")


def _pairs(small: DataFrame, key: str, percent: int) -> DataFrame:
    """a, b (a < b): the pairs of nodes under one key, SMALL at most, whose sizes allow them to be alike."""
    members = F.sort_array(F.collect_list(F.struct("node", "size")))
    both = small.groupBy(key).agg(members.alias("m")).select(F.explode(F.flatten(F.transform("m", lambda x, i: F.transform(
        F.slice("m", i + 2, SMALL), lambda y: F.struct(x.alias("x"), y.alias("y")))))).alias("p"))
    low, high = F.least("p.x.size", "p.y.size"), F.greatest("p.x.size", "p.y.size")
    return both.where(100 * low >= percent * high).select(F.col("p.x.node").alias("a"), F.col("p.y.node").alias("b"))


def _met(percent: int):
    """Rows of a list one after the other, SMALL at most -> the links among them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, []
        for batch in batches:
            found = []
            for at, node, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _arrays(batch.column(2))):
                if at != last:
                    last, held = at, []
                found += [(min(node, n), max(node, n)) for n, x in held if alike(own, x, percent)]
                held.append((node, own))
            a, b = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _within(small: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: links within lists of SMALL nodes at most; a set travels once per list."""
    rows = small.select("list", "node").join(sets, "node").select("list", "node", "own")
    return rows.repartition("list").sortWithinPartitions("list").mapInArrow(_met(percent), "a long, b long")


def _unlike(lists: DataFrame) -> DataFrame:
    """list, node, ...: of lists with the same nodes one, and none with a single node. lists: distinct (list, node)."""
    seen = lists.groupBy("list").agg(F.count("*").alias("members"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    one = seen.where("members > 1").groupBy("members", "x", "y").agg(F.min("list").alias("list")).select("list", "members")
    return lists.join(one, "list")


def _held(rest: DataFrame) -> DataFrame:
    """rest with `shared` cut to the elements that a free node and another node of the list hold, rare ones first."""
    each = rest.select("list", "node", "free", F.explode("shared").alias("element"))
    # an open pair has a free node, so elements that no free node has lead nowhere either
    counts = each.groupBy("list", "element").agg(F.count("*").alias("n"), F.max("free").alias("any_free")).where("n > 1 AND any_free")
    held = (each.drop("free").join(counts.drop("any_free"), ["list", "element"]).groupBy("list", "node")
            .agg(F.sort_array(F.collect_list(F.struct("n", "element"))).alias("_held")))
    return rest.drop("shared").join(held, ["list", "node"]).withColumn("shared", F.col("_held.element")).drop("_held")


def _partnered(rest: DataFrame, weight: int) -> DataFrame:
    """The rows of rest that some other of their list may be alike to and not linked to yet, by their numbers alone.

    Two share as many elements as the one with fewer shared ones has at most, so of a and b, b with no more than a,
    excess(a) + excess(b) - 2 * weight * shared(b) must be 0 or less. Only least values per number of elements meet.
    """
    low = F.col("excess") - 2 * weight * F.col("_n")
    rest = rest.withColumn("_n", F.size("shared").cast("long"))
    when = lambda c: F.min(F.when(F.col("free"), c))
    least = rest.groupBy("list", "_n").agg(F.min(low).alias("low"), F.min("excess").alias("high"),
                                           when(low).alias("low_free"), when(F.col("excess")).alias("high_free"))
    up = W.partitionBy("list").orderBy("_n")
    fewer, more = up.rowsBetween(W.unboundedPreceding, 0), up.rowsBetween(0, W.unboundedFollowing)
    least = least.select("list", "_n", *[F.min(c).over(fewer).alias(f"_{c}") for c in ("low", "low_free")],
                         *[F.min(c).over(more).alias(f"_{c}") for c in ("high", "high_free")])
    pick = lambda c: F.when(F.col("free"), F.col(f"_{c}")).otherwise(F.col(f"_{c}_free"))
    open_ = (F.col("excess") + pick("low") <= 0) | (low + pick("high") <= 0)
    return rest.join(least, ["list", "_n"]).where(F.coalesce(open_, F.lit(False))).select(*[c for c in rest.columns if c != "_n"])


def _split(lists: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(a, b: sure links; list, node, size: smaller lists that hold every other pair that may be alike).

    lists: list, node, size. sets: node, own."""
    weight, slack = 100 + percent, 100 - percent
    rows = stored(lists.select("list", "node", "size").join(sets, "node"), "crowded")
    order = W.partitionBy("list").orderBy(F.xxhash64("node", "list"), "node")
    voters = rows.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= VOTERS).select("list", "own")
    base = stored(voters.repartition("list").sortWithinPartitions("list").mapInArrow(_base, "list long, base array<long>"), "base")
    found = _of_list(rows, base).select("list", "node", "size", "own", "base")
    found = found.mapInArrow(_differences, "list long, node long, size long, difference array<long>")
    length = F.size("difference").cast("long")
    found = stored(found.withColumns({"length": length, "excess": weight * length - slack * F.col("size")}), "differences")
    discard(rows), discard(base)
    least = found.groupBy("list").agg(F.min(F.struct("excess", "node")).alias("best"))
    least = stored(least.select("list", F.col("best.excess").alias("least"), F.col("best.node").alias("centre")), "least")
    near = _of_list(found, least).withColumn("free", F.col("excess") + F.col("least") > 0)
    sure = stored(near.where("NOT free AND node <> centre").select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b")), "sure")
    free = stored(near.where("free").groupBy("list").agg(F.min("excess").alias("least_free"), F.min("least").alias("least")), "free")
    # how many elements of its difference a node shares with whatever it is alike to and not linked to already
    rest = _of_list(found, free).withColumn("free", F.col("excess") + F.col("least") > 0)
    other = F.when(F.col("free"), F.col("least")).otherwise(F.col("least_free"))
    share = lambda more: F.ceil((F.col("excess") + more) / F.lit(2 * weight)).cast("long")
    rest = rest.where(share(other) <= F.col("length")).select("list", "node", "size", "excess", "free", F.col("difference").alias("shared"))
    for at in range(ROUNDS):
        rest = stored(_partnered(_held(rest), weight), f"held-{at}")
    discard(found), discard(least), discard(free)
    free = rest.groupBy("list").agg(F.min("excess").alias("least"), F.min(F.when(F.col("free"), F.col("excess"))).alias("least_free"))
    rest = _of_list(rest, stored(free, "free"))
    # a free node shares more with those whose excess is not below its own; others are only linked to free ones, above theirs
    rest = rest.withColumns({"share": share(other), "more": share(F.when(F.col("free"), F.col("excess")).otherwise(other))})
    # elements that cannot be shared with such a node come first and take up places
    places = lambda shared: (1 - F.greatest(F.col(shared), F.lit(1)) + F.size("shared")).cast("int")
    first = (rest.where(places("share") > 0)
             .select("list", "node", "size", "excess", places("more").alias("_lower"), F.size("shared").alias("_shared"),
                     F.posexplode(F.slice("shared", F.lit(1), places("share"))).alias("i", "e")))
    # of two that are alike the one with the lower excess has the element among the places that `more` leaves
    first = stored(first.groupBy(F.xxhash64("list", "e").alias("list"), "node", "size").agg(
        F.max(F.col("i") < F.col("_lower")).alias("lower"), F.min("excess").alias("excess"), F.max(F.col("_shared") - F.col("i")).alias("left")), "first")
    led = first.where("lower").groupBy("list").agg(F.min("excess").alias("least"))
    # the other must still have enough elements, from this one on, for the lowest that leads the list
    met = stored(first.join(led, "list").where("lower OR left >= ceil((excess + least) / %d)" % (2 * weight)).select("list", "node", "size"), "met")
    discard(first)
    lists = stored(_unlike(met), "lists")
    discard(met)
    return sure, lists


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs of which not both nodes have one root."""
    root = lambda side: roots.select(F.col("node").alias(side), F.col("root").alias(f"_{side}"))
    both = pairs.join(root("a"), "a", "left").join(root("b"), "b", "left")
    return both.where(~F.coalesce(F.col("_a") == F.col("_b"), F.lit(False))).select("a", "b")


def indexed(nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """a, b (a < b): pairs that operator 6's index links, whose sizes allow them to be alike. nodes: node, size, print.

    Of nodes with one fingerprint the least one stands for it and is paired with the others."""
    first = nodes.groupBy("print").agg(F.min(F.struct("node", "size")).alias("x"))
    first = stored(first, "prints")
    end = lambda side: first.select(F.col("print").alias(f"_{side}"), F.col("x").alias(side))
    near = (links(first.select(F.col("print").alias("fingerprint"))).select(F.col("a").alias("_a"), F.col("b").alias("_b"))
            .join(end("a"), "_a").join(end("b"), "_b").select("a", "b"))
    same = nodes.select(F.col("print").alias("_a"), F.struct("node", "size").alias("b")).join(end("a"), "_a").where("a.node <> b.node")
    both = near.unionByName(same.select("a", "b"))
    low, high = F.least("a.size", "b.size"), F.greatest("a.size", "b.size")
    return both.where(100 * low >= percent * high).select(
        F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")).distinct()


def candidates(nodes: DataFrame, sets: DataFrame, percent: int = PERCENT, known: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(a, b: links, with those known before; a, b: pairs of small buckets to verify). nodes: node, size, bands; sets: node, own."""
    postings = stored(_counted(nodes.select("node", "size", F.explode("bands").alias("bucket")), "bucket"), "postings")
    pairs = _pairs(postings.where(F.col("members") <= SMALL), "bucket", percent).distinct()
    crowded = postings.where(F.col("members") > SMALL)
    first = crowded.groupBy("bucket").agg(F.min("node").alias("a"))
    # lists of nodes that crowded buckets connect, cut by size: two classes each, so sizes within `percent` share one
    joined = components(crowded.join(first, "bucket").select("a", F.col("node").alias("b")))
    # two nodes of one list are decided there
    pairs = stored(_apart(pairs, joined), "few")
    step = F.floor(F.log("size") / math.log(100 / percent)) if percent < 100 else F.col("size")
    lists = joined.join(nodes.select("node", "size"), "node").select(
        "root", "node", "size", F.explode(F.array(step, step + 1)).alias("_class"))
    lists = stored(_unlike(lists.select(F.xxhash64("root", "_class").alias("list"), "node", "size")), "lists")
    discard(postings)
    sure = known
    while not lists.isEmpty():
        found = stored(_within(lists.where(F.col("members") <= SMALL), sets, percent), "within")
        done = lists
        links, lists = _split(done.where(F.col("members") > SMALL), sets, percent)
        discard(done)
        sure = (links if sure is None else sure.unionByName(links)).unionByName(found)
    sure = pairs.limit(0) if sure is None else sure
    return sure, stored(_apart(pairs, components(sure)), "open-pairs")  # what sure links have joined needs no verifying


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: the pairs whose sets are alike."""
    left = sets.select(F.col("node").alias("a"), F.col("own").alias("_x"))
    right = sets.select(F.col("node").alias("b"), F.col("own").alias("_y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "_x", "_y").mapInArrow(_verified(percent), "a long, b long")


def near_links(nodes: DataFrame, sets: DataFrame, percent: int = PERCENT, near: DataFrame | None = None) -> DataFrame:
    """a, b: links that connect what is alike. near: pairs (a, b) to verify and link first."""
    known = None if near is None else stored(_verify(near, sets, percent), "indexed")
    found, pairs = candidates(nodes, sets, percent, known)
    return found.unionByName(_verify(pairs, sets, percent))


def near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, _id, _hash, root per row of docs: rows of one root are linked by texts whose sets are alike.

    Null and empty texts are alike. Repeated rows are all returned; an empty table gives none. Other columns are ignored.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_key(), whole().alias("text"))
    rows = stored(texts.mapInArrow(_nodes, "doc_id long, _id long, _hash long, node long, size long, print long, bands array<long>"), "nodes")
    # of equal sets one row stands for all
    least = F.min(F.struct("_id", "_hash", "size", "print", "bands")).alias("k")
    nodes = stored(rows.groupBy("node").agg(least).select("node", "k.*"), "distinct-nodes")
    met = nodes.select("node", F.explode("bands").alias("bucket"))
    repeated = stored(met.groupBy("bucket").agg(F.count("*").alias("members")).where("members > 1").select("bucket"), "repeated")
    near = stored(indexed(nodes, percent), "index-pairs")
    wanted = met.join(repeated, "bucket").select("node").union(near.select("a")).union(near.select("b")).distinct()
    wanted = stored(nodes.join(wanted, "node"), "wanted")
    discard(repeated), discard(nodes)
    # rows alike in _id and _hash have one text; texts are made distinct, as they take less room than their sets
    one = (texts.select("_id", "_hash", "text").join(wanted.select("node", "_id", "_hash"), ["_id", "_hash"])
           .groupBy("_id", "_hash").agg(F.min("node").alias("node"), F.min("text").alias("text")))
    sets = stored(one.select("node", "text").mapInArrow(_sets, "node long, own array<long>"), "sets")
    linked = components(near_links(wanted, sets, percent, near)).select("node", "root")
    return rows.join(linked, "node", "left").select("doc_id", "_id", "_hash", F.coalesce("root", "node").alias("root"))
