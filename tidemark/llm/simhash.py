"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Two fingerprints of eight bytes that differ in at most four bits agree in at least four positional bytes: that
is the guaranteed minimum. Tallying single bytes would pair everything that shares any one of 2,048 values, so
the index is kept at the minimum itself: a posting list is a choice of four positions and their four values.
Whoever meets in a list has reached the tally, and nobody else can be linked. The tally of a pair is the number
of equal bytes; a pair is taken up in the first of its lists only, then verified by its differing bits.

Equal fingerprints are one entry, so exact copies cost nothing. A list emits a spanning forest of its links, never
all pairs. Lists longer than `list_limit` go another exact way: entries of a list differ in 32 bits only, and two
differ in at most four exactly if some value is within two bits of both, so each entry is sent to its 529 such
values and neighbours at a value are linked; at most 529 distinct entries can meet there.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import DOCUMENT, row_key, stored, table, whole
from tidemark.llm.components import components
from tidemark.llm.registry import query

SHINGLE = 4
SEED = 42
BITS = 4
LIST_LIMIT = 16384
_ALL_PAIRS = 8  # lists up to this length emit every link, longer ones a forest
_CHUNK = 1 << 16
_CHOICES = np.array(list(combinations(range(8), 4)))  # 70, in lexicographic order
_FIRST = np.full(256, 255, np.uint8)  # by the mask of equal bytes: the first choice among them
for _mask in range(256):
    _equal = [p for p in range(8) if _mask >> p & 1]
    if len(_equal) >= 4:
        _FIRST[_mask] = list(combinations(range(8), 4)).index(tuple(_equal[:4]))


def simhash(text: bytes, shingle: int = SHINGLE) -> int:
    """The fingerprint, unsigned: a bit is set if it is in over half of the shingles' hashes; 0 without words."""
    words = text.lower().split()  # of bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    stops = list(accumulate(len(w) + 1 for w in words))
    n = max(1, len(words) - shingle + 1)
    starts, ends = [0, *stops[: n - 1]], stops[min(shingle, len(words)) - 1:]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        h = np.array([digest(joined[a:b - 1], SEED) for a, b in zip(starts[at:at + _CHUNK], ends[at:at + _CHUNK])], "<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little")


def majority(hashes: np.ndarray) -> int:
    """The fingerprint of unsigned hashes: a bit is set if it is in over half of them."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), _CHUNK):
        part = np.ascontiguousarray(hashes[at:at + _CHUNK], "<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, _id, _hash (what names the row) and fingerprint, as a signed long, per row of docs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(3).cast(pa.binary())
            found = np.fromiter((simhash(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(found.view(np.int64))],
                                             ["doc_id", "_id", "_hash", "fingerprint"])
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *row_key(), whole().alias("text"))
    return rows.mapInArrow(run, "doc_id long, _id long, _hash long, fingerprint long")


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """list (choice and its four bytes) and fingerprint, 70 rows per fingerprint."""
    for batch in batches:
        prints = batch.column(0).to_numpy()
        for at in range(0, len(prints), 4096):
            part = prints[at:at + 4096]
            own = part.view(np.uint8).reshape(-1, 8).astype(np.int64)
            keys = np.zeros((len(part), len(_CHOICES)), np.int64) + np.arange(len(_CHOICES))
            for j in range(4):
                keys = (keys << 8) | own[:, _CHOICES[:, j]]
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(part, len(_CHOICES)))], ["list", "fingerprint"])


def _linked(a: np.ndarray, b: np.ndarray, choice, bits: int) -> np.ndarray:
    """Which pairs differ in at most `bits` and have this choice as the first list they share."""
    differ = a ^ b
    near = np.bitwise_count(differ.view(np.uint64)) <= bits
    same = np.packbits(differ.view(np.uint8).reshape(-1, 8) == 0, axis=1, bitorder="little").ravel()
    return near & (_FIRST[same] == choice)


def _forest(prints: np.ndarray, choice: int, bits: int) -> tuple[list, list]:
    """Edges of a spanning forest of the links in one list."""
    a, b, rest = [], [], prints
    while len(rest):
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            hit = _linked(np.full(len(rest), at), rest, choice, bits)
            new = rest[hit]
            if len(new):
                a.extend([at] * len(new)), b.extend(new), queue.extend(new)
                rest = rest[~hit]
    return a, b


def _links(bits: int, limit: int):
    """Batches sorted by list: edges (a, b, null) of short lists; members (list, fingerprint, true) of long ones."""
    def edges(keys: np.ndarray, prints: np.ndarray) -> Iterator[tuple]:
        cuts = np.flatnonzero(np.diff(keys)) + 1
        starts, sizes = np.r_[0, cuts], np.diff(np.r_[0, cuts, len(keys)])
        small = np.repeat(sizes <= _ALL_PAIRS, sizes)
        k, p = keys[small], prints[small]
        for shift in range(1, _ALL_PAIRS):
            same = np.flatnonzero(k[shift:] == k[:-shift])
            if not len(same):
                break
            x, y = p[same], p[same + shift]
            hit = _linked(x, y, (k[same] >> 32).astype(np.uint8), bits)
            yield x[hit], y[hit]
        for s, n in zip(starts[sizes > _ALL_PAIRS], sizes[sizes > _ALL_PAIRS]):
            a, b = _forest(prints[s:s + n], int(keys[s] >> 32), bits)
            yield np.array(a, np.int64), np.array(b, np.int64)

    def rows(a, b, long_list: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.full(len(a), long_list))], ["a", "b", "long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, prints, overflow = np.array([], np.int64), np.array([], np.int64), None
        for batch in batches:
            k, p = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if overflow is not None:  # the rest of a long list
                n = int(np.searchsorted(k, overflow, "right"))
                if n:
                    yield rows(k[:n], p[:n], True)
                k, p = k[n:], p[n:]
                if not len(k):
                    continue
                overflow = None
            keys, prints = np.r_[keys, k], np.r_[prints, p]
            if not len(keys):
                continue
            last = int(np.searchsorted(keys, keys[-1], "left"))  # the last list may go on
            for a, b in _cut(keys[:last], prints[:last], limit, rows, edges):
                yield rows(a, b, False) if b is not None else a
            keys, prints = keys[last:], prints[last:]
            if len(keys) > limit:
                yield rows(keys, prints, True)
                overflow, keys, prints = keys[-1], keys[:0], prints[:0]
        if len(keys):
            for a, b in _cut(keys, prints, limit, rows, edges):
                yield rows(a, b, False) if b is not None else a
    return run


def _cut(keys, prints, limit, rows, edges):
    """Edges of the lists up to the limit; whole batches (second item None) of the members of longer ones."""
    if not len(keys):
        return
    cuts = np.flatnonzero(np.diff(keys)) + 1
    sizes = np.diff(np.r_[0, cuts, len(keys)])
    long = np.repeat(sizes > limit, sizes)
    if long.any():
        yield rows(keys[long], prints[long], True), None
        keys, prints = keys[~long], prints[~long]
    if len(keys):
        for a, b in edges(keys, prints):
            if len(a):
                yield a, b


def _midpoints(bits: int):
    """list, value, fingerprint: every value within bits / 2 flips of the list's other 32 bits."""
    half = bits // 2
    flips = [0] + [sum(1 << i for i in c) for n in range(1, half + 1) for c in combinations(range(32), n)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = {}
        for choice, held in enumerate(_CHOICES):
            free = [p for p in range(8) if p not in held]
            spread[choice] = np.array([sum((f >> 8 * j & 255) << 8 * p for j, p in enumerate(free)) for f in flips], np.uint64).view(np.int64)
        for batch in batches:
            keys, prints = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for choice in np.unique(keys >> 32):
                mine = np.flatnonzero(keys >> 32 == choice)
                for at in range(0, len(mine), 1024):
                    m = mine[at:at + 1024]
                    values = prints[m][:, None] ^ spread[int(choice)][None, :]
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(keys[m], len(flips))), pa.array(values.ravel()),
                                                      pa.array(np.repeat(prints[m], len(flips)))], ["list", "value", "fingerprint"])
    return run


def links(prints: DataFrame, bits: int = BITS, list_limit: int = LIST_LIMIT) -> DataFrame:
    """a, b: edges that connect what links of at most `bits` (4 or fewer) connect. prints: distinct `fingerprint`."""
    if bits not in (0, 2, 4):  # four equal bytes are guaranteed up to four; long lists halve the bits
        raise ValueError("bits must be 0, 2 or 4")
    postings = prints.select("fingerprint").mapInArrow(_postings, "list long, fingerprint long")
    met = (postings.repartition("list").sortWithinPartitions("list")
           .mapInArrow(_links(bits, list_limit), "a long, b long, long boolean"))
    met = stored(met, "links")
    crowded = met.where("long").select(F.col("a").alias("list"), F.col("b").alias("fingerprint"))
    near = crowded.mapInArrow(_midpoints(bits), "list long, value long, fingerprint long")
    earlier = F.lag("fingerprint").over(W.partitionBy("list", "value").orderBy("fingerprint"))
    steps = near.withColumn("a", earlier).where("a IS NOT NULL").select("a", F.col("fingerprint").alias("b"))
    return met.where("NOT long").select("a", "b").unionByName(steps.distinct())


def near_duplicates(docs: DataFrame, bits: int = BITS, shingle: int = SHINGLE, list_limit: int = LIST_LIMIT) -> DataFrame:
    """doc_id, _id, _hash, fingerprint (long), root, component_id per row of docs.

    component_id is the smallest doc_id reachable over links (null ids aside; null if all are null); root names the
    component itself. A null or empty text has fingerprint 0 and links like any other. Repeated rows have equal
    fingerprints and are all returned; an empty table gives none. Other columns are ignored.
    """
    rows = stored(fingerprints(docs, shingle), "fingerprints")
    prints = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "prints")
    linked = components(links(prints, bits, list_limit)).select(F.col("node").alias("fingerprint"), "root")
    rooted = stored(prints.join(linked, "fingerprint", "left")
                    .select("fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(rooted.drop("least").join(least, "root"), "fingerprint").select(
        "doc_id", "_id", "_hash", "fingerprint", "root", "component_id")


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """documents with one row of each group of near copies (five-word shingles, similarity 0.8 or more, see
    similar.near_copies: the index above over five-word fingerprints, then what differs in more bits): the smallest doc_id, among
    equal ids the smallest hash of the text; of rows that repeat, one. A group without any id keeps one row as well. Columns of documents."""
    from tidemark.llm.similar import near_copies  # which builds on this module
    docs = docs.select(*DOCUMENT)
    found = near_copies(docs, **options)
    best = (found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "_id", "_hash")).alias("k"))
            .select(F.col("k._id").alias("_id"), F.col("k._hash").alias("_hash")).distinct())
    # joined and made distinct on the same key: one shuffle of the texts
    return (docs.select("*", *row_key()).join(stored(best, "kept"), ["_id", "_hash"], "left_semi")
            .dropDuplicates(["_id", "_hash"]).select(*DOCUMENT))


@query()
def op6_simhash_near_dedup(spark, sf_dir):
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
