"""Vector codes by product quantisation: Lloyd rounds per part, with adaptive distance bounds.

Every part of every vector keeps between rounds: its entry, an upper bound on the distance to it, the few entries
that came next, in order, each with a lower bound that also holds for all entries after it, and one outer bound for
all entries not listed. When entries move, upper bounds grow and lower bounds shrink by how far they moved. A part
whose upper bound lies below its first lower bound keeps its entry unseen; otherwise only the entries before the
first lower bound that is high enough are looked at; if even the outer bound is too low, all are. What is looked at
is decided by integer distances, ties to the lower index, so the bounds (rounded to the safe side) only save work.

The number of listed entries adapts to what the parts needed in the last round (see adapted). The rows with their
bounds are a written table per round, a record of bytes each; sums per entry come from it, and only codebooks and
counts reach the driver. A table goes when the next one is written.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import discard, stored, table
from tidemark.llm.registry import query

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LISTED = 16  # entries listed per part at first
LEAST_LISTED = 4
_ENOUGH = 0.99  # nearly all
_LONG = (1 << 63) - 1
_EXACT = 2.0 ** 52  # sums of squares up to here are exact in doubles
_ROWS = 4096  # rows worked on at once
_UP, _DOWN = 1 + 1e-12, 1 - 1e-12


def integers(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """vec_id, label, v = floor(1024 * x) of every component; vectors that are null or hold null or non-finite ones are dropped."""
    x = F.transform(embedding, lambda e: e.cast("double"))
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    # larger components are cut to the range of a long
    v = F.transform(x, lambda e: F.floor(F.greatest(F.least(e * SCALE, F.lit(9.2e18)), F.lit(-9.2e18))))
    return (vectors.where(F.col(embedding).isNotNull() & finite)
            .select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), v.alias("v")))


def cuts(size: int, parts: int) -> list[tuple[int, int]]:
    """Where the parts of a vector begin and end: of equal size, or the first ones a component longer."""
    ends = [(size // parts) * i + min(i, size % parts) for i in range(parts + 1)]
    return list(zip(ends, ends[1:]))


def _small(points: np.ndarray, book: np.ndarray) -> bool:
    """Whether squared distances are exact in doubles and longs."""
    if points.dtype == object or book.dtype == object:
        return False
    top = max((float(np.abs(a).max(initial=0)) for a in (points, book)))
    return 4.0 * top * top * max(1, points.shape[1]) < _EXACT


def squared(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of all points (rows) to all entries (columns), exact: whole doubles, or Python integers."""
    if _small(points, book):
        x, c = points.astype(float), book.astype(float)
        return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)[None]
    out = np.empty((len(points), len(book)), object)
    for j, entry in enumerate(book.astype(object)):
        out[:, j] = ((points.astype(object) - entry) ** 2).sum(1) if points.shape[1] else 0
    return out


def _below(x: np.ndarray) -> np.ndarray:
    """x as single-precision numbers, each a little too small."""
    return np.nextafter((x * _DOWN).astype(np.float32), np.float32(-np.inf))


class Bounds:
    """What the parts of a block of vectors, at one position, keep: a row per vector. A list that is shorter than the others
    is filled up with the row's own entry."""

    def __init__(self, entry, upper, near, low, outer):
        self.entry, self.upper, self.near, self.low, self.outer = entry, upper, near, low, outer

    @classmethod
    def fresh(cls, points: np.ndarray, book: np.ndarray, listed: int) -> Bounds:
        """From all distances."""
        exact = squared(points, book)
        n, rows = len(points), np.arange(len(points))
        entry = exact.argmin(axis=1) if n else np.zeros(0, np.int64)  # the first of equals
        far = np.sqrt(exact.astype(float))
        upper = far[rows, entry] * _UP
        listed = min(listed, len(book) - 1)
        far[rows, entry] = -1.0  # sorts first
        if listed + 2 <= len(book):
            closest = np.argpartition(far, listed + 1, axis=1)[:, :listed + 2]
            closest = np.take_along_axis(closest, np.take_along_axis(far, closest, 1).argsort(1, kind="stable"), 1)
            outer = _below(np.take_along_axis(far, closest[:, -1:], 1)[:, 0])
        else:
            closest, outer = far.argsort(1, kind="stable"), np.full(n, np.inf, np.float32)
        near = closest[:, 1:listed + 1]
        return cls(entry, upper, near, _below(np.take_along_axis(far, near, 1)), outer)

    def resized(self, listed: int) -> Bounds:
        """With lists of so many entries: cut, as a lower bound holds for all entries after its own, or filled up."""
        more = listed - self.near.shape[1]
        if more < 0:
            return Bounds(self.entry, self.upper, self.near[:, :listed], self.low[:, :listed], self.low[:, listed])
        return Bounds(self.entry, self.upper, np.concatenate((self.near, np.repeat(self.entry[:, None], more, 1)), 1),
                      np.concatenate((self.low, np.repeat(self.outer[:, None], more, 1)), 1), self.outer)

    def moved(self, points: np.ndarray, book: np.ndarray, drift: np.ndarray, listed: int) -> tuple[Bounds, np.ndarray]:
        """The bounds after the entries moved, each by drift at most, and how many listed entries each part needed (one
        more than listed: all entries)."""
        self = self.resized(listed)
        filler = self.near == self.entry[:, None]
        upper = (self.upper + drift[self.entry]) * _UP
        outer = _below(self.outer.astype(float) - float(drift.max(initial=0.0)))
        low = np.where(filler, outer[:, None], _below(self.low.astype(float) - drift[self.near]))
        bounds = np.minimum.accumulate(np.concatenate((low, outer[:, None]), 1)[:, ::-1], 1)[:, ::-1]
        safe = upper[:, None] < bounds
        need = np.where(safe.any(1), safe.argmax(1), listed + 1)
        need[need > listed - filler.sum(1)] = listed + 1  # fillers cannot settle anything
        if not _small(points, book):
            need[:] = listed + 1
        out = Bounds(self.entry.copy(), upper, self.near.copy(), bounds[:, :listed].copy(), bounds[:, listed].copy())
        for z in np.unique(need[(need > 0) & (need <= listed)]).tolist():
            rows = np.flatnonzero(need == z)
            found = np.concatenate((self.entry[rows, None], self.near[rows, :z]), 1)
            exact = ((points[rows, None, :] - book[found]) ** 2).sum(2)
            order = np.lexsort((found, exact), axis=1)
            found, exact = np.take_along_axis(found, order, 1), np.sqrt(np.take_along_axis(exact, order, 1).astype(float))
            out.entry[rows], out.upper[rows] = found[:, 0], exact[:, 0] * _UP
            out.near[rows] = np.where(filler[rows], found[:, :1], out.near[rows])
            out.near[rows, :z] = found[:, 1:]
            fresh = np.concatenate((_below(exact[:, 1:]), bounds[rows, z:]), 1)
            fresh = np.minimum.accumulate(fresh[:, ::-1], 1)[:, ::-1]
            out.low[rows], out.outer[rows] = fresh[:, :listed], fresh[:, listed]
        rows = np.flatnonzero(need > listed)
        if len(rows):
            new = Bounds.fresh(points[rows], book, listed)
            out.entry[rows], out.upper[rows], out.near[rows], out.low[rows], out.outer[rows] = new.entry, new.upper, new.near, new.low, new.outer
        return out, need


class Layout:
    """A vector and what its parts keep, as one record of bytes."""

    def __init__(self, size: int, parts: int, kind: str, listed: int):
        self.spans, self.listed, self.kind = cuts(size, parts), listed, kind
        self.record = np.dtype([("v", kind, (size,)), ("entry", "u1", (parts,)), ("need", "u2", (parts,)), ("upper", "f8", (parts,)),
                                ("outer", "f4", (parts,)), ("near", "u1", (parts, listed)), ("low", "f4", (parts, listed))])

    def with_lists(self, listed: int) -> Layout:
        size, parts = self.spans[-1][1], len(self.spans)
        return Layout(size, parts, self.kind, listed)

    def read(self, column: pa.BinaryArray) -> np.ndarray:
        return np.frombuffer(b"".join(column.to_pylist()), self.record)

    def bounds(self, rows: np.ndarray, p: int) -> Bounds:
        return Bounds(*(rows[c][:, p].astype(k) for c, k in (("entry", np.int64), ("upper", float), ("near", np.int64), ("low", np.float32), ("outer", np.float32))))

    def written(self, v: np.ndarray, kept: list[tuple[Bounds, np.ndarray]]) -> pa.BinaryArray:
        rows = np.zeros(len(v), self.record)
        rows["v"] = v
        for p, (b, need) in enumerate(kept):
            rows["need"][:, p] = need
            for c in ("entry", "upper", "near", "low", "outer"):
                rows[c][:, p] = getattr(b, c)
        offsets = np.arange(len(v) + 1, dtype=np.int32) * self.record.itemsize
        return pa.Array.from_buffers(pa.binary(), len(v), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())])


def _assigning(books: list[np.ndarray], drifts: list[np.ndarray] | None, old: Layout, new: Layout):
    """vec_id, label, and v or (from the second round on, when there are drifts) kept -> vec_id, label, kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), _ROWS):
                batch = whole.slice(at, _ROWS)
                if drifts is None:
                    v = batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(batch), new.spans[-1][1])
                else:
                    rows = old.read(batch.column(2))
                    v = rows["v"].astype(np.int64)
                kept = []
                for p, (a, b) in enumerate(new.spans):
                    if drifts is None:
                        kept.append((Bounds.fresh(v[:, a:b], books[p], new.listed), np.full(len(v), new.listed + 1)))
                    else:
                        kept.append(old.bounds(rows, p).moved(v[:, a:b], books[p], drifts[p], new.listed))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), new.written(v, kept)], ["vec_id", "label", "kept"])
    return run


def _summing(layout: Layout, entries: int):
    """kept -> at, entry, n, high, low. at from 0: sums of a component over the parts of an entry, cut at 32 bits so that
    none overflows. at -1: entry is how many listed entries parts needed, n how many parts."""
    size, parts = layout.spans[-1][1], len(layout.spans)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros((2, size, entries), np.int64), np.zeros((parts, entries), np.int64)
        needs = np.zeros(layout.listed + 2, np.int64)
        for batch in batches:
            rows = layout.read(batch.column(0))
            v, entry = rows["v"].astype(np.int64), rows["entry"]
            needs += np.bincount(rows["need"].ravel(), minlength=len(needs))
            for p, (a, b) in enumerate(layout.spans):
                n[p] += np.bincount(entry[:, p], minlength=entries)
                for j in range(a, b):
                    for half, x in enumerate((v[:, j] >> 32, v[:, j] & 0xFFFFFFFF)):
                        sums[half, j] += np.bincount(entry[:, p], weights=x, minlength=entries).astype(np.int64)
        z, none = np.arange(len(needs)), np.zeros(len(needs), np.int64)
        found = [(none - 1, z, needs, none, none)]
        for p, (a, b) in enumerate(layout.spans):
            at, e = (x.ravel() for x in np.meshgrid(np.arange(a, b), np.flatnonzero(n[p]), indexing="ij"))
            found.append((at, e, n[p, e], sums[0, at, e], sums[1, at, e]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], ["at", "entry", "n", "high", "low"])
    return run


def _updated(state: DataFrame, books: list[np.ndarray], layout: Layout) -> tuple[list[np.ndarray], list[np.ndarray], dict[int, int]]:
    """The codebooks of floored means, how far each entry moved, and how many parts needed how many listed entries.

    A row per used entry and component reaches the driver."""
    sums = (state.select("kept").mapInArrow(_summing(layout, max(len(b) for b in books)), "at long, entry long, n long, high long, low long")
            .groupBy("at", "entry").agg(*[F.sum(c).alias(c) for c in ("n", "high", "low")]).collect())
    part_of = {j: (p, j - a) for p, (a, b) in enumerate(layout.spans) for j in range(a, b)}
    new = [b.copy() for b in books]
    for r in sums:
        if r["at"] >= 0:
            p, j = part_of[r["at"]]
            new[p][r["entry"], j] = ((r["high"] << 32) + r["low"]) // r["n"]
    drifts = [np.sqrt(((x.astype(float) - y.astype(float)) ** 2).sum(1)) * _UP + abs(y.astype(float)).sum(1) * 1e-12 for x, y in zip(new, books)]
    return new, drifts, {r["entry"]: r["n"] for r in sums if r["at"] < 0}


def adapted(needs: dict[int, int], listed: int, entries: int) -> int:
    """How many entries to list next, from how many parts needed how many listed ones in the last round.

    If nearly all were settled by their lists: as many as nearly all of these needed. If at least half were: twice as
    many. Otherwise no list would help yet, as entries still move far, and the number stays.
    """
    settled = {z: n for z, n in needs.items() if z <= listed}
    total, found = sum(needs.values()), sum(settled.values())
    if 2 * found < total:
        return listed
    if found < _ENOUGH * total:
        return min(2 * listed, max(1, entries // 4), entries - 1)
    upto = 0
    for z in sorted(settled):
        upto += settled[z]
        if upto >= _ENOUGH * found:
            return min(listed, max(LEAST_LISTED, z))
    return listed


def _final(books: list[np.ndarray], layout: Layout):
    """vec_id, label, kept -> vec_id, label, code, error."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = layout.read(batch.column(2))
            v, entry = rows["v"].astype(np.int64), rows["entry"]
            error = np.zeros(len(v), object)
            for p, (a, b) in enumerate(layout.spans):
                x, y = v[:, a:b], books[p][entry[:, p]]
                if not _small(x, books[p]):
                    x, y = x.astype(object), y.astype(object)
                error = error + ((x - y) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([row.tobytes().hex() for row in entry], pa.string()),
                 pa.array([min(_LONG, int(e)) for e in error], pa.int64())], ["vec_id", "label", "code", "error"])
    return run


def _coded(rows: DataFrame, size: int, top: int, parts: int, entries: int, rounds: int, listed: int) -> DataFrame:
    """vec_id, label, code, error, codebooks_sha256 for vectors of one length, components up to `top`."""
    first = rows.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()  # the entries, no more
    book = np.array([r.v for r in first], np.int64).reshape(len(first), size)
    books = [book[:, a:b].copy() for a, b in cuts(size, parts)]
    label = T.StructType([T.StructField("vec_id", T.LongType()), rows.schema["label"]])
    schema = T.StructType([*label.fields, T.StructField("kept", T.BinaryType())])
    layout = Layout(size, parts, "i2" if top < 1 << 15 else "i4" if top < 1 << 31 else "i8", min(listed, len(first) - 1))
    state = stored(rows.mapInArrow(_assigning(books, None, layout, layout), schema), "codes")
    for _ in range(rounds):
        books, drifts, needs = _updated(state, books, layout)
        old, layout = layout, layout.with_lists(adapted(needs, layout.listed, len(first)))
        before, state = state, stored(state.mapInArrow(_assigning(books, drifts, old, layout), schema), "codes")
        discard(before)  # the new table does without it
    digest = hashlib.sha256(",".join(str(int(x)) for b in books for x in b.ravel()).encode()).hexdigest()
    coded = state.mapInArrow(_final(books, layout), label.add("code", "string").add("error", "long"))
    return coded.withColumn("codebooks_sha256", F.lit(digest))


def codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, listed: int = LISTED) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 per row of vectors (vec_id, embedding, label) that is kept.

    Rows whose vector is null or holds null or non-finite components are dropped; an empty table gives no rows. Rows
    that repeat an id or a vector are coded each. The first entries are the vectors of the smallest ids (null last;
    of equal ids the lesser vector); fewer vectors make fewer entries. Vectors of different lengths have codebooks
    of their own; a length that the parts do not divide makes the first parts a component longer. Components beyond
    a long, and errors beyond one, are given as its end. Equal labels, nulls together, share label_error. At most
    256 entries have two digits each. Other columns are ignored.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256")
    kept = stored(integers(vectors).withColumn("size", F.size("v")), "integers")
    # a row per length of vector
    top = F.max(F.greatest(F.array_max("v"), -1 - F.array_min("v")))
    sizes = {r["size"]: r["top"] or 0 for r in kept.groupBy("size").agg(top.alias("top")).collect()}
    out = None
    for size in sorted(sizes) or [0]:
        own = kept.where(F.col("size") == size).drop("size")
        coded = _coded(own, size, sizes[size], parts, entries, rounds, listed) if sizes else own.select(
            "vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"), F.lit("").alias("codebooks_sha256"))
        out = coded if out is None else out.unionByName(coded)
    out = stored(out, "coded")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG).cast("decimal(38,0)")).cast("long")
    # written, so that Spark knows its size: small, it is broadcast; large, a hot label's rows are split between tasks
    sums = stored(out.groupBy(F.col("label").alias("_label")).agg(total.alias("label_error")), "label-errors")
    return out.join(sums, F.col("label").eqNullSafe(F.col("_label"))).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _sql() -> str:
    def nearest(out: str, books: str) -> str:
        """The number of the nearest entry of each part: distances are whole, so a distance and an index fit one number."""
        return f"""{out} AS MATERIALIZED (SELECT r, part, x, m % {ENTRIES} AS entry, m // {ENTRIES} AS d FROM (
    SELECT r, part, x, min((list_dot_product(x, x) - 2 * list_dot_product(x, c) + list_dot_product(c, c))::BIGINT * {ENTRIES} + entry) AS m
    FROM parts JOIN {books} USING (part) GROUP BY r, part, x))"""

    steps = []
    for n in range(1, ROUNDS + 1):
        steps += [nearest(f"a{n}", f"b{n - 1}"),
                  f"""m{n} AS (SELECT part, entry, j, floor(sum(x[j]) / count(*)) AS c FROM a{n}, (SELECT unnest(range(1, 17)) AS j) GROUP BY part, entry, j),
b{n} AS MATERIALIZED (SELECT part, entry, coalesce(n.c, o.c) AS c FROM b{n - 1} o LEFT JOIN
    (SELECT part, entry, list(c ORDER BY j) AS c FROM m{n} GROUP BY part, entry) n USING (part, entry))"""]
    last = f"b{ROUNDS}"
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r, vec_id, label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT r, part, v[part * 16 + 1:part * 16 + 16] AS x FROM kept, (SELECT unnest(range({PARTS})) AS part)),
b0 AS (SELECT part, r AS entry, x AS c FROM parts WHERE r < {ENTRIES}),
{", ".join(steps)},
{nearest("last", last)},
whole AS (SELECT vec_id, label, string_agg(lpad(lower(hex(entry)), 2, '0'), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
    FROM last JOIN kept USING (r) GROUP BY r, vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT sha256(string_agg(
    array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY part, entry)) FROM {last}) AS codebooks_sha256 FROM whole"""


@query(_sql())
def op12_vector_codes(spark, sf_dir):
    return codes(table(spark, sf_dir, "embeddings"))
