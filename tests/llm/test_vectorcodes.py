"""Vector codes against plain Lloyd rounds; the bounds; odd rows."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import vectorcodes as t

ROWS = "vec_id long, embedding array<double>, label int"


def plain(rows, parts, entries, rounds):
    """Rows of (vec_id, code, error, label_error, codebooks_sha256), every distance computed, in whole numbers."""
    kept = [(i, [math.floor(1024 * x) for x in v], y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    found = []
    for size in sorted({len(v) for _, v, _ in kept}):
        own = [r for r in kept if len(r[1]) == size]
        spans = t.cuts(size, parts)
        books = [[v[a:b] for _, v, _ in own[:entries]] for a, b in spans]

        def nearest(x, book):
            d = [sum((p - q) ** 2 for p, q in zip(x, e)) for e in book]
            return min(range(len(d)), key=lambda e: (d[e], e)), min(d)
        for _ in range(rounds):
            for p, (a, b) in enumerate(spans):
                members = defaultdict(list)
                for _, v, _ in own:
                    members[nearest(v[a:b], books[p])[0]].append(v[a:b])
                for e, xs in members.items():
                    books[p][e] = [sum(c) // len(xs) for c in zip(*xs)]
        digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
        for i, v, y in own:
            near = [nearest(v[a:b], books[p]) for p, (a, b) in enumerate(spans)]
            found.append((i, "".join(f"{e:02x}" for e, _ in near), sum(d for _, d in near), y, digest))
    total = Counter()
    for _, _, d, y, _ in found:
        total[y] += d
    return Counter((i, c, d, total[y], h) for i, c, d, y, h in found)


def coded(spark, rows, **options):
    df = spark.createDataFrame(rows, ROWS).select("*", *[F.lit("x").alias(c) for c in ("v", "code", "Entry", "_label", "size")])
    return Counter(tuple(r) for r in t.codes(df, **options).collect())


@pytest.mark.parametrize("listed", [1, 6, 32])
def test_against_plain_rounds(spark, listed):
    rng = np.random.default_rng(listed)
    points = rng.normal(size=(400, 10)) * 0.02
    points[200:300] = points[rng.integers(0, 40, 100)]  # repeated vectors: ties
    rows = [(int(i), v.tolist(), int(i) % 3 if i % 7 else None) for i, v in zip(rng.permutation(400), points)]
    assert coded(spark, rows, entries=20, listed=listed) == plain(rows, 4, 20, 4)


def test_bounds_hold_and_save_work():
    """After every move the bounds enclose the true distances, and most parts of clustered data are settled by their lists."""
    rng = np.random.default_rng(7)
    centres = rng.integers(-500, 500, (30, 8))
    points = centres[rng.integers(0, 30, 3000)] + rng.integers(-20, 20, (3000, 8))
    book = points[:30].copy()
    bounds, looked = t.Bounds.fresh(points, book, 8), []
    for _ in range(5):
        new = np.stack([np.floor(points[bounds.entry == e].mean(0)) if (bounds.entry == e).any() else book[e] for e in range(30)]).astype(np.int64)
        drift = np.sqrt(((new - book) ** 2).sum(1)) * t._UP
        book = new
        bounds, need = bounds.moved(points, book, drift, 8)
        far = np.sqrt(t.squared(points, book))
        rows = np.arange(3000)
        assert (bounds.entry == far.argmin(1)).all() and (bounds.upper >= far[rows, bounds.entry]).all()
        rest = far.copy()
        rest[rows, bounds.entry] = np.inf
        assert (bounds.low[:, 0] <= rest.min(1)).all()
        for z in range(8):
            np.put_along_axis(rest, bounds.near[:, z:z + 1], np.inf, 1)
            assert (bounds.low[:, z] <= rest.min(1)).all()
        assert (bounds.outer <= rest.min(1)).all()
        looked.append((need > 8).mean())
    assert looked[-1] < 0.05


def test_lists_cut_and_filled_up_still_hold():
    rng = np.random.default_rng(8)
    points, book = rng.integers(-300, 300, (2000, 4)), rng.integers(-300, 300, (40, 4))
    bounds = t.Bounds.fresh(points, book, 6)
    for listed in (6, 12, 3, 5, 20):
        new = book + rng.integers(-9, 9, book.shape)
        bounds, need = bounds.moved(points, new, np.sqrt(((new - book) ** 2).sum(1)) * t._UP, listed)
        book = new
        exact = t.squared(points, book)
        assert bounds.near.shape == (2000, listed) and (bounds.entry == exact.argmin(1)).all() and need.max() <= listed + 1
        far = np.sqrt(exact)
        far[np.arange(2000), bounds.entry] = np.inf
        for z in range(listed):
            assert (bounds.low[:, z] <= far.min(1)).all()
            own = bounds.near[:, z] != bounds.entry
            far[np.flatnonzero(own), bounds.near[own, z]] = np.inf
        assert (bounds.outer <= far.min(1)).all()


def test_list_length_adapts():
    assert t.adapted({0: 500, 1: 490, 7: 10}, 16, 256) == 4  # nearly all settled, by few
    assert t.adapted({0: 500, 9: 490, 17: 1}, 16, 256) == 9
    assert t.adapted({3: 600, 17: 400}, 16, 256) == 32  # many not settled
    assert t.adapted({3: 600, 65: 400}, 64, 256) == 64  # a quarter of the entries at most
    assert t.adapted({3: 10, 17: 990}, 16, 256) == 16  # no list would help
    assert t.adapted({}, 0, 1) == 0


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, 0.25], 1), (1, [0.5, 0.25], 1), (1, [0.1, -0.2], None), (None, [0.3, 0.0], None), (2, None, 1), (3, [None, 1.0], 1),
            (4, [nan, 1.0], 2), (5, [inf, 0.0], 2), (6, [], 2), (7, [], None), (8, [1e30, -1e30], 3), (9, [3e9, 3e9], 3), (10, [1.0] * 9, 4)]
    got = coded(spark, rows, entries=3)
    want = plain([r for r in rows if r[0] != 8], 4, 3, 4)
    assert sum(got.values()) == 9 and {r[0] for r in got} == {1, None, 6, 7, 8, 9, 10}
    assert {r[:3] for r in got if r[0] in (6, 7, 10)} == {r[:3] for r in want if r[0] in (6, 7, 10)}
    assert all(0 <= r[2] <= r[3] for r in got)
    assert coded(spark, rows[:4] + rows[11:12], entries=256) == plain(rows[:4] + rows[11:12], 4, 256, 4)
    assert coded(spark, rows[4:8]) == Counter() and coded(spark, []) == Counter()


def test_fewer_vectors_than_entries_code_themselves(spark):
    rows = [(i, [i / 100, 0.0, i / 50, 1.0], i % 2) for i in range(40)]
    got = coded(spark, rows)
    assert got == plain(rows, 4, 256, 4) and {r[2] for r in got} == {0}
