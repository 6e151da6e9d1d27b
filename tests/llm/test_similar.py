"""The pipeline's near copies against exact Jaccard similarity of five-word shingles."""

import random
from collections import defaultdict

import pytest

from tidemark.llm import similar, simhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_set(text: str) -> set[str]:
    w = text.split()
    return {" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def jaccard(a: str, b: str) -> float:
    x, y = plain_set(a), plain_set(b)
    return len(x & y) / len(x | y)


def varied(rng, text: str, n: int) -> str:
    w = text.split()
    for i in rng.sample(range(len(w)), n):
        w[i] = f"new{rng.getrandbits(40)}"
    return " ".join(w)


def test_near_copies_beyond_four_bits_are_dropped(spark):
    """Copies at 0.8 to 0.95 that differ in more bits than op6 allows: one of each group stays; pairs below 0.8 stay."""
    rng, rows = random.Random(5), []
    for k in range(60):
        base = " ".join(f"w{rng.getrandbits(30)}" for _ in range(200))
        rows += [(10 * k, base), (10 * k + 1, varied(rng, base, 3 if k % 2 else 12))]
    near = [k for k in range(60) if jaccard(rows[2 * k][1], rows[2 * k + 1][1]) >= 0.8]
    assert 20 <= len(near) <= 40
    apart = [k for k in near if (simhash.simhash(rows[2 * k][1].encode()) ^ simhash.simhash(rows[2 * k + 1][1].encode())).bit_count() > 4]
    assert len(apart) >= 10
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    kept = {r.doc_id for r in simhash.one_of_each(docs).collect()}
    assert kept == {i for i, _ in rows} - {10 * k + 1 for k in near}


@pytest.mark.parametrize("small", [2, 8])
def test_large_groups_stay_linked(spark, monkeypatch, small):
    monkeypatch.setattr(similar, "SMALL", small)
    rng, rows = random.Random(small), []
    for k in range(3):
        base = " ".join(f"w{rng.getrandbits(30)}" for _ in range(300))
        rows += [(100 * k + n, varied(rng, base, 2)) for n in range(40)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    groups = defaultdict(set)
    for r in similar.near_copies(docs).collect():
        groups[r.root].add(r.doc_id)
    assert sorted(map(sorted, groups.values())) == [list(range(100 * k, 100 * k + 40)) for k in range(3)]


def groups_of(spark, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    groups = defaultdict(set)
    for r in similar.near_copies(docs).collect():
        groups[r.root].add(r.doc_id)
    return sorted(map(sorted, groups.values()))


def plain_groups(rows):
    """Components of exact similarity, every pair compared."""
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    sets = [(i, plain_set(t or "")) for i, t in rows]
    for n, (i, x) in enumerate(sets):
        for j, y in sets[n + 1:]:
            if len(x & y) * 100 >= 80 * len(x | y):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    found = defaultdict(list)
    for i, _ in rows:
        found[find(i)].append(i)
    return sorted(map(sorted, found.values()))


@pytest.mark.parametrize("small, changes", [(2, (0, 1, 2)), (8, (1, 3, 4)), (2, (2, 5, 6)), (8, (0, 4, 8))])
def test_crowded_groups_against_all_pairs(spark, monkeypatch, small, changes):
    """Families whose members are partly alike, directly or through others, and share buckets with members that are not."""
    monkeypatch.setattr(similar, "SMALL", small)
    rng, rows = random.Random(10 * small + sum(changes)), []
    for k in range(2):
        base = " ".join(f"w{rng.getrandbits(30)}" for _ in range(220))
        branch = varied(rng, base, 5)
        for n in range(30):
            rows.append((100 * k + n, varied(rng, rng.choice([base, branch]), rng.choice(changes)) + " tail" * rng.choice([0, 0, 9])))
    assert groups_of(spark, rows) == plain_groups(rows)


def test_unlinked_crowds_make_few_pairs(spark, monkeypatch):
    """Variants of one text that share buckets but lie well below 0.8: the rows compared stay far below the pairs."""
    compared, work = [], {}
    real = similar._within
    monkeypatch.setattr(similar, "_within", lambda small, *a: compared.append(small.count()) or real(small, *a))
    for n in (150, 600):
        rng = random.Random(3)
        base = " ".join(f"w{rng.getrandbits(30)}" for _ in range(300))
        sets = [(i, similar.shingles(varied(rng, base, 7).encode())) for i in range(n)]
        nodes = spark.createDataFrame([(i, len(x), [b - (1 << 64) if b >> 63 else b for b in similar._bands(x)]) for i, x in sets], "node long, size long, bands array<long>")
        own = spark.createDataFrame([(i, x.view("int64").tolist()) for i, x in sets], "node long, own array<long>")
        compared.clear()
        found, pairs = similar.candidates(similar.stored(nodes, "t"), similar.stored(own, "t"))
        assert found.count() == 0
        work[n] = pairs.count() + sum(compared)
    assert 20 * work[600] <= 600 * 599 // 2


def test_far_variants_are_left_out_before_lists_are_made(spark, monkeypatch):
    """Variants whose numbers alone rule out a partner go into no smaller list, however many of them there are."""
    made, real = [], similar.stored

    def counting(df, name):
        df = real(df, name)
        if name == "first":
            made.append(df.count())  # the step removes it
        return df
    monkeypatch.setattr(similar, "stored", counting)
    for n in (40, 160):
        rng = random.Random(3)
        base = " ".join(f"w{rng.getrandbits(30)}" for _ in range(300))
        sets = [(i, similar.shingles(varied(rng, base, 1 if i < 12 else 9).encode())) for i in range(n)]
        lists = spark.createDataFrame([(1, i, len(x)) for i, x in sets], "list long, node long, size long")
        own = spark.createDataFrame([(i, x.view("int64").tolist()) for i, x in sets], "node long, own array<long>")
        made.clear()
        sure, _ = similar._split(lists, real(own, "t"), similar.PERCENT)
        assert {r.a for r in sure.collect()} | {r.b for r in sure.collect()} == set(range(12))
        assert sum(made) <= n // 2


def test_the_fingerprint_index_links_copies_by_itself(spark, monkeypatch):
    """Without what bands give, copies within four bits are linked, and no others."""
    monkeypatch.setattr(similar, "candidates", lambda nodes, sets, percent, known: (known, known.limit(0)))
    rng, rows, want = random.Random(9), [], []
    for k in range(0, 80, 2):
        base = " ".join(f"w{rng.getrandbits(30)}" for _ in range(250))
        rows += [(k, base), (k + 1, varied(rng, base, 1 + k % 3))]
        a, b = (simhash.majority(similar.shingles(t.encode())) for _, t in rows[-2:])
        want += [[k, k + 1]] if (a ^ b).bit_count() <= 4 else [[k], [k + 1]]
    assert 45 < len(want) < 75
    assert groups_of(spark, rows) == want


def test_odd_texts_are_grouped(spark):
    long = " ".join(f"v{i}" for i in range(120_000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a b"), (5, "A B"), (6, long), (7, long + " more"), (8, long), (8, long), (9, "x" * 300_000)]
    assert groups_of(spark, rows) == [[1, 2, 3], [4, 5], [6, 7, 8], [9]]
    docs = spark.createDataFrame([(1, "a b c d e f", "en", "s", 1)], DOCS)
    for name in ("node", "list", "size", "bands", "_x"):
        docs = docs.withColumn(name, similar.F.lit("x"))
    assert similar.near_copies(docs).columns == ["doc_id", "_id", "_hash", "root"] and similar.near_copies(docs.limit(0)).count() == 0
