"""SimHash near-duplicates against a brute-force version."""

import random
import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import simhash as s
from tidemark.llm.components import components
from tidemark.llm.queries import QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_print(text: str | None) -> int:
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def plain_components(prints: dict[int, int]) -> dict[int, int]:
    """Smallest reachable key for each key, by comparing all pairs."""
    parent = {k: k for k in prints}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k
    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: find(k) for k in keys}


def test_query_matches_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: plain_print(r.text) for r in docs}
    want = plain_components(prints)
    got = {r.doc_id: r for r in QUERIES["op6_simhash_near_dedup"].run(spark, sf).collect()}
    assert {k: f"{v:016x}" for k, v in prints.items()} == {k: r.fingerprint for k, r in got.items()}
    assert want == {k: r.component_id for k, r in got.items()}
    assert len(set(want.values())) < len(want)


@pytest.mark.parametrize("limit", [3, 20, s.LIST_LIMIT])
def test_links_of_crowded_lists(spark, limit):
    """Clusters around a few centres: long lists take the other way and give the same components."""
    rng = random.Random(limit)
    prints = set()
    for _ in range(5):
        centre = rng.getrandbits(64)
        for _ in range(60):
            v = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                v ^= 1 << b
            prints.add(v)
    prints |= {rng.getrandbits(64) for _ in range(50)}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in prints]
    edges = s.links(spark.createDataFrame(signed, "fingerprint long"), list_limit=limit)
    for a, b in edges.collect():
        assert ((a ^ b) & (1 << 64) - 1).bit_count() <= 4
    roots = {r.node: r.root for r in components(edges).collect()}
    want = plain_components({v[0]: v[0] & (1 << 64) - 1 for v in signed})
    assert {k: roots.get(k, k) for k in want} == want


def test_odd_rows_and_one_of_each(spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(5, text), (3, text), (None, text), (3, text), (7, None), (8, ""), (9, " \n"), (None, "alone in here"), (2, "a b"), (4, "A B")]
    docs = spark.createDataFrame([(i, t, "en", None, 1) for i, t in rows], DOCS).withColumn("root", F.lit("x")).withColumn("_id", F.lit(0))
    got = defaultdict(set)
    for r in s.near_duplicates(docs).collect():
        got[r.component_id].add(r.doc_id)
    assert got == {3: {5, 3, None}, 7: {7, 8, 9}, None: {None}, 2: {2, 4}}
    kept = s.one_of_each(docs).collect()
    assert sorted((r.doc_id is None, r.doc_id) for r in kept) == [(False, 2), (False, 3), (False, 7), (True, None)]
    assert s.one_of_each(docs).columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert s.near_duplicates(docs.limit(0)).count() == 0


def test_long_text_and_chunks(monkeypatch):
    text = " ".join(str(i % 977) for i in range(5000))
    whole = s.simhash(text.encode())
    monkeypatch.setattr(s, "_CHUNK", 100)
    assert s.simhash(text.encode()) == whole == plain_print(text)


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 160)] + [(1, k) for k in range(2, 50)] + [(3, 3), (2, 1), (60, 50)]
    got = {r.node: r.root for r in components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 1 for i in range(1, 50)}, 50: 50, 60: 50}
