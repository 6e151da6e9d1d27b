"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, with the results the docstrings name."""

import json
import math
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import chat, kdtree, licenses, mixing, quality, secrets, urls

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    """rows: (doc_id, text, source)."""
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


def clashing(df):
    """Columns named like what operators make inside."""
    for name in ("_hash", "kept", "size", "_words", "found", "start", "key", "spans", "_m", "host", "Rule"):
        df = df.withColumn(name, F.lit("x"))
    return df


SECRET = "token = 'Zq8rT1xW9mK2bV7nC4pL'"


# --- secrets

def test_secrets_spans_overlap_and_fail(spark):
    text = f"é {SECRET} secret=abc AKIA{'Q' * 15} AKIA{'Q' * 16} {'0f' * 12} PASSWORD:\"hunter22\" secret=token = abcdefgh"
    rows = [(1, text, "a"), (1, text, "a"), (None, None, None), (2, "", "b"), (3, "x" * 300_000 + " " + SECRET, "b")]
    got = {(r.doc_id, r.n_assign): r for r in secrets.find_secrets(clashing(docs_of(spark, rows))).collect()}
    one = got[1, 2]
    pieces = [(k, text[int(a):int(b)]) for k, a, b in (s.split(":") for s in one.spans.split(","))]
    assert pieces == [("assign", SECRET[:-1]), ("access", f"AKIA{'Q' * 16}"), ("hex", "0f" * 12), ("assign", 'PASSWORD:"hunter22')]
    assert (one.n_access, one.n_hex) == (1, 1)
    assert secrets.find_secrets(docs_of(spark, rows)).count() == 5
    assert got[None, 0].spans == got[2, 0].spans == "" and got[3, 1].spans == f"assign:300001:{300001 + len(SECRET) - 1}"


def test_secrets_ownership_decides(spark):
    rare, common = "Ab3Cd5Ef7Gh9Jk2Lm4Np6Qr8", "Xy1Zw2Vu3Ts4Rq5Po6Nm7Lk8"
    rows = [(i, f"see {common} here, token={common}", f"owner{i}") for i in range(6)] + [(10, f"use {rare} now", "owner1"), (11, f"use {rare} now", "owner1")]
    docs = docs_of(spark, rows)
    got = {r.doc_id: r for r in secrets.find_secrets(docs).collect()}
    assert [got[i].n_live for i in (0, 10, 11)] == [0, 1, 1] and got[0].n_examples == 1 and got[0].n_assign == 1
    clean = {r.doc_id: r for r in secrets.redact(docs).collect()}
    assert clean[10].text == "use [SECRET] now" and clean[10].n_chars == 16 and clean[0].text == rows[0][1]


@pytest.mark.parametrize("owners", [1, 2, 3])
def test_a_value_in_many_documents_is_an_example(spark, owners):
    common, rare = "Ab3Cd5Ef7Gh9Jk2Lm4Np6Qr8", "Xy1Zw2Vu3Ts4Rq5Po6Nm7Lk8"
    rows = [(i, f"see {common} here", f"owner{i % owners}") for i in range(3000)] + [(5000 + i, f"my {rare} is", "owner0") for i in range(20)]
    got = {r.doc_id: r.n_live for r in secrets.find_secrets(docs_of(spark, rows)).collect()}
    assert {got[i] for i in range(3000)} == {0} and {got[5000 + i] for i in range(20)} == {1}
    clean = secrets.redact(docs_of(spark, rows)).where("text LIKE '%[SECRET]%'")
    assert sorted(r.doc_id for r in clean.collect()) == list(range(5000, 5020))


def test_redaction_merges_overlaps_and_keeps_the_rest(spark):
    rows = [(1, f"a {SECRET} b", "s"), (None, None, "s"), (2, "token=" + "0f" * 20 + "\nend", "s"), (2, "", None)]
    got = sorted((r.doc_id or 0, r.text) for r in secrets.redact(clashing(docs_of(spark, rows))).collect() if r.text)
    assert got == [(1, "a [SECRET]' b"), (2, "[SECRET]\nend")]
    assert secrets.redact(docs_of(spark, rows).limit(0)).count() == 0


# --- mixing

def test_mix_reaches_targets_with_a_hot_source(spark):
    rows = [(i, "w " * (1 + i % 37), "hot" if i % 3 else f"s{i % 11}") for i in range(1500)] + [(None, "", None), (7, None, "hot")]
    got = mixing.mix(clashing(docs_of(spark, rows)), block_words=16).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 2 * r.size for r in got)
    for target in {r.target for r in got}:
        own = [r for r in got if r.target == target]
        assert sum(r.taken for r in own) % math.floor(target or 1) == 0
    again = mixing.mix(docs_of(spark, rows).repartition(5), block_words=64).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_slots_of_documents(spark):
    """The words that slots take of a source's documents, and the same slots whatever the partitions."""
    rows = [(i, "w " * (1 + i % 37), "hot" if i % 3 else f"s{i % 11}") for i in range(600)] + [(None, "", None), (7, None, "hot")]
    got = mixing.mix(clashing(docs_of(spark, rows)), block_words=16, slots_too=True).collect()
    assert all((r.first_slot is None) == (r.last_slot is None) == (r.taken == 0) for r in got)
    assert all(r.first_slot <= r.last_slot for r in got if r.taken)
    assert all(r.first_slot < r.last_slot for r in got if r.taken > r.size)  # what comes again comes in a later slot
    again = mixing.mix(docs_of(spark, rows).repartition(5), block_words=16, slots_too=True).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_schedule_is_spread(spark):
    """Every stretch of the mix has each source's share, but for a few slots."""
    rows = [(i, "w " * 50, "abc"[i % 3]) for i in range(600)]
    per = mixing.stored(mixing.targets(mixing.sized(docs_of(spark, rows))), "t")
    slots = sorted((r.slot, r.source_no) for r in mixing.schedule(per, 16).collect())
    n = {s: sum(1 for _, x in slots if x == s) for s in range(3)}
    for a in range(0, len(slots) - 200, 100):
        for s in range(3):
            part = sum(1 for _, x in slots[a:a + 200] if x == s)
            assert abs(part - 200 * n[s] / len(slots)) <= 8


def test_mix_of_nothing_and_whole_documents(spark):
    empty = docs_of(spark, [(1, "", "a")])
    assert mixing.mix(empty.limit(0)).count() == 0
    assert [(r.size, r.target, r.taken) for r in mixing.mix(empty).collect()] == [(0, 0.0, 0)]
    rows = [(i, "w " * 10, "ab"[i % 2]) for i in range(40)] + [(50, "x y", "b")] * 2
    out = mixing.mix_documents(clashing(docs_of(spark, rows)))
    words = {s: sum(len(r.text.split()) for r in out.collect() if r.source == s) for s in "ab"}
    goal = {r.source: r.target for r in mixing.targets(mixing.sized(docs_of(spark, rows))).collect()}
    assert out.columns == DOCS.replace(" long", "").replace(" string", "").split(", ")
    assert all(abs(words[s] - goal[s]) <= 10 for s in "ab")


# --- search

def test_search_ties_hot_vectors_and_odd_rows(spark):
    same = [(i, [0.5, -0.25]) for i in range(1, 400)]
    odd = [(0, [1.0, 0.0]), (50, [0.5, -0.25]), (100, [0.0, 0.0]), (150, None), (200, [float("nan"), 1.0]), (None, [1.0, 1.0]),
           (500, [1.0, 2.0, 3.0]), (501, [1e18, 1.0, 1.0]), (550, []), (600, [-1.0, 0.1]), (600, [-1.0, 0.1]), (650, [None, 1.0])]
    seen = {i for i, _ in odd}
    rows = [r for r in same if r[0] not in seen] + odd
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).withColumn("dims", F.lit(1))
    valid = {i: [math.floor(256 * x) for x in v] for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    valid[600] = [math.floor(256 * -1.0), math.floor(256 * 0.10000000149011612)]
    valid[501][0] = math.floor(256 * float(__import__("struct").unpack("f", __import__("struct").pack("f", 1e18))[0]))
    valid[501][0] = min(valid[501][0], 9200000000000000000)
    want = {}
    for q, v in valid.items():
        if q % 50 == 0:
            found = sorted((-min(sum(a * b for a, b in zip(v, w)), (1 << 63) - 1), i) for i, w in valid.items() if i != q and len(w) == len(v))[:5]
            want |= {(q, n + 1): (i, -s) for n, (s, i) in enumerate(found)}
    for shard_rows in (64, 8192):
        got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in kdtree.top_k(df, shard_rows=shard_rows).collect()}
        assert got == want
    assert kdtree.top_k(df.limit(0)).count() == 0


def test_rows_that_repeat_an_id_are_rows_of_their_own(spark):
    rows = [(50, [1.0]), (1, [2.0]), (1, [5.0]), (2, [3.0]), (100, [4.0]), (100, [4.0])]
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in kdtree.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), k=3, shard_rows=2).collect()]
    unit = 256 * 256
    assert sorted(x for x in got if x[0] == 50) == [(50, 1, 1, 5 * unit), (50, 2, 100, 4 * unit), (50, 3, 100, 4 * unit)]
    # each of the two rows of id 100 finds the other one
    assert sorted(x for x in got if x[0] == 100) == sorted(2 * [(100, 1, 1, 20 * unit), (100, 2, 100, 16 * unit), (100, 3, 2, 12 * unit)])


def test_a_task_walks_one_shard_after_another():
    """What a task found in its first shard must not be taken for the name of that shard."""
    batches = [pa.RecordBatch.from_pylist([
        {"dims": 1, "shard": shard, "is_query": asked, "vec_id": i, "v": [i], "floor_score": None, "floor_id": None, "row": i}
        for i in ids], schema=pa.schema([("dims", pa.int32()), ("shard", pa.int32()), ("is_query", pa.int32()), ("vec_id", pa.int64()),
                                         ("v", pa.list_(pa.int64())), ("floor_score", pa.int64()), ("floor_id", pa.int64()), ("row", pa.int64())]))
        for shard, asked, ids in ((0, 0, [1, 50]), (0, 1, [50]), (0, 1, [100]), (1, 0, [2, 3]), (1, 1, [50]))]
    got = [tuple(r.values()) for batch in kdtree._walk(1)(iter(batches)) for r in batch.to_pylist()]
    assert got == [(50, 50, 1, 50), (100, 100, 50, 5000), (50, 50, 3, 150)]


# --- urls

def test_hosts_of_very_many_labels(spark):
    rows = [("s://" + "a." * 100_000 + "spam-farm.example.com/x",), ("s://" + "b." * 100_000 + "net/fr/1",), ("s://" + "." * 100_000,)]
    got = {(r.rule, r.verdict, len(r.host)) for r in urls.judge_urls(spark.createDataFrame(rows, "url string")).collect()}
    assert got == {("com/", "allow", 200_021), ("net/fr/", "block", 200_003), (None, "allow", 100_000)}


def test_urls(spark):
    cases = {None: ("", "", None, "allow"), "no host": ("", "", None, "allow"), "http://": ("", "", None, "allow"),
             "http://A.COM": ("a.com", "", None, "allow"), "x://com/": ("com", "/", "com/", "allow"),
             "http://www.example.com/en/1?q": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
             "http://wwww.example.com/en/": ("wwww.example.com", "/en/", "example.com/en/", "block"),
             "http://xexample.com/en/": ("xexample.com", "/en/", "com/", "allow"),
             "http://example.com/en": ("example.com", "/en", "com/", "allow"),
             "s://a.net/es/#f": ("a.net", "/es/", "net/es/", "block"), "s://a.net/de/": ("a.net", "/de/", None, "allow"),
             "s://m.spam-farm.example.org/x": ("m.spam-farm.example.org", "/x", None, "block"),
             "s://h://i/": ("h:", "//i/", None, "allow"), "s://" + "a." * 300 + "net/fr/" + "x" * 9000: ("a." * 300 + "net", "/fr/" + "x" * 9000, "net/fr/", "block")}
    df = spark.createDataFrame([(u,) for u in cases] * 2, "url string")
    got = urls.judge_urls(clashing(df)).collect()
    assert len(got) == 2 * len(cases)
    assert {r.url: (r.host, r.path, r.rule, r.verdict) for r in got} == cases
    assert urls.judge_urls(df.limit(0)).count() == 0
    assert {r.verdict for r in urls.judge_urls(df, rules=(), blocked_hosts=("net",)).collect()} == {"allow", "block"}


def test_cascade_is_exact(spark):
    """Few bits make many mistakes on every level; the cascade has none."""
    universe = spark.range(20000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.where("key LIKE '%7'")
    built = urls.build_cascade(listed, universe.union(universe), 10)  # far too small a universe given
    assert len(built.levels) > 2
    wrong = universe.where(built.lists(F.col("key")) != F.col("key").like("%7"))
    assert wrong.count() == 0


# --- licenses

def test_licenses(spark):
    filler = "lorem ipsum dolor " * 20
    rows = [(1, f"{filler} Licensed under CC BY-NC 4.0. {filler}", "a"), (2, "see the MIT-License; or the mit\nlicense", "a"), (None, None, None),
            (3, "", "a"), (4, "released under the license", "a"), (5, "w " * 200_000 + "General Public License", "a"),
            (6, "This work is licensed under the GNU Public License, version 3", "a"), (6, "This work is licensed under the GNU Public License, version 3", "a")]
    got = {r.doc_id: r for r in licenses.scan_licenses(clashing(docs_of(spark, rows))).collect()}
    assert (got[1].labels, got[1].base_labels, got[1].n_base, got[1].score) == ("cc-by-nc", "", 0, 1.0)
    assert (got[2].labels, got[2].n_base, got[2].first_word, got[2].last_word) == ("mit", 2, 2, 6)
    assert (got[None].n_words, got[None].labels, got[3].score, got[4].labels, got[4].first_word) == (0, "", 0.0, "", None)
    assert (got[5].first_word, got[5].base_labels) == (200_000, "gpl")
    assert got[6].labels == "gpl" and got[6].base_labels == "" and 0.9 <= got[6].score < 1
    assert licenses.scan_licenses(docs_of(spark, rows)).count() == len(rows)
    assert licenses.scan_licenses(docs_of(spark, rows).limit(0)).count() == 0


# --- quality

def test_quality(spark):
    prose = [(i, " ".join(f"word{(i * 7 + k * k) % 1000}x" for k in range(60 + i % 40)), f"s{i % 3}") for i in range(90)]
    noisy = (100, " ".join(f"word{k}###" for k in range(80)), "s1")
    lines = (101, "\n".join(["some line that stands here"] * 30), "s1")
    rows = [*prose, noisy, lines, (None, None, None), (102, "", "s1"), (103, "a b c d e f g h i", "s1"), (104, "x" * 500_000, None), noisy]
    got = {r.doc_id: r for r in quality.judge(clashing(docs_of(spark, rows))).collect()}
    assert all(got[i].kept for i, _, _ in prose)
    assert not got[100].base_failed and not got[100].kept and got[101].base_failed and got[101].n_dup_lines == 29
    assert got[101].n_repeat_words == got[101].n_words == 150
    assert [got[i].base_failed for i in (None, 102, 103, 104)] == [True] * 4
    kept = quality.kept_documents(clashing(docs_of(spark, rows)))
    assert kept.count() == len(prose) and kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert quality.kept_documents(docs_of(spark, rows).limit(0)).count() == 0


def test_fences_follow_each_group(spark):
    """What is usual in one source is odd in another: the same share of symbols, the same long words."""
    rng, rows = random.Random(4), []
    for i in range(600):
        signs = rng.randint(8, 14) if i % 2 else 0  # code-like texts in source b
        rows.append((i, " ".join([f"plainword{rng.randint(0, 9)}{k}" for k in range(60)] + ["a|b"] * signs), "b" if i % 2 else "a"))
    rows += [(1000, " ".join([f"plainword{k}" for k in range(60)] + ["a|b"] * 10), "a"), (1001, " ".join([f"plainword{k}" for k in range(60)] + ["a|b"] * 10), "b"),
             (1002, " ".join(["thisisaverylongwordindeed" + str(k) for k in range(60)]), "a")]
    got = {r.doc_id: r.kept for r in quality.judge(docs_of(spark, rows)).collect()}
    assert all(got[i] for i in range(600)) and (got[1000], got[1001], got[1002]) == (False, True, False)


def test_sketches_merge(spark, sf):
    docs = quality.cheap_measures(spark.read.parquet(f"{sf}/documents.parquet"))
    keys = ["lang", "source", "measure", "bin"]
    parts = quality.sketch(docs.where("doc_id % 2 = 0")).union(quality.sketch(docs.where("doc_id % 2 = 1")))
    merged = parts.groupBy(*keys).agg(F.sum("n").alias("n"))
    assert sorted(map(str, merged.collect())) == sorted(map(str, quality.sketch(docs).collect()))


def test_license_texts_of_any_length(spark):
    """A template of many words is cut into pieces; a text that holds one of them is labelled, single words are not enough."""
    words = [f"clause{i}" for i in range(150)]
    pieces = licenses.cut_templates([("long", " ".join(words)), ("short", "Some Rights"), ("none", " .")], 32)
    assert [len(t.split()) for _, t in pieces] == [30] * 5 + [2] and " ".join(t for label, t in pieces if label == "long").split() == words
    changed = words[:60]
    changed[3], changed[40] = "other", "words"
    rows = [(1, "x " * 500 + " ".join(words) + " y" * 500, "a"), (2, " ".join(changed), "a"), (3, " ".join(words[::4]), "a"), (4, None, "a")]
    got = {r.doc_id: r.labels for r in licenses.scan_licenses(docs_of(spark, rows), [("long", " ".join(words))]).collect()}
    assert got == {1: "long", 2: "long", 3: "", 4: ""}


# --- chat

def test_chat_faults_order_and_circles(spark):
    calls = [("a", "t", '{"n": 1, "s": "x"}', None), ("b", "t", '{"s": "y", "n": 2, "z": 0}', "a"), ("c", "t", '{"n": "1"}', "b"),
             ("d", "t", "[1]", "c"), ("e", "u", "{}", "gone"), ("f", "t", None, "f"), ("x", "t", '{"n":1,"s":""}', "y"), ("y", "t", '{"n":1,"s":""}', "x"),
             ("z", "t", '{"n":1,"s":null}', "y"), (None, "t", "{", None), ("a", "t", '{"n": 1, "s": "x"}', None)]
    results = [("a", "1"), ("a", "2"), ("q", None), (None, "r"), ("b", None)]
    schema = {"t": {"n": ("integer", True), "s": ("string", True)}}
    got = {(r.call_id, r.status): r for r in chat.link_calls(
        spark.createDataFrame(calls, "call_id string, name string, arguments string, after string").withColumn("level", F.lit(9)),
        spark.createDataFrame(results, "call_id string, content string"), schema).collect()}
    assert {k: (r.level, r.errors) for k, r in got.items()} == {
        ("a", "linked"): (0, ""), ("b", "linked"): (1, "unknown z"), ("c", "no_result"): (2, "missing s; n is not integer"),
        ("d", "no_result"): (3, "arguments are no object"), ("e", "no_result"): (0, "unknown tool"), ("f", "no_result"): (0, "arguments are no object"),
        ("x", "no_result"): (None, ""), ("y", "no_result"): (None, ""), ("z", "no_result"): (None, "s is not string"),
        (None, "no_result"): (None, "arguments are no object"), ("q", "no_call"): (None, ""), (None, "no_call"): (None, ""),
        ("a", "no_call"): (None, "")}
    a, more = got["a", "linked"], got["a", "no_call"]
    assert (a.ordinal, a.n_calls, a.n_results) == (1, 2, 1)  # the calls are alike, the results are not
    assert (more.ordinal, more.n_calls, more.n_results, json.loads(more.json)["result"]) == (2, 0, 1, "2")
    assert a.json == '{"arguments":{"n":1,"s":"x"},"id":"a","level":0,"name":"t","result":"1","status":"linked","valid":true}'
    assert all(json.loads(r.json)["status"] == s for (_, s), r in got.items())


def test_chat_loses_no_content(spark):
    """Many calls and results under one identifier and under none, very long ones too."""
    long = "x " * 200_000
    calls = [("a", "t", f'{{"n":{i % 40}}}', None) for i in range(400)] + [(None, "t", f'{{"n":{i}}}', "a") for i in range(300)]
    results = [("a", f"r{i}") for i in range(60)] + [("a", long)] + [(None, f"r{i % 50}") for i in range(300)]
    got = chat.link_calls(spark.createDataFrame(calls, "call_id string, name string, arguments string, after string").withColumn("ordinal", F.lit(7)),
                          spark.createDataFrame(results, "call_id string, content string"), {"t": {"n": ("integer", True)}}).collect()
    own = [r for r in got if r.call_id == "a"]
    assert sorted(r.ordinal for r in own) == list(range(1, 62))
    assert [sum(r.status == s for r in own) for s in ("linked", "no_result", "no_call")] == [40, 0, 21]
    found = [json.loads(r.json) for r in own]
    assert {f["arguments"]["n"] for f in found if "arguments" in f} == set(range(40)) and all(r.n_calls == 10 for r in own if r.name)
    assert {f["result"] for f in found} == {long, *(f"r{i}" for i in range(60))}
    none = [r for r in got if r.call_id is None]
    assert all(r.ordinal is None and r.level is None for r in none)
    assert sorted((r.status, r.n_calls, r.n_results) for r in none) == [("no_call", 0, 6)] * 50 + [("no_result", 1, 0)] * 300


def test_chat_long_way(spark):
    n = 300
    calls = spark.createDataFrame([(str(i), "t", "{}", str(i - 1)) for i in range(n)], "call_id string, name string, arguments string, after string")
    none = spark.createDataFrame([], "call_id string, content string")
    assert {r.call_id: r.level for r in chat.link_calls(calls, none, {}).collect()} == {str(i): i for i in range(n)}
    assert chat.link_calls(calls.limit(0), none, {}).count() == 0
