"""The pipeline, stage by stage and as a whole, against plain versions."""

import base64
import re
from collections import Counter, defaultdict

import duckdb
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken

import corpus_pipeline
from tidemark.llm import mixing, quality, secrets, similar
from tidemark.llm.common import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def sql_over(rows, sql):
    con = duckdb.connect()
    con.register("documents", pa.table({c: pa.array([r[i] for r in rows], pa.string() if c in ("text", "lang", "source") else pa.int64())
                                        for i, c in enumerate(COLUMNS)}))
    result = con.execute(sql)
    return [dict(zip([d[0] for d in result.description], r)) for r in result.fetchall()]


def plain_quality(rows):
    kept = {r["doc_id"] for r in sql_over(rows, quality._SQL) if r["kept"]}
    return [r for r in rows if r[0] in kept]


def plain_near(rows):
    """One row, of the smallest id, per component of exact Jaccard similarity of five-word shingles at 0.8."""
    sets, holders, parent = {}, defaultdict(list), {r[0]: r[0] for r in rows}

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    for r in rows:
        own = sets[r[0]] = similar.shingles((r[1] or "").encode()).tolist()
        shared = Counter(j for x in own for j in holders[x])
        for j, n in shared.items():
            if 100 * n >= 80 * (len(own) + len(sets[j]) - n):
                a, b = sorted((find(r[0]), find(j)))
                parent[b] = a
        for x in own:
            holders[x].append(r[0])
    return [r for r in rows if find(r[0]) == r[0]]


def plain_secrets(rows):
    found, owners, places = defaultdict(list), defaultdict(set), defaultdict(set)
    for i, text, _, source, _ in rows:
        for kind, (pattern, group, least) in secrets.KINDS.items():
            for m in re.finditer(pattern, text, re.ASCII):
                v = m.group(group)
                live = re.search("[0-9]", v) and re.search("[A-Za-z]", v) and len(set(v)) >= 10
                if len(v) >= least and (kind != "live" or live):
                    found[i].append((kind, m.start(), m.end(), v))
                    owners[v].add(source)
                    places[v].add((source, i))
    out = []
    for i, text, lang, source, n in rows:
        base = [(a, b) for k, a, b, _ in found[i] if k != "live"]
        hide = sorted((a, b) for k, a, b, v in found[i] if len(owners[v]) < 4 and len(places[v]) < 100 and (k != "live" or not any(c < b and d > a for c, d in base)))
        merged = []
        for a, b in hide:
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        clean, at = "", 0
        for a, b in merged:
            clean, at = clean + text[at:a] + "[SECRET]", b
        clean += text[at:]
        out.append((i, clean, lang, source, len(clean) if merged else n))
    return out


def plain_mix(rows):
    times = {r["doc_id"]: int(r["taken"] / r["size"] + 0.5) for r in sql_over(rows, mixing._SQL) if r["size"]}
    return [r for r in rows for _ in range(times.get(r[0], 0))]


def plain_tokens(rows):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = [library.encode_ordinary(r[1]) for r in rows]
    return [(r[0], r[2], r[3], len(t), t) for r, t in zip(rows, ids)]


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_every_stage(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    plain = [plain_quality, plain_near, plain_secrets, plain_mix, plain_tokens]
    for (name, stage), version in zip(corpus_pipeline.STAGES, plain):
        got = stored(stage(spark, docs, sf_dir), "stage")
        want = version(rows)
        found = [tuple(r) for r in got.collect()]
        assert Counter(map(repr, found)) == Counter(map(repr, want)), name
        if stage is not corpus_pipeline.tokenize:
            assert got.columns == COLUMNS
            assert 0 < len(want)
        docs, rows = got, want


def test_run(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "lang", "source", "n_tokens", "ids"]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select(*COLUMNS).collect()]
    want = plain_tokens(plain_mix(plain_secrets(plain_near(plain_quality(rows)))))
    assert Counter(map(repr, map(tuple, got.collect()))) == Counter(map(repr, want))


def test_stages_on_nothing_and_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    odd = [(None, None, None, None, None, "x"), (1, "", "en", "a", 0, "x"), (2, "word " * 12, None, None, 60, None), (2, "word " * 12, None, None, 60, None)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            got = stored(stage(spark, docs, ""), "odd")
            if not rows:
                assert got.count() == 0, name
            elif stage is not corpus_pipeline.tokenize:
                assert got.columns == COLUMNS
