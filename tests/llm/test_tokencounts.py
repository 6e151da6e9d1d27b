"""Token counts against the tokenizers library."""

import json
import random

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import tokencounts as t
from tidemark.llm.queries import QUERIES

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def plain(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def counter():
    return t.Counter(t.read_tokenizer(PATH))


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_library(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    counts = plain(library, [r.text or "" for r in docs])
    want = {r.doc_id: (len((r.text or "").encode()), n, n > 512) for r, n in zip(docs, counts)}
    df = QUERIES["op13_token_counts"].run(spark, sf_dir)
    assert df.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in df.collect()} == want


def test_odd_texts(library, counter):
    rng = random.Random(3)
    letters = "aabcdehilnorst '\n\t\r.0179éßÅ漢\U0001F600 ́​<|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 80))) for _ in range(800)]
    special = "<|endoftext|>"
    texts += ["", special, special * 3, f"a{special}b", f" {special} ", f"<|endoftext|{special}|>", "<|endoftext|", f"don't{special}we'll",
              "a" * 30_000, "ab" * 9000, "\n" * 5000, "é" * 4000, "0123456789" * 700, "aaab" * 3333, "  x  \n\n  y"]
    assert [counter.text(x) for x in texts] == plain(library, texts)


def test_glued_tokens(library, counter):
    """Words that the vocabulary can build in several ways."""
    rng = random.Random(4)
    parts = [w for w in json.load(open(PATH))["model"]["vocab"] if w.isascii() and w.isalpha()]
    texts = ["".join(rng.choices(parts, k=rng.randint(2, 7))) for _ in range(5000)]
    assert [counter.text(x) for x in texts] == plain(library, texts)


def test_few_remembered_words_change_nothing(library, monkeypatch):
    monkeypatch.setattr(t, "_HELD_WORDS", 3)
    counter = t.Counter(t.read_tokenizer(PATH))
    texts = ["one two three four five one two"] * 3
    assert [counter.text(x) for x in texts] == plain(library, texts) and len(counter.known) <= 3


def test_odd_rows(spark, library):
    text = "long words " * 200_000
    rows = [(None, None), (1, ""), (2, "a b"), (2, "a b"), (3, text), (4, "<|endoftext|>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("x").alias(c) for c in ("N_tokens", "over_limit", "_text")])
    got = t.count_tokens(docs)
    assert got.columns == ["doc_id", "_text", "n_bytes", "n_tokens", "over_limit"]
    counts = plain(library, [x or "" for _, x in rows])
    want = sorted((repr(i), "x", len(x or ""), n, n > 512) for (i, x), n in zip(rows, counts))
    assert sorted((repr(r[0]), *r[1:]) for r in got.collect()) == want
    assert t.count_tokens(docs.limit(0)).count() == 0


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError):
        t.Counter(t.read_tokenizer(P.path("word_bpe_49k.json")))
