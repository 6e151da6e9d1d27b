"""Byte-level BPE against the tiktoken library, and exact round trips."""

import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from tidemark.llm import bpe
from tidemark.llm.queries import QUERIES

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.read_ranks(PATH))


def tokens(vocabulary, text):
    words = bpe.regex.findall(P.PATTERN, text)
    distinct = sorted(set(words))
    ids, counts = vocabulary.replay([w.encode() for w in distinct])
    stops = counts.cumsum()
    of = {w: ids[b - n:b].tolist() for w, b, n in zip(distinct, stops, counts)}
    return [t for w in words for t in of[w]]


def test_query_matches_library(spark, sf, library):
    digest = lambda data: hashlib.sha256(data).hexdigest()
    want = {}
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode_ordinary(r.text or "")
        want[r.doc_id] = (len(ids), digest(" ".join(map(str, ids)).encode()), digest((r.text or "").encode()))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op2_byte_bpe"].run(spark, sf).collect()}
    assert got == want


def test_odd_texts(library, vocabulary):
    rng = random.Random(1)
    letters = "aabcdehilnorst '\n\t.0179é漢\U0001F600 "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(600)]
    texts += ["a" * n for n in range(1, 70)] + ["ab" * 33, "  \n \n\n x", "don't we'll I'M", "<|endoftext|>", "x" * 20000]
    for text in texts:
        assert tokens(vocabulary, text) == library.encode_ordinary(text), repr(text)


def test_words_whose_merges_come_out_of_order(library, vocabulary):
    """Glued tokens give many ways to build a token; the words encoded alone are among them."""
    rng = random.Random(2)
    parts = [t.decode() for t in vocabulary.ranks if t.isalpha() and t.isascii()]
    words = {"".join(rng.choice(parts) for _ in range(rng.randint(2, 6))) for _ in range(20000)}
    data = [w.encode() for w in sorted(words)]
    ids, counts = vocabulary.replay(data)
    stops = counts.cumsum()
    for w, b, n in zip(data, stops, counts):
        want = library.encode_ordinary(w.decode())
        assert ids[b - n:b].tolist() == want
        if w not in vocabulary.ranks:
            assert vocabulary.alone(w) == want


def test_rows(spark, library):
    rows = [(1, None, "k"), (2, "", "k"), (None, "hello world", None), (2, "hello  world", "k"), (2, "hello  world", "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _text string").repartition(1)
    found = bpe.encode(docs, block_chars=5)
    assert found.columns == ["doc_id", "_text", "ids"]
    got = sorted(((r.doc_id or 0, r.ids) for r in found.collect()), key=repr)
    assert got == sorted([(i or 0, library.encode_ordinary(t or "")) for i, t, _ in rows], key=repr)
    back = sorted(bytes(r.decoded) for r in bpe.decode(found).collect())
    assert back == sorted((t or "").encode() for _, t, _ in rows)
    assert bpe.decode(bpe.encode(docs.limit(0))).count() == 0


def test_words_split_as_in_the_library(library, vocabulary):
    """Every code point next to letters, digits, spaces and itself."""
    for start in range(0, 0x110000, 8192):
        text = "".join(f"a{c} {c}1{c}{c}b" for c in map(chr, range(start, start + 8192)) if not 0xD800 <= ord(c) < 0xE000)
        assert tokens(vocabulary, text) == library.encode_ordinary(text), hex(start)
