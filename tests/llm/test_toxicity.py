"""Toxicity: the split, held-out accuracy, restored obfuscation, odd rows."""

import random
import zlib
from itertools import product

import numpy as np
import pytest

from tidemark.llm import toxicity as t
from tidemark.llm.queries import QUERIES


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    return t.fit(docs, spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic"))


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in QUERIES["op10_toxicity"].run(spark, sf).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
               for i, r in got.items())
    labels = [(r.doc_id, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()]
    held = [(got[i].predicted, y) for i, y in labels if got[i].held_out]
    caught = sum(p for p, y in held if y) / sum(y for _, y in held)
    wrong = sum(p for p, y in held if not y) / sum(1 - y for _, y in held)
    assert caught >= 0.9 and wrong <= 0.005  # a few labelled texts have no word left that could tell


def test_obfuscated_words_are_caught(spark, model):
    texts = ["you stup1d thing", "such an 1d10t he is", "a path3tic lot", "w o r t h l e s s people", "stuuuupid", "l0$er!",
             "the house is on the hill", "call 555 0199 or 24be64439e3e49", "a b", ""]
    got = t.score(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)
    assert [r.predicted for r in sorted(got.collect())] == [1] * 6 + [0] * 4


def test_walk_finds_the_best_path(model):
    for piece in ("st4p1d", "m0r0n", "l00ser", "a b c d", "x"):
        def total(choice):
            score, a, b = 0.0, " ", " "
            for c, channel in choice:
                score += channel
                if c:
                    score += float(model.language[int(t._classes(a)[0]), int(t._classes(b)[0]), int(t._classes(c)[0])])
                    a, b = b, c
            return score + float(model.language[int(t._classes(a)[0]), int(t._classes(b)[0]), 0])
        best = max(product(*t._lattice(piece)), key=total)
        assert np.isclose(total(best), max(total(c) for c in product(*t._lattice(piece)) if "".join(x for x, _ in c) == t.restore(piece, model.language)), atol=1e-4)


def test_odd_rows(spark, model):
    rows = [(None, "stupid", 1), (1, None, 2), (1, "", 3), (2, "a" * 200_000, 4), (2, "a" * 200_000, 4), (3, "0 " * 50_000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = sorted((r.doc_id or 0, r.predicted) for r in t.score(docs, model).collect())
    assert got == [(0, 1), (1, 0), (1, 0), (2, 0), (2, 0), (3, 0)]
    none = spark.createDataFrame([], "doc_id long, toxic int")
    empty = t.fit(docs.limit(0), none)
    assert [r.score for r in t.score(docs.limit(1), empty).collect()] == [0.5]
    assert t.score(docs.limit(0), model).count() == 0


def test_trigrams_do_not_depend_on_chunks(monkeypatch):
    texts = ["abc défg", "", "x", "A longer text, with 12 words or so.", "zz" * 40]
    batch = t.pa.RecordBatch.from_arrays([t.pa.array(texts)], ["text"])
    want = np.zeros(t.ALPHABET ** 3, np.int64)
    for chunk in (1 << 20, 7, 1):
        monkeypatch.setattr(t, "_CHUNK", chunk)
        got = np.zeros(t.ALPHABET ** 3, np.int64)
        for out in t._trigrams([batch, batch]):
            got[out.column(0).to_numpy()] += out.column(1).to_numpy()
        if chunk == 1 << 20:
            want = got
        assert got.sum() > 0 and (got == want).all(), chunk


def test_tally_counts_documents_and_occurrences(monkeypatch):
    model = np.zeros((64, 64, 64), np.float32)
    texts, toxic = ["stupid man stupid", "man of the house", "houses stupid"], [1, 0, 1]
    for cache in (1 << 18, 1):
        monkeypatch.setattr(t, "_CACHE", cache)
        found = {}
        batch = t.pa.RecordBatch.from_arrays([t.pa.array(texts), t.pa.array(toxic)], ["text", "toxic"])
        for out in t._counted(model)([batch]):
            for row in zip(*[c.to_pylist() for c in out.columns]):
                found[row[0]] = tuple(a + b for a, b in zip(found.get(row[0], (0,) * 4), row[1:]))
        assert found["stupid"] == found["stup~"] == (2, 2, 3, 3) and found["hous~"] == (2, 1, 2, 1)
        assert found["man"] == (2, 1, 2, 1) and found[""] == (3, 2, 9, 5)


@pytest.mark.parametrize("share", [60, 80])
def test_mostly_toxic_labels(spark, share):
    """Telling words are found when most labelled rows are toxic, and texts without them stay clean."""
    rng = np.random.default_rng(share)
    rows = []
    for i in range(600):
        toxic = int(i % 100 < share)
        words = [f"w{chr(97 + a)}{chr(97 + b)}" for a, b in rng.integers(0, 26, (30, 2))]
        rows.append((i, " ".join([*words, "stupid"] if toxic else words), toxic))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = t.fit(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    assert "stupid" in model.weights
    assert {r.doc_id: r.predicted for r in t.score(df.select("doc_id", "text"), model).collect()} == {i: y for i, _, y in rows}


def test_disguises_are_decoded():
    """Doubled letters, signs at one or both ends, separators inside, and runs from three letters, under a model of plain words."""
    batch = t.pa.RecordBatch.from_arrays([t.pa.array(["stupid ass shit fag the man of the house stays "] * 200)], ["text"])
    counts = np.ones(t.ALPHABET ** 3) * 0.01
    for out in t._trigrams([batch]):
        counts[out.column(0).to_numpy()] += out.column(1).to_numpy()
    tri = counts.reshape((t.ALPHABET,) * 3)
    model = np.log(tri / tri.sum(axis=2, keepdims=True)).astype(np.float32)
    features = t._token_features(model)
    for text, word in [("stuupid", "stupid"), ("a$$", "ass"), ("a55", "ass"), ("@$$", "ass"), ("5h17", "shit"), ("st.up.id", "stupid"),
                       ("f a g", "fag"), ("s  t  u  p  i  d", "stupid"), ("s\nt\nu\np\ni\nd", "stupid"), ("s - t - u - p - i - d", "stupid")]:
        found = set().union(*(features(p) for p in t._pieces(text, model)))
        assert word in found, text
    assert "fag" not in set().union(*(features(p) for p in t._pieces("the man of the house", model)))


def test_pieces_passed_over_have_no_telling_reading():
    """A piece without the outline of any telling feature: no way through its lattice spells one."""
    rng = random.Random(5)
    features = {f: 1.0 for f in ("stup~", "idiot", "ass", "l0l~", "été~", "looser", "fool")}
    telling = t.Telling(features)
    letters = "astupidloe015$@!|.-_é"
    pieces = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(1500)] + ["st*pid", "a**", "s.t.u.p", "a s s"]
    passed = 0
    for piece in pieces:
        if telling.possible(piece):
            continue
        passed += 1
        for choice in product(*[[c for c, _ in options] for options in t._lattice(piece)]):
            assert not t._features("".join(choice)) & features.keys(), piece
    assert passed > 500
    for piece in ("stup1d", "a$$", "5tuupid", "l00ser", "f.o.o.l", "st*pid"):
        assert telling.possible(piece)
    assert not t.Telling({}).possible("stup1d")


def test_passing_over_changes_no_number(spark, model):
    """Totals, hits and tops with every token decoded, on whole documents."""
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()]
    texts += ["w o r t h l e s s", "1d10t 5tup1d", "l.o.s.e.r st*pid", ""]
    features = t._token_features(model.language)
    batch = t.pa.RecordBatch.from_arrays([t.pa.array(range(len(texts))), t.pa.array(texts)], ["doc_id", "text"])
    got = next(t._measured(model, "doc_id")([batch]))
    for i, text in enumerate(texts):
        tokens = t._pieces(text, model.language)
        found = [w for w in (max((model.weights.get(f, 0.0) for f in features(x)), default=0.0) for x in tokens) if w]
        assert np.isclose(got.column(1)[i].as_py(), sum(found)) and got.column(3)[i].as_py() == len(tokens) and got.column(4)[i].as_py() == len(found)


def test_a_labelled_id_held_by_many_rows_counts_once(spark):
    rows = [(i, "good words here", 0) for i in range(40)] + [(i, "stupid words here", 1) for i in range(40, 80)]
    many = rows + [(79, "other words here", 1)] * 500
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, x) for i, x, _ in many], "doc_id long, text string")
    model = t.fit(docs, labels)
    assert "stupid" in model.weights and "words" not in model.weights
