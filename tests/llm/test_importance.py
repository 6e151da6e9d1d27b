"""Importance resampling against zlib and a plain version; odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import importance as t


def plain(docs, target, buckets, longest, percent, least):
    def features(text):
        w = re.findall(r"[0-9a-z\u0080-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return w, [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    def bucket(f):
        return zlib.crc32(f.encode()) % buckets
    own = [features(text) for _, text in docs]
    s, g = Counter(bucket(f) for _, fs in own for f in fs), Counter(bucket(f) for text in target for f in features(text)[1])
    all_s, all_t = s.total(), g.total()
    out = []
    for (i, _), (w, fs) in zip(docs, own):
        weight = sum(math.floor(1000 * math.log((g[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in map(bucket, fs))
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= least])
    fit = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = {id(r): n for n, r in enumerate(fit[:len(fit) * percent // 100], 1)}
    return Counter((*r[:4], drawn.get(id(r))) for r in out)


def rows_of(df):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect())


def test_crcs_of_all_lengths():
    rng = random.Random(1)
    features = [rng.randbytes(n) for n in [0, *range(1, 60), 255, 256, 257, 511, 512, 513, 1000, 5000] for _ in range(3)]
    rng.shuffle(features)
    assert t.crcs(features).tolist() == [zlib.crc32(f) for f in features]
    assert t.crcs([]).tolist() == []


def test_very_long_word_is_fast():
    word = b"a" * 20_000_000
    assert t.crcs([word])[0] == zlib.crc32(word)


@pytest.mark.parametrize("longest", [1, 2])
def test_against_a_plain_version(spark, monkeypatch, longest):
    monkeypatch.setattr(t, "_SLICE", 300)
    rng = random.Random(longest)
    words = [f"Wörd{n}" if n % 5 else f"x{n}-y" for n in range(60)] + ["漢字", "naïve", "ÀB", "'s"]
    docs = [(rng.randrange(400) if rng.random() < 0.95 else None, rng.choice(["", None, " ".join(rng.choices(words, k=rng.randint(1, 60)))]))
            for _ in range(500)] + [(7, "w " * 30)] * 50
    target = [" ".join(rng.choices(words[:9], k=20)) for _ in range(20)] + [None]
    frame = spark.createDataFrame(docs, "doc_id int, text string").select("*", *[F.lit("x").alias(c) for c in ("weight", "_fit", "N_words", "rank")])
    got = t.resample(frame, spark.createDataFrame([(x,) for x in target], "text string"), 97, longest, 30, 20)
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert rows_of(got) == plain(docs, target, 97, longest, 30, 20)


def test_few_remembered_features_change_nothing(monkeypatch):
    words = [f"w{n % 70}".encode() for n in range(500)]
    want = [zlib.crc32(w) % 1000 for w in words]
    monkeypatch.setattr(t, "_HELD_FEATURES", 10)
    features = t._Features(1000)
    got = [int(b) for a in range(0, 500, 20) for b in features.looked_up(t.np.array([features[w] for w in words[a:a + 20]]))]
    assert got == want


def test_empty_tables_and_targets(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert t.resample(none, none.select("text")).count() == 0
    docs = [(n, "alpha beta " * 15) for n in range(20)]
    got = t.resample(spark.createDataFrame(docs, "doc_id long, text string"), none.select("text"))
    assert rows_of(got) == plain(docs, [], 10_000, 1, 10, 20)


def test_a_third_of_the_rows_alike_is_spread(spark):
    """Repeated rows get ranks of their own and lie in several partitions."""
    docs = spark.createDataFrame([(1, "w " * 25)] * 1000 + [(n, "v " * 25) for n in range(2, 2002)], "doc_id long, text string")
    got = t.resample(docs, docs.select("text").limit(1), percent=100)
    ranks = sorted(r["rank"] for r in got.collect())
    assert ranks == list(range(1, 3001))
    assert len(got.where("doc_id = 1").select(F.spark_partition_id()).distinct().collect()) >= 2
