"""Importance resampling of documents towards a target, over hashed word features.

A feature's bucket is its CRC modulo the number of buckets. The distinct features of a task are grouped by length
into matrices of bytes, a row each; all CRCs of a matrix go forward together, a column at a time, and are scattered
back to where the features stand. Features longer than _WIDTH bytes are rows of _WIDTH bytes, whose CRCs are joined.

Two passes over the texts: counts of buckets over documents and target (a row per bucket reaches the driver, however
many texts there are), then the weight of every document. Gumbel noise by hash of the id makes the highest scores a
draw without replacement. Ranks come from a range shuffle of thin rows; no task sorts them all.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, stored, table, whole
from tidemark.llm.registry import query

BUCKETS = 10_000
LONGEST = 1  # words of a feature, at most
PERCENT = 10
LEAST_WORDS = 20
SEED = "2024"
_POLYNOMIAL = 0xEDB88320  # of CRC-32, a fixed value
_WIDTH = 256  # columns of a matrix, at most
_HELD_FEATURES, _HELD_BYTES = 1 << 19, 1 << 26  # what a task remembers, before it starts over
_SLICE = 1 << 22  # bytes of text worked on at once, if one text is not longer

#: What is no digit, letter a-z or byte of another character becomes a blank; A-Z are lower-cased.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _steps() -> np.ndarray:
    """What a byte does to a CRC, by its value."""
    crc = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        crc = np.where(crc & 1, (crc >> 1) ^ np.uint32(_POLYNOMIAL), crc >> 1)
    return crc


_STEPS = _steps()


def _shifts() -> np.ndarray:
    """What _WIDTH zero bytes do to each byte of a CRC, [place, value]."""
    crc = (np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None])
    for _ in range(_WIDTH):
        crc = _STEPS[crc & 0xFF] ^ (crc >> 8)
    return crc


_SHIFTS = _shifts()


def _columns(matrix: np.ndarray) -> np.ndarray:
    """The CRC of every row of a matrix of bytes."""
    crc = np.full(len(matrix), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(matrix.T):
        crc = _STEPS[(crc ^ column) & 0xFF] ^ (crc >> 8)
    return ~crc


def crcs(features: list[bytes]) -> np.ndarray:
    """The CRC-32 of each feature."""
    lengths = np.fromiter(map(len, features), np.int64, len(features))
    order = np.argsort(lengths, kind="stable")
    out = np.zeros(len(features), np.uint32)
    for rows in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        if not len(rows):
            continue
        n = int(lengths[rows[0]])
        matrix = np.frombuffer(b"".join([features[i] for i in rows]), np.uint8).reshape(len(rows), n)
        head = n % _WIDTH or min(n, _WIDTH)
        crc = _columns(matrix[:, :head])
        if n > head:
            rest = _columns(matrix[:, head:].reshape(-1, _WIDTH)).reshape(len(rows), -1)
            for part in rest.T:
                crc = (_SHIFTS[0][crc & 0xFF] ^ _SHIFTS[1][crc >> 8 & 0xFF] ^ _SHIFTS[2][crc >> 16 & 0xFF]
                       ^ _SHIFTS[3][crc >> 24] ^ part)
        out[rows] = crc
    return out


class _Features(dict):
    """Numbers of the distinct features of a task, and the bucket of each number."""

    def __init__(self, buckets: int):
        self.buckets, self.bucket_of, self.fresh, self.bytes = buckets, np.zeros(0, np.int64), [], 0

    def __missing__(self, feature: bytes) -> int:
        self[feature] = n = len(self)
        self.fresh.append(feature)
        self.bytes += len(feature)
        return n

    def looked_up(self, numbers: np.ndarray) -> np.ndarray:
        """The buckets of these numbers."""
        if self.fresh:
            self.bucket_of = np.concatenate((self.bucket_of, crcs(self.fresh).astype(np.int64) % self.buckets))
            self.fresh = []
        found = self.bucket_of[numbers]
        if len(self) > _HELD_FEATURES or self.bytes > _HELD_BYTES:
            self.clear()
            self.bucket_of, self.bytes = self.bucket_of[:0], 0
        return found


def _runs(words: list[bytes], longest: int) -> list[bytes]:
    out = list(words)
    for n in range(2, longest + 1):
        out.extend(b" ".join(words[i:i + n]) for i in range(len(words) - n + 1))
    return out


def _sliced(texts: pa.Array, features: _Features, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, words of each, features of each, buckets of all) for slices of the texts, in order."""
    words, sizes, numbers, held = [], [], [], 0
    for i, text in enumerate(texts):
        text = text.as_buffer().to_pybytes()
        own = text.translate(_PLAIN).split()
        found = own if longest == 1 else _runs(own, longest)
        words.append(len(own)), sizes.append(len(found))
        numbers.append(np.fromiter(map(features.__getitem__, found), np.int64, len(found)))
        held += len(text)
        if held >= _SLICE or i + 1 == len(texts):
            yield len(words), np.array(words), np.array(sizes), features.looked_up(np.concatenate(numbers))
            words, sizes, numbers, held = [], [], [], 0


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, text: str = "text") -> DataFrame:
    """bucket, n: how many features of all texts fall into each bucket that has any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, features = np.zeros(buckets, np.int64), _Features(buckets)
        for batch in batches:
            for _, _, _, found in _sliced(batch.column(0), features, longest):
                counts += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["bucket", "n"])
    return (texts.select(whole(text).cast("binary").alias("text")).mapInArrow(run, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """floor(1000 * log ratio of target and document rates) of every bucket, smoothed by one."""
    def counts(df: DataFrame) -> list[int]:
        out = [0] * buckets
        for r in bucket_counts(df, buckets, longest).collect():  # a row per bucket at most
            out[r.bucket] = r.n
        return out
    s, t = counts(docs), counts(target)
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    return np.array([math.floor(1000 * math.log(float(b + 1) * all_s / (float(a + 1) * all_t))) for a, b in zip(s, t)], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """doc_id, n_words, n_features, weight (the gains of all its features) per row of docs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = _Features(len(gain))
        for batch in batches:
            at = 0
            for rows, words, sizes, found in _sliced(batch.column(1), features, longest):
                upto = np.r_[0, np.cumsum(gain[found])][np.r_[0, np.cumsum(sizes)]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, rows), pa.array(words, pa.int64()), pa.array(sizes, pa.int64()), pa.array(np.diff(upto), pa.int64())],
                    ["doc_id", "n_words", "n_features", "weight"])
                at += rows
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def placed(df: DataFrame, order: list, out: str) -> DataFrame:
    """df with its place in this order, from 1. Rows alike in the order must not be many; no task holds all rows."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the number holds the partition above 33 bits and the place inside it below
    df = stored(df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "placed")
    df = df.withColumn("_part", F.shiftright("_at", 33))
    sizes = df.groupBy("_part").count().collect()  # a row per partition
    before, total = {}, 0
    for r in sorted(sizes, key=lambda r: r["_part"]):
        before[r["_part"]], total = total, total + r["count"]
    starts = F.create_map(*[F.lit(x) for pair in before.items() for x in pair]) if before else F.create_map(F.lit(0).cast("long"), F.lit(0))
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return df.withColumn(out, (F.try_element_at(starts, F.col("_part")) + inside + 1).cast("long")).drop("_at", "_part")


def resample(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, percent: int = PERCENT,
             least_words: int = LEAST_WORDS, seed: str = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank per row of docs: rank 1, 2, ... for the drawn, null for all others.

    Of the documents with at least least_words words, percent in a hundred (rounded down) are drawn by falling score,
    ties by rising doc_id (null last). A null or empty text has no features and weight 0; a null doc_id is hashed as
    an empty one. Rows that repeat are scored and drawn each. An empty table gives no rows; an empty target is one in
    which every bucket counts nothing. Columns of docs other than doc_id and text are ignored.
    """
    rows = stored(weighed(docs, gains(docs, target, buckets, longest), longest), "weights")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    rows = rows.select("doc_id", "n_features", "weight", (F.col("weight") + noise).cast("long").alias("score"),
                       (F.col("n_words") >= least_words).alias("_fit"))
    # rows that repeat are told apart by a number, so that they may lie in several partitions
    alike = ["doc_id", "n_features", "weight", "score", "_fit"]
    rows = rows.groupBy(*alike).count().select(*alike, F.explode(F.sequence(F.lit(1), "count")).alias("_copy"))
    order = [F.desc("_fit"), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("_copy")]
    rows = placed(rows, order, "_place")
    drawn = rows.where("_fit").count() * percent // 100
    return rows.select("doc_id", "n_features", "weight", "score",
                       F.when(F.col("_fit") & (F.col("_place") <= drawn), F.col("_place")).alias("rank"))


_SQL = f"""
WITH steps AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
        lambda c, n: CASE WHEN c & 1 = 1 THEN xor(c >> 1, {_POLYNOMIAL}) ELSE c >> 1 END)) AS s),
texts AS (SELECT doc_id, 0 AS which, text FROM documents UNION ALL SELECT item_id, 1, text FROM benchmark),
found AS (SELECT row_number() OVER () AS r, doc_id, which, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM texts),
features AS (SELECT r, doc_id, which, unnest(words) AS word FROM found),
buckets AS (SELECT word, xor(list_reduce(list_concat([4294967295], list_transform(regexp_extract_all(hex(encode(word)), '..'),
        lambda x: ('0x' || x)::BIGINT)), lambda c, b: xor(s[(xor(c, b) & 255) + 1], c >> 8)), 4294967295) % {BUCKETS} AS bucket
    FROM (SELECT DISTINCT word FROM features), steps),
counts AS (SELECT bucket, count(*) FILTER (which = 0) AS s, count(*) FILTER (which = 1) AS t FROM features JOIN buckets USING (word) GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + {BUCKETS})::DOUBLE
        / ((s + 1)::DOUBLE * (sum(t) OVER () + {BUCKETS})::DOUBLE)))::BIGINT AS gain FROM counts),
weights AS (SELECT r, sum(gain)::BIGINT AS weight FROM features JOIN buckets USING (word) JOIN gains USING (bucket) WHERE which = 0 GROUP BY r),
scored AS (SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
        (('0x' || sha256('{SEED}:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM found LEFT JOIN weights USING (r) WHERE which = 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_features >= {LEAST_WORDS} ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= {LEAST_WORDS} AND place <=
    {PERCENT} * (SELECT count(*) FROM scored WHERE n_features >= {LEAST_WORDS}) // 100 THEN place END AS rank FROM placed"""


@query(_SQL)
def op11_importance_resampling(spark, sf_dir):
    return resample(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark").select("text"))
