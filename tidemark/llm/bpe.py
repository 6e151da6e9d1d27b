"""Byte-level BPE by replaying the merges over a block of the corpus.

The words (matches of the pattern) of a block of documents are made distinct and laid out as one row of symbols. An
inverted index has the positions of every pair that a merge makes. The merges are applied in rank order, each at
all its positions at once; only the pairs with the two touched neighbours are looked up and indexed anew. Words
do not influence each other, so replaying a block gives what replaying the whole corpus would, and the words need
not be shuffled: dictionary entries of all documents would be several times the texts.

A merge may make a pair of a lower rank than its own (the vocabulary can build a token in several ways). Such a
word is encoded alone, always taking its lowest, leftmost pair. A word that is itself a token is that token.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import free_name, table, whole
from tidemark.llm.registry import query

VOCABULARY = "byte_bpe_50k.tiktoken"
BLOCK_CHARS = 16_000_000  # texts of a block, at least
_SLICE = 200_000  # words or tokens worked on at once, if the text is not longer


def read_ranks(path: str) -> bytes:
    """The vocabulary file. It is read on the driver once; its size does not depend on the data."""
    with open(path, "rb") as f:
        return f.read()


class Vocabulary:
    def __init__(self, raw: bytes):
        self.ranks = {base64.b64decode(t): int(r) for t, r in (line.split() for line in raw.splitlines() if line.strip())}
        n = max(self.ranks.values()) + 1
        tokens = [b""] * n
        for t, r in self.ranks.items():
            tokens[r] = t
        self.bytes_of = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.blob = np.frombuffer(b"".join(tokens), np.uint8)
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    @functools.cached_property
    def merges(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of tokens, as one sorted number each, and the rank that they merge to. Decoding does without."""
        pairs = {}
        for t, r in self.ranks.items():
            for cut in range(1, len(t)):
                a, b = self.ranks.get(t[:cut]), self.ranks.get(t[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = r
        keys = np.array(sorted(pairs), np.int64)
        return keys, np.array([pairs[k] for k in keys.tolist()], np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 if no merge makes it."""
        keys, values = self.merges
        k = a.astype(np.int64) << 32 | b
        at = np.minimum(np.searchsorted(keys, k), len(keys) - 1)
        return np.where(keys[at] == k, values[at], -1)

    def alone(self, word: bytes) -> list[int]:
        """One word: its lowest pair, the leftmost of equals, until none is left."""
        ids = self.bytes_of[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        before, after = [i - 1 for i in range(n)], [*range(1, n), -1]
        rank = [-1] * n

        def look(i: int) -> None:
            rank[i] = int(self.merged(np.int64(ids[i]), np.int64(ids[after[i]]))) if after[i] >= 0 else -1
            if rank[i] >= 0:
                heapq.heappush(heap, (rank[i], i))
        heap: list[tuple[int, int]] = []
        for i in range(n):
            look(i)
        while heap:
            r, i = heapq.heappop(heap)
            if rank[i] != r:
                continue
            gone = after[i]
            ids[i], after[i], rank[gone] = r, after[gone], -1
            ids[gone] = -1
            if after[i] >= 0:
                before[after[i]] = i
            look(i)
            if before[i] >= 0:
                look(before[i])
        return [t for t in ids if t >= 0]

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of distinct words, one after the other, and how many each word has."""
        direct = [self.ranks.get(w, -1) for w in words]
        rest = [i for i, r in enumerate(direct) if r < 0 and words[i]]
        counts = np.array([r >= 0 for r in direct], np.int64)
        if rest:
            sizes = np.array([len(words[i]) for i in rest])
            symbols, alive, odd = self._merge_all(self.bytes_of[np.frombuffer(b"".join(words[i] for i in rest), np.uint8)], sizes)
            owner = np.repeat(np.arange(len(rest), dtype=np.int32), sizes)
            tally = np.bincount(owner[alive], minlength=len(rest))
            own = {}
            for i in odd.tolist():
                own[i] = self.alone(words[rest[i]])
                tally[i] = len(own[i])
            counts[rest] = tally
        stops = np.cumsum(counts)
        ids = np.zeros(int(stops[-1]) if len(stops) else 0, np.int32)
        known = [i for i, r in enumerate(direct) if r >= 0]
        ids[stops[known] - 1] = [direct[i] for i in known]
        if rest:
            plain = alive & ~np.isin(owner, odd)
            ids[_ranges((stops - counts)[rest][~np.isin(np.arange(len(rest)), odd)],
                        tally[~np.isin(np.arange(len(rest)), odd)])] = symbols[plain]
            for i, t in own.items():
                ids[stops[rest[i]] - len(t):stops[rest[i]]] = t
        return ids, counts

    def _merge_all(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """symbols after all merges, which of them are left, and the words to encode alone."""
        n, ends = len(symbols), np.cumsum(sizes)
        after, before = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32)
        after[ends - 1] = -1
        before[ends - sizes] = -1
        word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        alive, odd = np.ones(n, bool), np.zeros(len(sizes), bool)
        rank = np.full(n, -1, np.int32)
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []

        def look(at: np.ndarray, floor: int) -> None:
            """Index the pairs that start at these positions."""
            at = at[after[at] >= 0]
            found = self.merged(symbols[at], symbols[after[at]])
            early = (found >= 0) & (found <= floor)
            if early.any():
                odd[word[at[early]]] = True
                found[early] = -1
            rank[at] = found
            at, found = at[found >= 0], found[found >= 0]
            order = np.argsort(found, kind="stable")
            at, found = at[order], found[order]
            cuts = np.flatnonzero(np.diff(found)) + 1
            for part, r in zip(np.split(at, cuts), found[np.r_[0, cuts]].tolist() if len(found) else []):
                if r not in index:
                    index[r] = []
                    heapq.heappush(heap, r)
                index[r].append(part)

        for i in range(0, n, _SLICE):
            look(np.arange(i, min(n, i + _SLICE), dtype=np.int32), -1)
        while heap:
            r = heapq.heappop(heap)
            parts = index.pop(r)
            at = np.concatenate(parts) if len(parts) > 1 else parts[0]
            at = np.sort(at[rank[at] == r])
            at = at[np.r_[True, at[1:] != at[:-1]][:len(at)]]  # a pair may have been indexed twice
            if len(at) > 1:  # of pairs that overlap in a chain, the first, third, ... merge
                fresh = np.r_[True, after[at[:-1]] != at[1:]]
                if not fresh.all():
                    place = np.arange(len(at))
                    at = at[(place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            beyond = after[gone]
            symbols[at], after[at] = r, beyond
            alive[gone], rank[gone], rank[at] = False, -1, -1
            has = beyond >= 0
            before[beyond[has]] = at[has]
            left = before[at]
            left = left[left >= 0]
            rank[left] = -1
            look(np.concatenate((left, at)), r)
        return symbols, alive, np.flatnonzero(odd)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all tokens, one after the other."""
        return self.blob[_ranges(self.starts[ids], self.lengths[ids])]


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each start, as many as its length."""
    stops = np.cumsum(lengths)
    total = int(stops[-1]) if len(stops) else 0
    return np.repeat(starts - (stops - lengths), lengths) + np.arange(total)


class _Numbered(dict):
    def __missing__(self, word):
        self[word] = n = len(self)
        return n


def _encoder(raw: bytes, pattern: str, block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, split = Vocabulary(raw), regex.compile(pattern).findall
        held, chars, number = [], 0, _Numbered()  # held: (rows of a batch, the numbers of their words)

        def flush() -> Iterator[pa.RecordBatch]:
            flat, counts = vocabulary.replay([w.encode() for w in number])
            starts = np.cumsum(counts) - counts
            for rows, docs in held:
                sizes = np.array([len(d) for d in docs])
                words = np.concatenate(docs)
                upto = np.r_[0, np.cumsum(counts[words])]
                offsets = upto[np.r_[0, np.cumsum(sizes)]].astype(np.int32)
                ids = pa.array(flat[_ranges(starts[words], counts[words])])
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.ListArray.from_arrays(pa.array(offsets), ids)],
                                                 [*rows.schema.names[:-1], "ids"])
        for batch in batches:
            texts = batch.column(len(batch.columns) - 1)
            done, docs, words = 0, [], 0
            for i, text in enumerate(texts):
                text = text.as_py()
                found = split(text)
                docs.append(np.fromiter(map(number.__getitem__, found), np.int32, len(found)))
                chars, words = chars + len(text), words + len(found)
                full = chars >= block_chars
                if full or words >= _SLICE or i + 1 == len(texts):  # small slices bound what a step holds at once
                    held.append((batch.slice(done, i + 1 - done), docs))
                    done, docs, words = i + 1, [], 0
                if full:
                    yield from flush()
                    held, chars, number = [], 0, _Numbered()
        if held:
            yield from flush()
    return run


def encode(docs: DataFrame, text: str = "text", path: str | None = None, pattern: str = public_tokenizers.PATTERN,
           block_chars: int = BLOCK_CHARS) -> DataFrame:
    """docs with `ids`, the tokens of each whole text, instead of `text`.

    path: a vocabulary of ranks (base64 bytes and rank per line). A null or empty text has no tokens. Rows that repeat
    are encoded each; an empty table gives none; other columns pass through (one named ids is replaced).
    """
    raw = read_ranks(path or public_tokenizers.path(VOCABULARY))
    rest = [c for c in docs.columns if c.lower() not in (text.lower(), "ids")]
    rows = docs.select(*[docs[c] for c in rest], whole(docs[text]).alias(free_name(rest, "text")))
    schema = docs.select(*[docs[c] for c in rest]).schema.add("ids", T.ArrayType(T.IntegerType()))
    return rows.mapInArrow(_encoder(raw, pattern, block_chars), schema)


def decode(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """tokens with `decoded`, the bytes that `ids` stand for, instead of `ids`. Null ids decode to no bytes."""
    raw = read_ranks(path or public_tokenizers.path(VOCABULARY))
    rest = [c for c in tokens.columns if c.lower() not in ("ids", "decoded")]
    rows = tokens.select(*[tokens[c] for c in rest], F.coalesce("ids", F.array().cast("array<int>")).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(raw)
        for batch in batches:
            stops = np.asarray(batch.column(len(batch.columns) - 1).offsets)
            a = 0
            while a < len(batch):
                b = max(a + 1, int(np.searchsorted(stops, stops[a] + _SLICE, "right")) - 1)
                part = batch.slice(a, b - a)
                ids = batch.column(len(batch.columns) - 1).values[stops[a]:stops[b]].to_numpy(zero_copy_only=False)
                upto = np.r_[0, np.cumsum(vocabulary.lengths[ids])][stops[a:b + 1] - stops[a]]
                out = pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(upto.astype(np.int32)),
                                                                 pa.py_buffer(vocabulary.decode(ids).tobytes())])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], out], [*rest, "decoded"])
                a = b
    return rows.mapInArrow(run, rows.select(*rest).schema.add("decoded", "binary"))


@query()
def op2_byte_bpe(spark, sf_dir):
    tokens = encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    with_digest = tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(
        F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"))
    return decode(with_digest).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
