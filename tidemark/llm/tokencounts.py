"""Token counts by byte-pair merging with a heap and a linked list.

The symbols of a word (its bytes) form a linked list, and a heap holds the adjacent pairs that a merge exists for, by
rank and place. The lowest pair is popped, merged, and its two new neighbours are pushed, until the heap is empty. A
word's count is its symbols minus its merges; identifiers of tokens are never made. Counts of words are kept per task,
up to a bound; very long words are counted anew, in n log n steps.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, table, whole
from tidemark.llm.registry import query

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
_HELD_WORDS, _HELD_BYTES = 1 << 18, 64  # words that a task remembers, and their length


def byte_symbols() -> list[str]:
    """The sign that stands for each byte in files of byte-level vocabularies: printable ones for themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def read_tokenizer(path: str) -> bytes:
    """The tokenizer's file. It is read on the driver once; its size does not depend on the data."""
    with open(path, "rb") as f:
        return f.read()


class Counter:
    """Counts tokens as the library for this file would: byte-level, without a normalizer."""

    def __init__(self, raw: bytes, pattern: str = public_tokenizers.PATTERN):
        spec = json.loads(raw)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"] != "BPE" or before.get("type") != "ByteLevel" or not before.get("use_regex", True) or before.get("add_prefix_space")
                or spec["normalizer"] or model.get("dropout") or model.get("ignore_merges")
                or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])):
            raise ValueError("only byte-level BPE without normalizer, prefix space and options of added tokens")
        ids = model["vocab"]
        self.symbols = [ids[s] for s in byte_symbols()]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        # a pair of symbols, as one number: its rank; and the symbol that each rank makes
        self.ranks = {ids[a] << 32 | ids[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.made = [ids[a + b] for a, b in pairs]
        self.split = regex.compile(pattern).findall
        # strings of added tokens count as one token each, the longest where several begin
        special = sorted((t["content"] for t in spec["added_tokens"] if t["content"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.known: dict[str, int] = {}

    def merges(self, word: bytes) -> int:
        """How many merges a word takes."""
        ranks, made, n = self.ranks.get, self.made, len(word)
        ids = [self.symbols[b] for b in word]
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = []
        for i in range(n - 1):
            rank = ranks(ids[i] << 32 | ids[i + 1])
            if rank is not None:
                heap.append(rank * n + i)
        heapify(heap)
        done = 0
        while heap:
            rank, i = divmod(heappop(heap), n)
            gone = after[i]
            # a symbol that is gone, or has another neighbour by now, no longer makes this pair
            if gone < 0 or ids[i] < 0 or ranks(ids[i] << 32 | ids[gone]) != rank:
                continue
            done += 1
            ids[i], ids[gone] = made[rank], -1
            beyond = after[i] = after[gone]
            if beyond >= 0:
                before[beyond] = i
                rank = ranks(ids[i] << 32 | ids[beyond])
                if rank is not None:
                    heappush(heap, rank * n + i)
            left = before[i]
            if left >= 0:
                rank = ranks(ids[left] << 32 | ids[i])
                if rank is not None:
                    heappush(heap, rank * n + left)
        return done

    def word(self, word: str) -> int:
        """Tokens of a word that is not remembered."""
        raw = word.encode()
        count = len(raw) - self.merges(raw)
        if len(raw) <= _HELD_BYTES:
            if len(self.known) >= _HELD_WORDS:
                self.known.clear()
            self.known[word] = count
        return count

    def text(self, text: str) -> int:
        """Tokens of a text."""
        total, parts = 0, [text]
        if self.special:
            parts = self.special.split(text)
            total = len(parts) - 1
        for part in parts:
            known = self.known
            for w in self.split(part):
                n = known.get(w)
                total += self.word(w) if n is None else n
        return total


def count_tokens(docs: DataFrame, text: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """docs with n_bytes, n_tokens and over_limit (more than `limit` tokens) of each whole text, instead of `text`.

    path: a tokenizer's file (byte-level BPE). A null or empty text has no tokens. The strings of added tokens inside
    a text are one token each. Rows that repeat are counted each; an empty table gives none; other columns pass
    through (those named like the three are replaced).
    """
    raw = read_tokenizer(path or public_tokenizers.path(TOKENIZER))
    rest = [c for c in docs.columns if c.lower() not in (text.lower(), "n_bytes", "n_tokens", "over_limit")]
    rows = docs.select(*[docs[c] for c in rest], F.octet_length(whole(docs[text])).cast("long").alias("n_bytes"),
                       whole(docs[text]).alias(free_name(rest, "text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(raw)
        for batch in batches:
            counts = [counter.text(t.as_py()) for t in batch.column(len(batch.columns) - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(counts, pa.int64())], [*batch.schema.names[:-1], "n_tokens"])
    schema = rows.select(*[rows[c] for c in [*rest, "n_bytes"]]).schema.add("n_tokens", "long")
    return rows.mapInArrow(run, schema).withColumn("over_limit", F.col("n_tokens") > limit)


@query()
def op13_token_counts(spark, sf_dir):
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))
