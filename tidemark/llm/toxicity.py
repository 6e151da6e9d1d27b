"""Toxicity of restored texts: noisy-channel deobfuscation, then evidence of words.

Tokens that hold a look-alike, a doubled letter or a separator inside, and runs of three or more single letters, are
decoded (a token once per task while held): every character
opens the letters it may stand for (or none, for repeats and separators), and a Viterbi walk through this lattice
finds the likeliest reading under a character trigram model. The model is counted over the texts of all documents;
its alphabet is fixed, so the table is too (ALPHABET ** 3 numbers), however large the corpus.

Evidence is learned from labelled rows: for each word and each beginning of 4 to 6 letters, how many documents have
it and how many of these are toxic. Only features that chance would not bring about once among all features count
(likelihood ratio of at least twice the logarithm of their number), and that are at least twice as frequent in toxic
texts as in others, whatever the share of toxic labels. A token weighs as its most telling feature: the log
of the feature's rate in toxic against other texts. A logistic regression turns a document's weights, set against
the number of its tokens, into the score. Labels are joined to at most TRAIN_ROWS rows, by hash of the
id; that bounds the broadcast and the model. Nothing but the text goes into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table, whole
from tidemark.llm.registry import query

TRAIN_ROWS = 50_000
CUTOFF = 0.7
LIKELIER = 2  # a telling feature is in toxic texts at least so many times as often as in others
ALPHABET = 64
BEGINNINGS = (4, 5, 6)
#: What a sign may stand for; fixed values.
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "*": "aeiou"}
_SEPARATORS = " .-_*"
_CHUNK = 1 << 20
_CACHE = 1 << 18
_LETTERS = re.compile(r"[^\W\d_]+")
#: Tokens to decode: a look-alike, a doubled letter, or a separator inside.
_DISGUISED = re.compile(r"[0-9@$!|+*]|([^\W\d_])\1|[^\W_][.\-_]+[^\W_]")
#: Three signs or more, letter by letter, with short runs of white space or separators between.
_SPACED = re.compile(r"(?<![^\W_])(?:(?:[^\W_]|[@$!|+])[\s.\-_*]{1,3}(?=(?:[^\W_]|[@$!|+])(?![^\W_]))){2,}(?:[^\W_]|[@$!|+])")

# classes of characters: 0 white space, 1-26 a-z, 27-58 Latin letters with marks, 59 digits, 60 other letters, 61 the rest
_CLASSES = np.full(0x250, 61, np.uint8)
for _c in range(0x250):
    _s = chr(_c)
    _CLASSES[_c] = (0 if _s.isspace() else _c - 96 if "a" <= _s <= "z" else 27 + _c - 0xE0 if 0xE0 <= _c <= 0xFF and _c != 0xF7
                    else 59 if _s.isdigit() else 60 if _s.isalpha() else 61)


def _classes(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < len(_CLASSES), _CLASSES[np.minimum(codes, len(_CLASSES) - 1)], 60)


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, held, size = np.zeros(ALPHABET ** 3, np.int64), [], 0
    gap = np.zeros(2, np.uint8)

    def count() -> None:  # many texts at once: a pass over the table costs more than a short text
        c = np.concatenate(held).astype(np.int64)
        counts[:] += np.bincount((c[:-2] * ALPHABET + c[1:-1]) * ALPHABET + c[2:], minlength=ALPHABET ** 3)
    for batch in batches:
        for text in batch.column(0):
            text = text.as_py().lower()
            held.append(gap)
            for at in range(0, len(text), _CHUNK):
                held.append(_classes(text[at:at + _CHUNK]))
                size += len(held[-1])
                if size >= _CHUNK:
                    count()
                    held, size = [np.concatenate(held[-3:])[-2:]], 0  # what the next characters follow
    if held:
        held.append(gap)
        count()
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["code", "n"])


def language_model(docs: DataFrame) -> np.ndarray:
    """log P(c | a, b) by classes, [a, b, c], interpolated with bigrams and single characters."""
    rows = (docs.select(whole().alias("text")).mapInArrow(_trigrams, "code long, n long")
            .groupBy("code").agg(F.sum("n").alias("n")).collect())  # at most ALPHABET ** 3 rows
    tri = np.zeros(ALPHABET ** 3)
    for r in rows:
        tri[r.code] = r.n
    tri = tri.reshape(ALPHABET, ALPHABET, ALPHABET)
    bi, uni = tri.sum(axis=0), tri.sum(axis=(0, 1))
    p1 = (uni + 1) / (uni.sum() + ALPHABET)
    p2 = (bi + 4 * p1) / (bi.sum(axis=1, keepdims=True) + 4)
    return np.log((tri + 4 * p2[None]) / (tri.sum(axis=2, keepdims=True) + 4)).astype(np.float32)


def _lattice(piece: str) -> list[list[tuple[str, float]]]:
    """What each character may stand for, with the channel's log probability; "" for nothing."""
    spaced = bool(_SPACED.fullmatch(piece))
    out = []
    for i, c in enumerate(piece):
        options = [(c, -0.05 if c.isalpha() else -4.0)]
        if c in LOOKALIKES:
            options += [(x, -0.3 - math.log(len(LOOKALIKES[c]))) for x in LOOKALIKES[c]]
        if i and c == piece[i - 1] and c.isalpha():
            options.append(("", -0.7))
        if (c in _SEPARATORS or c.isspace()) and (spaced or 0 < i < len(piece) - 1):
            options.append(("", -0.1))
        out.append(options)
    return out


class Restorer:
    """The likeliest reading of a lower-case piece of text: Viterbi over the last two characters."""

    def __init__(self, model: np.ndarray):
        self.table = model.ravel().tolist()  # numbers of a list are read faster one by one than those of an array
        self.of = {"": 0}

    def number(self, c: str) -> int:
        if (n := self.of.get(c)) is None:
            n = self.of[c] = int(_classes(c)[0])
        return n

    def __call__(self, piece: str) -> str:
        table, number = self.table, self.number
        # state: the last two characters -> score, place in the table that their classes lead to, path
        paths = {("", ""): (0.0, 0, None)}
        for options in _lattice(piece):
            new: dict = {}
            for (a, b), (score, place, path) in paths.items():
                for c, channel in options:
                    if c:
                        n = number(c)
                        state, s = (b, c), score + channel + table[place + n]
                        if state not in new or s > new[state][0]:
                            new[state] = (s, (place + n) % (ALPHABET * ALPHABET) * ALPHABET, (path, c))
                    else:
                        state, s = (a, b), score + channel
                        if state not in new or s > new[state][0]:
                            new[state] = (s, place, path)
            paths = new
        _, _, path = max((s + table[place], n, path) for n, (s, place, path) in enumerate(paths.values()))
        found = []
        while path:
            path, c = path
            found.append(c)
        return "".join(reversed(found))


def _restorer(model: np.ndarray | Restorer) -> Restorer:
    return model if isinstance(model, Restorer) else Restorer(model)


def restore(piece: str, model: np.ndarray | Restorer) -> str:
    """The likeliest reading of one piece."""
    return _restorer(model)(piece)


def _features(piece: str) -> set[str]:
    out = set()
    for w in _LETTERS.findall(piece):
        out.add(w)
        out.update(w[:n] + "~" for n in BEGINNINGS if len(w) >= n)
    return out


def _token_features(model: np.ndarray | Restorer):
    """Features of a token, its restored form included."""
    restored = _restorer(model)

    def of(token: str) -> set[str]:
        found = _features(token)
        if _DISGUISED.search(token) and (reading := restored(token)) != token:
            found |= _features(reading)
        return found
    return of


def _representatives() -> dict[int, str | None]:
    """For str.translate: signs that may stand for one letter become one sign, and separators go."""
    parent = {c: c for c in "abcdefghijklmnopqrstuvwxyz"}

    def find(c: str) -> str:
        while parent.setdefault(c, c) != c:
            c = parent[c]
        return c
    for sign, letters in LOOKALIKES.items():
        if sign not in _SEPARATORS:
            for letter in letters:
                parent[find(letter)] = find(sign)
    return {ord(c): find(c) for c in parent} | {ord(c): None for c in _SEPARATORS}


_ALIKE = _representatives()
_RUN = re.compile(r"(.)\1+", re.DOTALL)


def _outline(piece: str) -> str:
    """Every reading of a piece has this outline, up to separators that stay and stand between words."""
    return _RUN.sub(r"\1", "".join(piece.translate(_ALIKE).split()))


class Telling:
    """Whether a reading of a piece can hold a telling feature.

    A reading leaves signs, puts letters in their place, and drops doubled letters and separators. None of this
    changes the outline, and a word's beginning stands unbroken in the outline of its text. So a piece without the outline of any
    telling feature has no reading with one. A star may be dropped or be a vowel, so a piece with one always may.
    """

    def __init__(self, features: dict[str, float]):
        self.found = ahocorasick.Automaton()
        for f in features:
            if outline := _outline(f.removesuffix("~")):
                self.found.add_word(outline, 1)
        self.any = len(self.found) > 0
        if self.any:
            self.found.make_automaton()

    def possible(self, piece: str) -> bool:
        return self.any and ("*" in piece or next(self.found.iter(_outline(piece)), None) is not None)


def _pieces(text: str, model: np.ndarray | Restorer, telling: Telling | None = None) -> list[str]:
    """The tokens of a text; what stands letter by letter comes again as the word it restores to (with `telling`: as
    nothing, where no reading can be telling)."""
    text = text.lower()
    tokens = text.split()
    tokens.extend(restore(m.group(), model) if telling is None or telling.possible(m.group()) else "" for m in _SPACED.finditer(text))
    return tokens


class _Tally:
    """Documents and occurrences of each feature, all and toxic ones, over the texts of a task so far."""

    def __init__(self, model: np.ndarray):
        self.restored = Restorer(model)
        self.features = _token_features(self.restored)
        self.reset()

    def reset(self) -> None:
        self.tokens: dict[str, int] = {}
        self.names: dict[str, int] = {"": 0}  # the empty one stands for any token
        self.flat, self.sizes = [], []
        self.counts = np.zeros((4, 1), np.int64)
        self.clear()

    def clear(self) -> None:
        self.ids, self.times, self.owner, self.toxic = [], [], [], []

    def number(self, token: str) -> int:
        n = self.tokens[token] = len(self.tokens)
        found = [0, *(self.names.setdefault(f, len(self.names)) for f in self.features(token))]
        self.flat.extend(found)
        self.sizes.append(len(found))
        return n

    def add(self, text: str, toxic: int) -> None:
        known, number = self.tokens, self.number
        found = Counter(_pieces(text, self.restored))
        self.ids.extend([known[t] if t in known else number(t) for t in found])
        self.times.extend(found.values())
        self.owner.append(len(found))
        self.toxic.append(toxic)

    def settle(self) -> None:
        """Count the texts added since the last time."""
        if self.ids:
            ids, sizes = np.array(self.ids), np.array(self.sizes)
            starts = np.cumsum(sizes) - sizes
            per = sizes[ids]
            stops = np.cumsum(per)
            features = np.array(self.flat)[np.repeat(starts[ids] - (stops - per), per) + np.arange(stops[-1])]
            doc = np.repeat(np.repeat(np.arange(len(self.owner)), self.owner), per)
            pair, at = np.unique(doc * len(self.names) + features, return_inverse=True)
            times = np.bincount(at, weights=np.repeat(self.times, per)).astype(np.int64)
            doc, features = pair // len(self.names), pair % len(self.names)
            toxic = np.array(self.toxic)[doc]
            new = [np.bincount(features, weights=w, minlength=len(self.names)).astype(np.int64)
                   for w in (np.ones(len(pair)), toxic, times, times * toxic)]
            self.counts = np.pad(self.counts, ((0, 0), (0, len(self.names) - self.counts.shape[1]))) + new
        self.clear()

    def batch(self) -> pa.RecordBatch:
        self.settle()
        out = pa.RecordBatch.from_arrays([pa.array(list(self.names)[:self.counts.shape[1]]), *map(pa.array, self.counts)],
                                         ["feature", "n", "toxic", "times", "toxic_times"])
        self.reset()
        return out


def _counted(model: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally(model)
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                tally.add(text.as_py(), toxic)
                if len(tally.ids) > _CACHE:
                    tally.settle()
                if len(tally.names) > 4 * _CACHE:
                    yield tally.batch()
        tally.settle()
        if tally.counts.any():
            yield tally.batch()
    return run


@dataclass(frozen=True)
class Model:
    language: np.ndarray
    weights: dict[str, float]  # telling feature: log of its rate in toxic against other texts
    excess: float  # how much more of the tokens of toxic texts are telling
    fitted: tuple[float, ...]  # of the logistic regression on _evidence


def _evidence(total: float, top: float, tokens: int, excess: float) -> tuple[float, ...]:
    """Numbers of a document for the regression: its log likelihood ratio (hits as a Poisson number), damped; its weights."""
    ratio = total - tokens * excess
    return 1.0, math.copysign(math.log1p(abs(ratio)), ratio) if total else 0.0, math.log1p(total), top


def _regression(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Logistic regression with a small ridge, by Newton's method."""
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (y - p) - 0.1 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from the labelled rows that are not held out; the greater label of an id that has several."""
    language = language_model(docs)
    known = (labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    total = known.count()
    if total > train_rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < int(train_rows / total * (1 << 32)))
    # about train_rows rows of two numbers at most, so every task may have them; of rows that repeat an id the least text
    rows = docs.select("doc_id", whole().alias("text")).join(F.broadcast(known), "doc_id")
    rows = stored(rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("toxic").alias("toxic")).select("text", "toxic"), "training")
    counts = rows.mapInArrow(_counted(language), "feature string, n long, toxic long, times long, toxic_times long")
    counts = stored(counts.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ("n", "toxic", "times", "toxic_times")]), "features")
    every = counts.where("feature = ''").first()
    if every is None or not 0 < every.toxic < every.n:  # nothing to tell apart
        return Model(language, {}, 0.0, (0.0, 0.0, 0.0, 0.0))
    rate, features = every.toxic / every.n, max(2, counts.count())
    gain = lambda k, share: F.when(k > 0, k * F.log(k / (F.col("n") * share))).otherwise(0.0)
    ratio = 2 * (gain(F.col("toxic"), rate) + gain(F.col("n") - F.col("toxic"), 1 - rate))
    usual, high = every.times - every.toxic_times, F.col("toxic_times") / every.toxic_times
    low = (F.col("times") - F.col("toxic_times") + 0.5) / (usual + 0.5)
    # rates in toxic and in other texts are set against each other, so that the share of toxic labels does not matter
    likelier = F.col("toxic") * (1 - rate) >= LIKELIER * rate * (F.col("n") - F.col("toxic"))
    telling = (counts.where("feature <> ''").where((ratio >= 2 * math.log(features)) & likelier)
               .select("feature", F.log(high / low).alias("weight")).where("weight > 1"))
    # chance alone brings about one feature at most, so these follow the words that mark the sample, not its size
    weights = {r.feature: r.weight for r in telling.collect()}
    plain = Model(language, weights, 0.0, ())
    seen = rows.mapInArrow(_measured(plain, "toxic"), "toxic long, total double, top double, tokens long, hits long").collect()
    y = np.array([r.toxic for r in seen], float)
    tokens, hits = np.array([r.tokens for r in seen], float), np.array([r.hits for r in seen], float)
    share = lambda of: float(hits[of].sum() / max(1.0, tokens[of].sum()))
    excess = max(0.0, share(y == 1) - share(y == 0))
    x = np.array([_evidence(r.total, r.top, r.tokens, excess) for r in seen])
    return Model(language, weights, excess, _regression(x, y))


def _measured(model: Model, keep: str):
    """keep, total and top weight, tokens, hits of each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restored, weights, telling = Restorer(model.language), model.weights, Telling(model.weights)
        features, heads, least = _token_features(restored), {f[:BEGINNINGS[0]] for f in model.weights}, BEGINNINGS[0]

        def weight(token: str) -> float:
            if not _DISGUISED.search(token):
                if all(w[:least] not in heads for w in _LETTERS.findall(token)):
                    return 0.0  # most tokens: nothing telling begins like this
            elif not telling.possible(token):
                return 0.0  # nor can a reading
            return max((weights.get(f, 0.0) for f in features(token)), default=0.0)
        known, tells = set(), {}  # tokens weighed, and those with a weight
        for batch in batches:
            rows = []
            for text in batch.column(batch.schema.get_field_index("text")):
                tokens = _pieces(text.as_py(), restored, telling)
                distinct = set(tokens)
                for t in distinct - known:
                    if w := weight(t):
                        tells[t] = w
                known |= distinct
                found = [] if distinct.isdisjoint(tells) else [tells[t] for t in tokens if t in tells]
                rows.append((math.fsum(found), max(found, default=0.0), len(tokens), len(found)))
                if len(known) > _CACHE:
                    known.clear(), tells.clear()
            total, top, tokens, hits = zip(*rows) if rows else ((), (), (), ())
            kept = batch.column(batch.schema.get_field_index(keep)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [kept, pa.array(total, pa.float64()), pa.array(top, pa.float64()), pa.array(tokens, pa.int64()), pa.array(hits, pa.int64())],
                [keep, "total", "top", "tokens", "hits"])
    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from CUTOFF on) per row of docs.

    A null or empty text scores like one without evidence. Null ids are kept, not held out. Rows that repeat
    are scored each; an empty table gives none; without labels every score is 0.5. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text"))
    found = rows.mapInArrow(_measured(model, "doc_id"), "doc_id long, total double, top double, tokens long, hits long")
    ratio = F.col("total") - F.col("tokens") * model.excess
    numbers = (F.lit(1.0), F.when(F.col("total") > 0, F.signum(ratio) * F.log1p(F.abs(ratio))).otherwise(0.0),
               F.log1p("total"), F.col("top"))
    z = sum((n * w for n, w in zip(numbers, model.fitted)), F.lit(0.0))
    found = found.withColumn("score", 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0)))))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted"))


@query()
def op10_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, fit(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic")))
