"""Quality rules with thresholds that adapt to each language and source.

Fixed rules of the contract come first (base_failed). Beyond them a document is turned away if one of its
measures lies far outside what is usual for its language and source: beyond an upper (or lower) quantile of the
group by several times the distance between two of its quantiles, and by the sketch's error at least (FENCES). There
is no other cutoff. Quantiles come from mergeable sketches: counts per bin of
whole numbers, so sketches of parts add up, a source's sum to its language's, and any order of merging gives
the same thresholds. A bin is a thousandth (shares) or a tenth of a character (word length); ERROR bins are taken as
the sketch's error. A source's limits are blended with its language's, weighted n : PRIOR, so small
sources lean on their language.

Two passes over the texts: one counts bins (combined before the shuffle, a few hundred rows per group), the
other joins the thresholds, a row per group, and judges. No text is shuffled if the thresholds are small
enough to be sent to all; if not, a hot group is split by the skew join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import DOCUMENT, WORD, stored, table, whole, words
from tidemark.llm.registry import query

SYMBOLS = "#*$%&|<>"  # a fixed value
SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
PRIOR = 50
#: measure: (lower and upper quantile in percent, how many times their distance a fence stands off, whether there is a lower
#: one). A few repeated lines are usual in few texts, so that measure takes a high quantile.
FENCES = {"symbols": (25, 75, 5, False), "dup_lines": (25, 99, 1, False), "word_length": (25, 75, 5, True)}
ERROR = 5
LAST_BIN = 1000


def _text_measures(text: Column) -> dict[str, Column]:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    return {"n_words": F.regexp_count(text, F.lit(WORD)).cast("long"),
            "word_chars": F.length(F.regexp_replace(text, SPACE, "")).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
            "_lines": lines}


def cheap_measures(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_lines."""
    return (docs.withColumns(_text_measures(whole()))
            .withColumn("n_lines", F.size("_lines").cast("long"))
            .withColumn("n_dup_lines", F.col("n_lines") - F.size(F.array_distinct("_lines"))).drop("_lines"))


def repeated_words(docs: DataFrame) -> DataFrame:
    """docs with n_repeat_words: words in windows of five that occur twice or more in the text."""
    w, last = F.col("_words"), F.size("_words") - WINDOW
    starts = F.when(last >= 1, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    docs = docs.withColumn("_words", words(whole()))
    docs = docs.withColumn("_hashes", F.transform(starts, lambda i: F.xxhash64(
        *[F.get(w, (i + k).cast("int")) for k in range(WINDOW)])))
    # equal windows have equal hashes: without repeated hashes there is nothing to compare
    docs = docs.withColumn("_sorted", F.when(
        F.size(F.array_distinct("_hashes")) < F.size("_hashes"),
        F.sort_array(F.transform(starts, lambda i: F.struct(
            F.array_join(F.slice(w, i + 1, WINDOW), " ").alias("g"), i.alias("i"))))))
    g = lambda i: F.get("_sorted", i.cast("int"))["g"]
    hits = F.filter(F.transform(F.col("_sorted"), lambda s, j: F.when(
        (F.coalesce(g(j - 1) == s["g"], F.lit(False))) | F.coalesce(g(j + 1) == s["g"], F.lit(False)), s["i"])),
        lambda i: i.isNotNull())
    docs = docs.withColumn("_hits", F.sort_array(hits))
    gaps = F.transform(F.col("_hits"), lambda i, j: F.coalesce(
        F.least(F.get("_hits", (j + 1).cast("int")) - i, F.lit(WINDOW)), F.lit(WINDOW)))
    n = F.coalesce(F.aggregate(gaps, F.lit(0), lambda a, b: a + b), F.lit(0)).cast("long")
    return docs.withColumn("n_repeat_words", n).drop("_words", "_hashes", "_sorted", "_hits")


def _share(part: str, of: str) -> Column:
    """Thousandths, rounded down; 0 of 0 is 0."""
    return F.expr(f"least(1000 * {part} div greatest({of}, 1), {LAST_BIN})")


def bins() -> dict[str, Column]:
    """The bin of each measure, from the columns of cheap_measures."""
    return {"symbols": _share("n_symbols", "word_chars"), "dup_lines": _share("n_dup_lines", "n_lines"),
            "word_length": F.expr(f"least(10 * word_chars div greatest(n_words, 1), {LAST_BIN})")}


def sketch(measured: DataFrame) -> DataFrame:
    """lang, source, measure, bin, n: the sketch of every language and source. Sketches merge by adding n."""
    rows = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), b.alias("bin")) for m, b in bins().items()]))
    return (measured.select("lang", "source", rows.alias("r")).select("lang", "source", "r.*")
            .groupBy("lang", "source", "measure", "bin").agg(F.count("*").alias("n")))


def _limits(counts: DataFrame, keys: list[str]) -> DataFrame:
    """keys, measure, n, low, high: limits from the quantiles of each sketch."""
    group = W.partitionBy(*keys, "measure")
    upto = group.orderBy("bin").rowsBetween(W.unboundedPreceding, 0)
    run = counts.withColumns({"_upto": F.sum("n").over(upto), "_all": F.sum("n").over(group)})
    def pick(which):
        out = F.lit(None).cast("int")
        for m, fence in FENCES.items():
            out = F.when(F.col("measure") == m, F.lit(which(fence))).otherwise(out)
        return out
    quantile = lambda percent: F.min(F.when(F.col("_upto") * 100 >= F.col("_all") * percent, F.col("bin")))
    q = run.groupBy(*keys, "measure").agg(F.max("_all").alias("n"), quantile(pick(lambda f: f[0])).alias("lower"),
                                          quantile(pick(lambda f: f[1])).alias("upper"))
    off = pick(lambda f: f[2]) * (F.col("upper") - F.col("lower")) + ERROR
    return q.select(*keys, "measure", "n", F.when(pick(lambda f: int(f[3])) == 1, F.col("lower") - off).alias("low"),
                    (F.col("upper") + off).alias("high"))


def thresholds(counts: DataFrame) -> DataFrame:
    """_lang, _source, n, and <measure>_low, <measure>_high times (n + PRIOR): a row per language and source."""
    own = _limits(counts, ["lang", "source"])
    langs = counts.groupBy("lang", "measure", "bin").agg(F.sum("n").alias("n"))
    of_lang = _limits(langs, ["lang"]).select(F.col("lang").alias("_l"), F.col("measure").alias("_m"),
                                              F.col("low").alias("_low"), F.col("high").alias("_high"))
    both = own.join(of_lang, own.lang.eqNullSafe(F.col("_l")) & (F.col("measure") == F.col("_m")))
    sides = []
    for m in FENCES:
        for side in ("low", "high"):
            blend = F.col("n") * F.col(side) + PRIOR * F.col(f"_{side}")
            sides.append(F.max(F.when(F.col("measure") == m, blend)).alias(f"{m}_{side}"))
    return (both.groupBy("lang", "source").agg(F.max("n").alias("n"), *sides)
            .withColumnsRenamed({"lang": "_lang", "source": "_source"}))


def judge(docs: DataFrame) -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    docs has text, lang, source; any other column passes through unless it has the name of a result. Null text
    counts as empty and fails the base rules. Null lang or source is a group of its own. Rows that repeat are
    judged alike and all returned; an empty table gives none.
    """
    results = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    columns = [c for c in docs.columns if c.lower() not in results]
    # the other columns travel in a struct, so that none clashes with a step's
    own = ("text", "lang", "source")
    rest = [c for c in columns if c.lower() not in own]
    docs = docs.select(F.struct(F.lit(0).alias("_"), *[docs[c] for c in rest]).alias("_rest"), *[docs[c] for c in own])
    counts = stored(sketch(cheap_measures(docs.select("text", "lang", "source"))), "sketch")
    limits = stored(thresholds(counts), "limits")  # written, so that Spark knows its size before it picks the join
    measured = cheap_measures(repeated_words(docs))
    # A filter on the verdict must not be pushed into the steps that make the measures: they would be spelled out in
    # it and evaluated again for every word. Nothing is pushed below a generator that makes what it tests.
    measures = F.explode(F.array(F.struct("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")))
    measured = measured.select("_rest", *own, measures.alias("_m")).select("_rest", *own, "_m.*")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    usual = F.lit(True)
    for m, b in bins().items():
        usual = usual & (b * (F.col("n") + PRIOR) <= F.col(f"{m}_high"))
        usual = usual & F.coalesce(b * (F.col("n") + PRIOR) >= F.col(f"{m}_low"), F.lit(True))
    joined = measured.join(limits, docs.lang.eqNullSafe(F.col("_lang")) & docs.source.eqNullSafe(F.col("_source")), "left")
    return (joined.withColumn("base_failed", failed).withColumn("kept", ~failed & F.coalesce(usual, F.lit(True)))
            .select(*[F.col(f"_rest.`{c}`") if c in rest else F.col(c) for c in columns], *results))


def kept_documents(docs: DataFrame) -> DataFrame:
    """The documents the rules keep; columns of documents."""
    docs = docs.select(*DOCUMENT)
    return judge(docs).where("kept").select(*DOCUMENT)


_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
grams AS (SELECT r, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS g FROM (
    SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) > 5)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM twice) GROUP BY r),
m AS (SELECT w.r, doc_id, lang, source, len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, len(ls) AS n_lines,
    coalesce(rep.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN rep ON w.r = rep.r),
b AS (SELECT r, lang, source, unnest([{'m': 1, 'b': least(1000 * n_symbols // greatest(word_chars, 1), 1000)},
    {'m': 2, 'b': least(1000 * n_dup_lines // greatest(n_lines, 1), 1000)},
    {'m': 3, 'b': least(10 * word_chars // greatest(n_words, 1), 1000)}], recursive := true) FROM m),
f(m, lo, up, times, lowered) AS (VALUES (1, 25, 75, 5, false), (2, 25, 99, 1, false), (3, 25, 75, 5, true)),
place AS (SELECT lang, source, b.m, b, lo, up, row_number() OVER g AS i, count(*) OVER (PARTITION BY lang, source, b.m) AS n,
    row_number() OVER h AS li, count(*) OVER (PARTITION BY lang, b.m) AS ln FROM b JOIN f ON f.m = b.m
    WINDOW g AS (PARTITION BY lang, source, b.m ORDER BY b), h AS (PARTITION BY lang, b.m ORDER BY b)),
own AS (SELECT lang, source, m, max(n) AS n, min(b) FILTER (100 * i >= lo * n) AS q1, min(b) FILTER (100 * i >= up * n) AS q3 FROM place GROUP BY ALL),
lng AS (SELECT lang, m, min(b) FILTER (100 * li >= lo * ln) AS q1, min(b) FILTER (100 * li >= up * ln) AS q3 FROM place GROUP BY ALL),
lim AS (SELECT o.lang, o.source, o.m, n, n * (o.q3 + times * (o.q3 - o.q1) + 5) + 50 * (l.q3 + times * (l.q3 - l.q1) + 5) AS hi,
    CASE WHEN lowered THEN n * (o.q1 - times * (o.q3 - o.q1) - 5) + 50 * (l.q1 - times * (l.q3 - l.q1) - 5) END AS lo
    FROM own o JOIN lng l ON o.lang IS NOT DISTINCT FROM l.lang AND o.m = l.m JOIN f ON f.m = o.m),
odd AS (SELECT DISTINCT b.r FROM b JOIN lim ON b.lang IS NOT DISTINCT FROM lim.lang
    AND b.source IS NOT DISTINCT FROM lim.source AND b.m = lim.m
    WHERE b.b * (n + 50) > hi OR coalesce(b.b * (n + 50) < lo, false)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND odd.r IS NULL AS kept FROM judged LEFT JOIN odd ON judged.r = odd.r"""


@query(_SQL)
def op9_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return judge(docs).drop("text", "lang", "source")
