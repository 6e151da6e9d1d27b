"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

A block is 2 * STRIDE words from every STRIDE-th word on, so that any run of STRIDE words lies whole in one. A
template is found in a block if the block holds THRESHOLD of the template's different words. The words of all
templates are counted over the whole corpus and ordered from rare to frequent. If a block is to hold at least
`need` words of a template, it holds one of the template's rarest size - need + 1: its prefix. So only blocks
with a prefix word are cut out and joined on it; the length filter (too few template words in the block) and the
positional filter (too few left after the match) thin the candidates before the overlap is counted.

A template of more than STRIDE words is cut into pieces of about equal length, at most STRIDE words each; a piece found
is the template found, so a text that holds a part of a long license is labelled too.

Templates and their words are a parameter of fixed size. The texts are read twice, for the counts and for the
blocks; what is shuffled are counts and the few candidate blocks.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, ascii_lower, row_key, stored, table, whole, words
from tidemark.llm.registry import query
from tidemark.session import one_row

TOKEN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # a fixed value
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))  # fixed values
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("mpl", "Subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
)
THRESHOLD = 0.9
STRIDE = 32


def _tokens(text: str) -> list[str]:
    return re.findall(TOKEN, text.translate(str.maketrans(UPPER, LOWER)))


def cut_templates(templates: Sequence[tuple[str, str]], stride: int) -> list[tuple[str, str]]:
    """(label, text) of at most `stride` words each, of about equal length; templates without words go."""
    out = []
    for label, text in templates:
        own = _tokens(text)
        pieces = -(-len(own) // stride)
        out += [(label, " ".join(own[len(own) * i // pieces:len(own) * (i + 1) // pieces])) for i in range(pieces)]
    return out


class Templates:
    """Templates in the corpus's order of words. counts: of every word of theirs over all documents."""

    def __init__(self, templates: Sequence[tuple[str, str]], counts: dict[str, int], threshold: float):
        self.sets = [(label, set(_tokens(text))) for label, text in templates]
        self.order = sorted(set().union(*[s for _, s in self.sets]), key=lambda w: (counts.get(w, 0), w))
        rank = {w: i for i, w in enumerate(self.order)}
        self.rows = []  # (label, ranks from rare to frequent, words needed, length of the prefix)
        for label, own in self.sets:
            need = max(1, math.ceil(round(threshold * len(own), 9)))
            self.rows.append((label, sorted(rank[w] for w in own), need, len(own) - need + 1))
        self.prefix = sorted({self.order[r] for _, ranks, _, n in self.rows for r in ranks[:n]})


def word_counts(docs: DataFrame, vocabulary: Sequence[str]) -> DataFrame:
    """word, n: how often each word of the vocabulary stands in all texts."""
    return (docs.select(F.explode(words(ascii_lower(whole()), TOKEN)).alias("word")).where(F.col("word").isin(*vocabulary))
            .groupBy("word").agg(F.count("*").alias("n")))


def _starts(phrase: Sequence[str]) -> Column:
    """Places where the words of the phrase stand one after the other."""
    at = F.sequence(F.lit(0), F.size("_words") - len(phrase))
    match = lambda i: _all([F.get("_words", (i + k).cast("int")) == w for k, w in enumerate(phrase)])
    possible = F.array_contains("_words", phrase[-1]) & (F.size("_words") >= len(phrase))
    return F.when(possible, F.filter(at, match)).otherwise(F.array().cast("array<int>"))


def _all(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out & t
    return out


def blocks(docs: DataFrame, known: Templates, phrases: Sequence[tuple[str, str]], stride: int) -> DataFrame:
    """doc_id, _id, _hash, n_words, base (places and labels of phrases), blocks (number, ranks of template words)."""
    rows = docs.select("doc_id", *row_key(), words(ascii_lower(whole()), TOKEN).alias("_words"))
    named = lambda label: lambda i: F.struct(i.cast("long").alias("at"), F.lit(label).alias("label"))
    places = [F.transform(_starts(_tokens(p)), named(label)) for p, label in phrases]
    base = F.concat(*places) if places else F.array().cast("array<struct<at:bigint,label:string>>")
    prefix, s = known.prefix, F.lit(stride)
    hits = F.filter(F.transform("_words", lambda w, i: F.when(w.isin(*prefix), i)), lambda i: i.isNotNull())
    rows = rows.withColumns({"base": base, "_hits": hits})
    numbers = F.array_distinct(F.flatten(F.transform("_hits", lambda i: F.array(
        F.floor(i / s).cast("int"), F.greatest(F.floor(i / s) - 1, F.lit(0)).cast("int")))))
    rows = rows.withColumn("_numbers", numbers)
    ranks = F.create_map(*[F.lit(x) for i, w in enumerate(known.order) for x in (w, i)])
    inside = lambda b: F.sort_array(F.array_distinct(F.filter(F.transform(
        F.slice("_words", b * s + 1, 2 * s), lambda w: F.when(w.isin(*known.order), F.element_at(ranks, w))), lambda r: r.isNotNull())))
    cut = F.transform("_numbers", lambda b: F.struct(b.alias("block"), inside(b).alias("ranks")))
    return rows.select("doc_id", "_id", "_hash", F.size("_words").cast("long").alias("n_words"), "base", cut.alias("blocks"))


def join_templates(cut: DataFrame, known: Templates) -> DataFrame:
    """_id, _hash, block, label, containment: every block and template at or above the threshold."""
    spark = cut.sparkSession
    entries = [F.struct(F.lit(no).alias("template"), F.lit(label).alias("label"), F.lit(ranks).cast("array<int>").alias("own"),
                        F.lit(need).alias("need"), F.lit(i).alias("i"), F.lit(ranks[i]).alias("rank"))
               for no, (label, ranks, need, n) in enumerate(known.rows) for i in range(n)]
    index = one_row(spark, e=F.explode(F.array(*entries))).select("e.*")
    each = (cut.select("_id", "_hash", F.explode("blocks").alias("b")).select("_id", "_hash", "b.*")
            .select("_id", "_hash", "block", "ranks", F.posexplode("ranks").alias("j", "rank")))
    left = 1 + F.least(F.size("own") - F.col("i") - 1, F.size("ranks") - F.col("j") - 1)
    met = (each.join(index, "rank").where((F.size("ranks") >= F.col("need")) & (left >= F.col("need")))
           # a pair may meet on several prefix words, or in rows alike
           .dropDuplicates(["_id", "_hash", "block", "template"]))
    overlap = F.size(F.array_intersect("ranks", "own"))
    return met.where(overlap >= F.col("need")).select("_id", "_hash", "block", "label", (overlap / F.size("own")).alias("containment"))


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD,
                  phrases: Sequence[tuple[str, str]] = PHRASES, stride: int = STRIDE) -> DataFrame:
    """Per row of docs: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    n_base counts the places of all phrases; labels joins theirs with those of templates found in a block; score is 1
    with a phrase, else the highest containment found, else 0. Templates of more than `stride` words are cut.

    A null or empty text has no words, places null, labels empty, score 0. Rows that repeat get the same answer each;
    null ids are kept; an empty table gives none. Other columns are ignored.
    """
    templates = cut_templates(templates, stride)
    docs = docs.select("doc_id", "text")
    vocabulary = sorted({w for _, text in templates for w in _tokens(text)})
    # one row per word of the templates
    counts = {r.word: r.n for r in word_counts(docs, vocabulary).collect()}
    known = Templates(templates, counts, threshold)
    cut = stored(blocks(docs, known, phrases, stride), "blocks")
    found = (join_templates(cut, known).groupBy("_id", "_hash")
             .agg(F.collect_set("label").alias("_labels"), F.max("containment").alias("_score")))
    base = F.transform("base", lambda s: s["label"])
    joined = cut.where(F.size("blocks") > 0).join(found, ["_id", "_hash"], "left").select(*cut.columns, "_labels", "_score")
    none = cut.where(F.size("blocks") == 0).withColumns({"_labels": F.lit(None).cast("array<string>"), "_score": F.lit(None).cast("double")})
    text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return joined.unionByName(none).select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda s: s["at"])).alias("first_word"),
        F.array_max(F.transform("base", lambda s: s["at"])).alias("last_word"),
        text(base).alias("base_labels"), text(F.concat(base, F.coalesce("_labels", F.array().cast("array<string>")))).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce("_score", F.lit(0.0))).alias("score"))


def _sql() -> str:
    rows = ", ".join(f"({no}, '{label}', {_tokens(text)!r})" for no, (label, text) in enumerate(TEMPLATES))
    phrases = ", ".join(f"({_tokens(p)!r}, '{label}')" for p, label in PHRASES)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TOKEN}') AS w FROM documents),
p(words, label) AS (VALUES {phrases}),
t(no, label, words) AS (VALUES {rows}),
tok AS (SELECT no, label, unnest(list_distinct(words)) AS word, len(list_distinct(words)) AS size FROM t),
hits AS (SELECT r, label, i - 1 AS place FROM (SELECT r, w, label, words, unnest(range(1, len(w) - len(words) + 2)) AS i FROM d, p
    WHERE list_contains(w, words[-1])) WHERE list_slice(w, i, i + len(words) - 1) = words),
base AS (SELECT r, count(*) AS n, min(place) AS a, max(place) AS z, list(DISTINCT label) AS labels FROM hits GROUP BY r),
pos AS (SELECT r, unnest(w) AS word, unnest(range(0, len(w))) AS i FROM d),
seen AS (SELECT r, tok.no, label, word, size, unnest([i // {STRIDE}, i // {STRIDE} - 1]) AS b FROM pos JOIN tok USING (word)),
cont AS (SELECT r, label, count(DISTINCT word) / size AS c FROM seen WHERE b >= 0 GROUP BY r, no, label, size, b
    HAVING count(DISTINCT word) >= ceil(round({THRESHOLD} * size, 9))),
sim AS (SELECT r, list(DISTINCT label) AS labels, max(c) AS c FROM cont GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, z::BIGINT AS last_word,
    coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
    coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(sim.labels, [])))), ','), '') AS labels,
    CASE WHEN n > 0 THEN 1.0 ELSE coalesce(c, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base ON d.r = base.r LEFT JOIN sim ON d.r = sim.r"""


@query(_sql())
def op8_license_scans(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))
