"""A corpus through five stages: quality rules, near-duplicates, secrets, source mix, tokens.

STAGES lists (name, function of (spark, docs, sf_dir)). All but the last return the columns of documents; the last
returns doc_id, lang, source, n_tokens and ids, a row per document of the mix. run() applies them to documents, each
stage's rows written below the folder of spark.checkpoint.dir and read again by the next, so a lost executor costs
at most a part of one stage. Null texts, empty tables, repeated rows and extra columns are handled as the operators
say; every stage looks at all rows of the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, mixing, quality, secrets, simhash
from tidemark.llm.common import stored, table
from tidemark.queries.registry import Query


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.kept_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates."""
    return simhash.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Owner-specific secrets replaced by a mark."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mix_documents(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix."""
    tokens = bpe.encode(docs.select("doc_id", "lang", "source", "text"))
    return tokens.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [
    ("quality rules", keep_quality),
    ("near duplicates", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("source mix", mix_sources),
    ("tokens", tokenize),
]

# SimHash components and byte-pair merges are beyond SQL; tests/llm compares run() with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


QUERY = Query(run, ORACLE_SQL)
