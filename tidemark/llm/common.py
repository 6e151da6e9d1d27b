"""Helpers the operators share: words, row keys, work tables in the shared folder, running totals."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import work_root

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x20\x09-\x0D]+"  # a fixed pattern: what is not ASCII white space
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, everything else untouched, so positions stay."""
    return F.translate(text, UPPER, LOWER)


def whole(text: str | Column = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def free_name(taken: list[str], name: str) -> str:
    """name, with as many underscores before it as make it none of `taken`."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name


def words(text: Column, pattern: str = WORD) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """_id (doc_id, null as the least long) and _hash: what names a row where doc_id may be null or repeated.

    Rows that agree in both are alike for an operator, so results can be joined back on them.
    """
    least = F.lit(-(1 << 63)).cast("long")
    return [F.coalesce(F.col(doc_id).cast("long"), least).alias("_id"),
            F.xxhash64(F.col(doc_id).isNull(), F.col(text).isNull(), F.col(text)).alias("_hash")]


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written below the shared folder and read back: lineage ends here, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{work_root(spark)}/tidemark-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove a table that `stored` wrote and nothing reads any more."""
    spark = df.sparkSession
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        if "/tidemark-llm/" not in folder:
            raise ValueError(f"{folder} is no work table")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def running_before(df: DataFrame, group: list[str], bucket: str, order: list[str], amount: str, out: str) -> DataFrame:
    """df with `out`: the sum of `amount` over the rows of the group that come earlier in (bucket, order).

    A hot group is spread over its buckets: only sums of buckets meet in one task. Group and bucket hold no null.
    """
    keys = [*group, bucket]
    sums = df.groupBy(*keys).agg(F.sum(amount).alias("_sum"))
    earlier = W.partitionBy(*group).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(*keys, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (df.join(sums, keys)
            .withColumn(out, F.col("_before") + F.coalesce(F.sum(amount).over(inside), F.lit(0)))
            .drop("_before"))


def ranked(df: DataFrame, column: str, out: str) -> DataFrame:
    """df (distinct `column`) with its place in ascending order, null last, from 0; no task holds all rows."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = F.col(column).asc_nulls_last()
    df = stored(df.repartitionByRange(n, by).withColumn("_part", F.spark_partition_id()), "ranked")
    counts = df.groupBy("_part").count()
    # one row per partition, so this window is small whatever df holds
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("_part", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(W.partitionBy("_part").orderBy(by))
    return df.join(counts, "_part").withColumn(out, F.col("_before") + place - 1).drop("_part", "_before")
