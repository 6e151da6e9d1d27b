"""Mixing sources to target weights by a low-discrepancy schedule over shuffled blocks of equal length.

1. Targets. Weighted shares of the mix, each at most `cap` times its source; the excess is shared again by
   weight until no source is above.
2. Blocks. The documents of a source are shuffled by a hash and laid end to end; every `block_words` words
   are a block (the last one is shorter). A source whose target exceeds its size starts over from block 0.
3. Schedule. Slot k of S has the golden-ratio point frac(k / phi); the point falls into the interval of one
   source among the cumulative shares. The slots of a source are ranked; rank r takes the source's r-th block.
   The points give each source its share but for a few slots: what it has too many of falls away, what it
   lacks is added at the end, so the words taken are the target, rounded down.

All running totals go by buckets of a hot source (common.running_before); joins are on (source, block).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import DOCUMENT, WORD, ranked, running_before, stored, table, whole
from tidemark.llm.registry import query

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BLOCK_WORDS = 1024
_POINTS = 1 << 31  # the points are multiples of 1 / _POINTS
_GOLDEN = 1327217885  # odd and next to _POINTS / phi
_BUCKETS = 4096  # of a source, for running totals


def _key() -> Column:
    null = F.lit("\u0000")
    return F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")),
                             F.coalesce("source", null), F.md5(F.coalesce("text", null))))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words) and key: the shuffled place of the document, by its id, source and text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", _key().alias("key"),
                       F.regexp_count(whole(), F.lit(WORD)).cast("long").alias("size"))


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """source, source_no (by code point, null last), source_size, target: a row per source."""
    per = ranked(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "source", "source_no")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("source_no") % len(weights)).cast("int"))
    per = stored(per.select("source", "source_no", "source_size", weight.alias("weight")), "sources")
    total = share * (per.agg(F.sum("source_size")).first()[0] or 0)

    level, full = None, -1
    while True:  # each round fixes at least one more source at its cap, or ends; a round is one row of sums
        above = F.lit(False) if level is None else cap * F.col("source_size") < level * F.col("weight")
        r = per.agg(F.count_if(above).alias("n"), F.sum(F.when(above, cap * F.col("source_size"))).alias("kept"),
                    F.sum(F.when(~above, F.col("weight"))).alias("weight")).first()
        if r.n == full or not r.weight:
            break
        full, level = r.n, (total - (r.kept or 0)) / r.weight
    level = level or 0.0
    capped = cap * F.col("source_size") < level * F.col("weight")
    target = F.when(capped, (cap * F.col("source_size")).cast("double")).otherwise(level * F.col("weight"))
    return per.select("source", "source_no", "source_size", target.cast("double").alias("target"))


def _needs(per: DataFrame, block_words: int) -> DataFrame:
    """per with quota (words to take), blocks (of one pass) and slots (blocks to take)."""
    size, quota, block = F.col("source_size"), F.col("quota"), F.lit(block_words)
    up = lambda words: F.expr(f"({words} + {block_words} - 1) div {block_words}")
    return (per.withColumn("quota", F.floor("target")).withColumn("blocks", up("source_size"))
            .withColumn("slots", F.when(size > 0, F.expr("quota div source_size") * F.col("blocks")
                                        + up("(quota % source_size)")).otherwise(0).cast("long")))


def schedule(per: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The slots of the mix: slot (their order), source_no, pass, block, words (taken from the block's start).

    per: as targets() gives it, stored. Sources without words have no slots.
    """
    spark = per.sparkSession
    need = stored(_needs(per, block_words), "needs")
    total, n_sources = need.agg(F.sum("slots"), F.count("*")).first()
    total = total or 0
    ends = running_before(need.withColumn("_all", F.lit(0)).withColumn("_bucket", F.expr(f"source_no div {_BUCKETS}")),
                          ["_all"], "_bucket", ["source_no"], "slots", "low")
    bins = 1024
    while bins < 4 * n_sources and bins < 65536:
        bins *= 2
    spans = (ends.where("slots > 0").select("source_no", "slots", "low", (F.col("low") + F.col("slots")).alias("high"))
             .withColumn("_bin", F.explode(F.expr(f"sequence(low * {bins} div {total or 1}, "
                                                  f"least(high * {bins} div {total or 1}, {bins - 1}))"))))
    place = F.floor((F.col("slot") % _POINTS * _GOLDEN % _POINTS) * F.lit(total / _POINTS))
    points = (spark.range(total).withColumnRenamed("id", "slot").withColumn("_place", place)
              .withColumn("_bin", F.expr(f"_place * {bins} div {total or 1}")))
    drawn = (points.join(spans, "_bin").where("_place >= low AND _place < high")
             .select("source_no", "slot", F.expr(f"slot * {_BUCKETS} div {total or 1}").alias("_bucket"),
                     F.lit(1).alias("_one")))
    drawn = running_before(drawn, ["source_no"], "_bucket", ["slot"], "_one", "rank").select("source_no", "slot", "rank")
    counts = drawn.groupBy("source_no").count()
    need = need.where("slots > 0")
    kept = drawn.join(need, "source_no").where("rank < slots")
    rest = (need.join(counts, "source_no", "left").fillna(0, ["count"]).where("count < slots")
            .withColumn("rank", F.explode(F.expr("sequence(count, slots - 1)")))
            .withColumn("slot", F.lit(total) + F.col("rank")))
    every = kept.select(*need.columns, "slot", "rank").unionByName(rest.select(*need.columns, "slot", "rank"))
    full = F.least(F.lit(block_words), F.col("source_size") - F.col("block") * block_words)
    before = F.col("pass") * F.col("source_size") + F.col("block") * block_words
    return (every.withColumn("pass", F.expr("rank div blocks")).withColumn("block", F.expr("rank % blocks"))
            .select("slot", "source_no", "pass", "block", F.least(full, F.col("quota") - before).alias("words")))


def pieces(sizes: DataFrame, per: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents laid end to end in shuffled order and cut at blocks: source_no, block, start, length, and
    the document's doc_id, key, size, place. Documents without words have no piece."""
    numbers = per.select(F.col("source").alias("_source"), "source_no")
    rows = (sizes.where("size > 0").join(numbers, sizes.source.eqNullSafe(F.col("_source")))
            .withColumn("_bucket", F.conv(F.substring("key", 1, 3), 16, 10).cast("int")))
    # rows alike in every column tie, and then either order gives the same result
    laid = running_before(rows, ["source_no"], "_bucket", ["key", "doc_id", "size"], "size", "place")
    b = block_words
    return (laid.withColumn("block", F.explode(F.expr(f"sequence(place div {b}, (place + size - 1) div {b})")))
            .withColumn("start", F.greatest(F.col("place") - F.col("block") * b, F.lit(0)))
            .withColumn("length", F.least(F.col("place") + F.col("size"), (F.col("block") + 1) * b)
                        - F.greatest(F.col("place"), F.col("block") * b))
            .select("source_no", "block", "start", "length", "doc_id", "key", "size", "place"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP,
        block_words: int = BLOCK_WORDS, slots_too: bool = False) -> DataFrame:
    """A row per document: doc_id, key, size, source_size, target (its source's), taken (words, repeats counted); with
    slots_too also first_slot and last_slot: the slots of the schedule that take words of it first and last, null if none does.

    A source's taken words are its target rounded down; no document is taken more than `cap` times. The order
    is by hash of id, source and text, so a rerun agrees whatever the partitions. A null or empty text has size 0
    and is never taken. Null source: a source of its own, the last. Null or repeated doc_id: rows are laid out
    one by one; rows alike in every column may be taken unequally, which of them is immaterial. An empty table
    gives an empty result. Other columns are ignored.
    """
    sizes = stored(sized(docs), "sizes")
    per = stored(targets(sizes, weights, share, cap), "targets")
    slots = schedule(per, block_words)
    # a block is taken at most cap + 1 times, the last time perhaps in part
    taken = slots.groupBy("source_no", "block").agg(F.collect_list(F.struct("words", "slot")).alias("_takes"))
    got = pieces(sizes, per, block_words).join(taken, ["source_no", "block"], "left")
    takes = F.filter(F.coalesce("_takes", F.array().cast("array<struct<words:bigint,slot:bigint>>")), lambda t: t["words"] > F.col("start"))
    words = F.aggregate(takes, F.lit(0).cast("long"), lambda s, t: s + F.least(t["words"] - F.col("start"), F.col("length")))
    slots = F.transform(takes, lambda t: t["slot"])
    got = (got.withColumns({"_words": words, "_first": F.array_min(slots), "_last": F.array_max(slots)})
           .groupBy("source_no", "place", "doc_id", "key", "size")
           .agg(F.sum("_words").alias("taken"), F.min("_first").alias("first_slot"), F.max("_last").alias("last_slot")).drop("place"))
    numbers = per.select(F.col("source").alias("_source"), "source_no")
    empty = (sizes.where("size = 0").join(numbers, sizes.source.eqNullSafe(F.col("_source")))
             .select("source_no", "doc_id", "key", "size", *[F.lit(v).cast("long").alias(c) for v, c in (
                 (0, "taken"), (None, "first_slot"), (None, "last_slot"))]))
    return (got.unionByName(empty).join(per.drop("source"), "source_no")
            .select("doc_id", "key", "size", "source_size", "target", "taken", *(("first_slot", "last_slot") if slots_too else ())))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, whole and as often as they are taken: taken / size times, rounded (at most one
    document of a source is taken in part). Columns of documents; copies are rows alike, rows alike in all
    of doc_id, source and text count together and carry the least lang and n_chars."""
    docs = docs.select(*DOCUMENT)
    times = (mix(docs, **options).where("size > 0").groupBy("key")
             .agg(F.round(F.sum("taken") / F.min("size")).cast("int").alias("_times")).where("_times > 0"))
    rows = docs.withColumn("key", _key()).join(times, "key")
    alike = rows.groupBy("key").agg(*[F.min(c).alias(c) for c in (*DOCUMENT, "_times")])
    return alike.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*DOCUMENT)


_SQL = f"""
WITH sizes AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    md5(coalesce(doc_id::VARCHAR, '-') || '|' || coalesce(source, chr(0)) || '|' || md5(coalesce(text, chr(0)))) AS k
    FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w
    FROM sizes GROUP BY source),
filled AS (SELECT *, 2 * source_size AS c, (1.5 * sum(source_size) OVER ()
      - coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev
    FROM per WINDOW o AS (ORDER BY 2.0 * source_size / w, source NULLS LAST)),
found AS (SELECT arg_min(lev, struct_pack(a := 2.0 * source_size / w, b := source IS NULL, d := source))
    FILTER (c >= lev * w) AS lev FROM filled),
goal AS (SELECT source, source_size, CASE WHEN c < f.lev * w THEN c::DOUBLE ELSE f.lev * w END AS target
    FROM filled, found f),
laid AS (SELECT s.*, row_number() OVER () AS r, g.source_size, g.target, coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY k, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
    FROM sizes s JOIN goal g ON s.source IS NOT DISTINCT FROM g.source),
need AS (SELECT source, source_size, floor(target)::BIGINT AS quota, (source_size + {BLOCK_WORDS - 1}) // {BLOCK_WORDS} AS blocks,
    quota // source_size * blocks + (quota % source_size + {BLOCK_WORDS - 1}) // {BLOCK_WORDS} AS slots FROM goal WHERE source_size > 0),
spans AS (SELECT *, (sum(slots) OVER (ORDER BY source NULLS LAST) - slots)::BIGINT AS low, (sum(slots) OVER ())::BIGINT AS total FROM need),
points AS (SELECT slot, floor((slot % {_POINTS} * {_GOLDEN} % {_POINTS}) * ((SELECT max(total) FROM spans) / {_POINTS}::DOUBLE))::BIGINT AS point
    FROM range((SELECT coalesce(max(total), 0) FROM spans)) t(slot)),
drawn AS (SELECT source, slot, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS rank
    FROM points JOIN spans ON point >= low AND point < low + slots),
added AS (SELECT source, total, unnest(range(coalesce(n, 0), slots)) AS rank
    FROM spans LEFT JOIN (SELECT source AS s, count(*) AS n FROM drawn GROUP BY source) ON source IS NOT DISTINCT FROM s),
every AS (SELECT source, slot, rank FROM drawn UNION ALL SELECT source, total + rank, rank FROM added),
takes AS (SELECT e.source, slot, rank % blocks AS block, least({BLOCK_WORDS}, source_size - rank % blocks * {BLOCK_WORDS},
    quota - rank // blocks * source_size - rank % blocks * {BLOCK_WORDS}) AS words
    FROM every e JOIN spans s ON e.source IS NOT DISTINCT FROM s.source WHERE rank < slots),
parts AS (SELECT r, source, block, greatest(place - block * {BLOCK_WORDS}, 0) AS start,
    least(place + size, (block + 1) * {BLOCK_WORDS}) - greatest(place, block * {BLOCK_WORDS}) AS length
    FROM (SELECT *, unnest(range(place // {BLOCK_WORDS}, (place + size - 1) // {BLOCK_WORDS} + 1)) AS block FROM laid WHERE size > 0)),
got AS (SELECT r, sum(least(words - start, length)) AS taken, min(slot) AS first_slot, max(slot) AS last_slot
    FROM parts p JOIN takes t ON p.block = t.block AND p.source IS NOT DISTINCT FROM t.source WHERE words > start GROUP BY r)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, first_slot::BIGINT AS first_slot, last_slot::BIGINT AS last_slot
FROM laid LEFT JOIN got ON laid.r = got.r"""


@query(_SQL)
def op3_mixing(spark, sf_dir):
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), slots_too=True).drop("key")
