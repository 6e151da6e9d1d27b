"""Secret scans with corpus-wide ownership.

Base kinds are found by patterns alone. The method adds `live`: bare tokens that look like credentials (long,
letters and digits, many different characters), overlap no base span, and belong to few owners and repositories. Every
candidate's value is hashed; the hashes are counted by distinct repositories and owners over the whole corpus. A
value that many owners have, or that stands in many repositories, is a copied example; the others are owner-specific.

Positions come from lengths: a text splits at the matches into gaps, and a match starts after the gaps and
matches before it. The texts are scanned once; from there on rows carry lengths and hashes only. Counts are
combined before each shuffle, and the join on a hash that a third of all candidates share is split by the skew join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import DOCUMENT, row_key, stored, table, whole
from tidemark.llm.registry import query

#: kind: (pattern, group of the value, least length of the value); fixed values. The least length of hex and access is
#: in the pattern: a longest run that is too short holds no long one, so nothing else matches instead. live is the method's.
KINDS = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]{16,}", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
    "live": (r"[A-Za-z0-9+/_=-]{20,}", 0, 20),
}
LIVE_CHARS = 10  # different characters of a live-looking token
EXAMPLE_OWNERS = 4  # a value that so many owners have is an example,
EXAMPLE_REPOSITORIES = 100  # and so is one in so many repositories, be they of one owner
MARK = "[SECRET]"


def _looks_live(value: Column) -> Column:
    return (value.rlike("[0-9]") & value.rlike("[A-Za-z]")
            & (F.size(F.array_distinct(F.split(value, ""))) >= LIVE_CHARS))


def candidates(docs: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """doc_id, _id, _hash, owner, repository and found: array of (kind, pos, gap, length, value) per row of docs.

    gap: code points between the match before and this one; value: hash of the secret, null if the match fails.
    """
    text = whole()
    rows = docs.select("doc_id", *row_key(), F.col(owner).cast("string").alias("owner"),
                       F.col(repository).cast("string").alias("repository"), text.alias("text"))
    for kind, (pattern, group, _) in KINDS.items():
        rows = rows.withColumns({f"{kind}_m": F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), f"{kind}_v":
                                 F.regexp_extract_all("text", F.lit(pattern), F.lit(group))})
    rows = rows.withColumns({f"{k}_g": F.when(F.size(f"{k}_m") > 0, F.split("text", p, -1)) for k, (p, _, _) in KINDS.items()})

    def found(no: int, kind: str, least: int) -> Column:
        def one(m: Column, i: Column) -> Column:
            value = F.get(f"{kind}_v", i)
            good = F.length(value) >= least
            good = good & _looks_live(value) if kind == "live" else good
            return F.struct(F.lit(no).alias("kind"), i.alias("pos"), F.length(F.get(f"{kind}_g", i)).alias("gap"),
                            F.length(m).alias("length"), F.when(good, F.sha2(value, 256)).alias("value"))
        return F.transform(f"{kind}_m", one)

    every = F.concat(*[found(no, k, least) for no, (k, (_, _, least)) in enumerate(KINDS.items())])
    return rows.select("doc_id", "_id", "_hash", "owner", "repository", every.alias("found"))


def ownership(found: DataFrame) -> DataFrame:
    """value, repositories, owners: how many distinct ones have each candidate; null counts as one of them."""
    each = (found.select(F.explode(F.expr("array_distinct(transform(found, f -> f.value))")).alias("value"), "owner", "repository")
            .where("value IS NOT NULL").distinct())
    return (each.groupBy("value", "owner").agg(F.count("*").alias("n"))
            .groupBy("value").agg(F.sum("n").alias("repositories"), F.count("*").alias("owners")))


def spans(found: DataFrame, example_owners: int = EXAMPLE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """_id, _hash, kind (its place in KINDS), start, stop, example: every span once, rows alike counted once."""
    live = list(KINDS).index("live")
    rows = (found.select("_id", "_hash", F.explode("found").alias("f")).select("_id", "_hash", "f.*")
            .dropDuplicates(["_id", "_hash", "kind", "pos"]))
    run = W.partitionBy("_id", "_hash", "kind").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    rows = (rows.withColumn("stop", F.sum(F.col("gap") + F.col("length")).over(run).cast("long"))
            .withColumn("start", F.col("stop") - F.col("length")).where("value IS NOT NULL"))
    # a live token overlaps a base span if one that starts no later ends after its start, or one starts inside it
    base_stop, base_start = (F.when(F.col("kind") != live, F.col(c)) for c in ("stop", "start"))
    whole_text = W.partitionBy("_id", "_hash")
    before = F.max(base_stop).over(whole_text.orderBy("start").rangeBetween(W.unboundedPreceding, 0))
    after = F.min(base_start).over(whole_text.orderBy(F.desc("start")).rangeBetween(W.unboundedPreceding, 0))
    free = ~(F.coalesce(F.col("_before") > F.col("start"), F.lit(False)) | F.coalesce(F.col("_after") < F.col("stop"), F.lit(False)))
    rows = rows.withColumn("_before", before).withColumn("_after", after).where((F.col("kind") != live) | free)
    copied = (F.col("owners") >= example_owners) | (F.col("repositories") >= example_repositories)
    examples = ownership(found).where(copied).select("value", F.lit(True).alias("example"))
    return (rows.join(examples, "value", "left").withColumn("example", F.coalesce("example", F.lit(False)))
            .where((F.col("kind") != live) | ~F.col("example")).select("_id", "_hash", "kind", "start", "stop", "example"))


def _digest(items: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(items, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")


def find_secrets(docs: DataFrame, owner: str = "source", repository: str = "doc_id",
                 example_owners: int = EXAMPLE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """Per row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_examples.

    spans: kind:start:end, code points, end exclusive, by start, then kind. Base spans stay even if their value is an
    example (n_examples counts them); live ones are only given if owner-specific.

    A null or empty text has no spans. Null ids, owners or repositories are values like any other. Rows that repeat
    get the same answer each and are all returned; an empty table gives none. Other columns are ignored.
    """
    found = stored(candidates(docs, owner, repository), "candidates")
    live = list(KINDS).index("live")
    order = F.sort_array(F.collect_list(F.struct("start", "kind", "stop", "example")))
    per = (spans(found.where(F.size("found") > 0), example_owners, example_repositories).groupBy("_id", "_hash").agg(order.alias("all"))
           .withColumn("base", F.filter("all", lambda s: s["kind"] != live)))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    per = per.select("_id", "_hash", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                     F.sha2(_digest(F.col("base")), 256).alias("base_sha256"), _digest(F.col("all")).alias("spans"),
                     (F.size("all") - F.size("base")).cast("long").alias("n_live"),
                     F.size(F.filter("base", lambda s: s["example"])).cast("long").alias("n_examples"))
    zero = {"n_assign": 0, "n_access": 0, "n_hex": 0, "n_live": 0, "n_examples": 0}
    some = found.where(F.size("found") > 0).select("doc_id", "_id", "_hash").join(per, ["_id", "_hash"], "left").drop("_id", "_hash")
    some = some.fillna(zero).withColumns({"base_sha256": F.coalesce("base_sha256", F.sha2(F.lit(""), 256)),
                                          "spans": F.coalesce("spans", F.lit(""))})
    none = found.where(F.size("found") == 0).select(
        "doc_id", *[F.lit(0).cast("long").alias(c) for c in zero], F.sha2(F.lit(""), 256).alias("base_sha256"), F.lit("").alias("spans"))
    return some.unionByName(none)


def redact(docs: DataFrame, example_owners: int = EXAMPLE_OWNERS, example_repositories: int = EXAMPLE_REPOSITORIES) -> DataFrame:
    """documents with every owner-specific secret, base or live, replaced by [SECRET] and n_chars counted anew.

    Overlapping spans become one mark. Copied examples stay readable. Texts without such a span are untouched.
    """
    docs = docs.select(*DOCUMENT)
    found = stored(candidates(docs), "candidates").where(F.size("found") > 0)
    hide = spans(found, example_owners, example_repositories).where("NOT example")
    upto = W.partitionBy("_id", "_hash").orderBy("start", "stop").rowsBetween(W.unboundedPreceding, -1)
    hide = hide.withColumn("_new", (F.col("start") > F.coalesce(F.max("stop").over(upto), F.lit(-1))).cast("int"))
    hide = hide.withColumn("_run", F.sum("_new").over(W.partitionBy("_id", "_hash").orderBy("start", "stop").rowsBetween(
        W.unboundedPreceding, 0)))
    runs = hide.groupBy("_id", "_hash", "_run").agg(F.min("start").alias("a"), F.max("stop").alias("b"))
    runs = stored(runs.groupBy("_id", "_hash").agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("_runs")), "hidden")
    before = lambda i: F.coalesce(F.get("_runs", i - 1)["b"], F.lit(0))
    after = lambda i: F.coalesce(F.get("_runs", i)["a"], F.length("text"))
    pieces = F.transform(F.sequence(F.lit(0), F.size("_runs")), lambda i: F.substring(
        F.col("text"), (before(i) + 1).cast("int"), (after(i) - before(i)).cast("int")))
    joined = docs.select("*", *row_key()).join(runs, ["_id", "_hash"], "left")
    clean = F.when(F.col("_runs").isNull(), F.col("text")).otherwise(F.array_join(pieces, MARK))
    return (joined.withColumn("_clean", clean)
            .select("doc_id", F.col("_clean").alias("text"), "lang", "source",
                    F.when(F.col("_runs").isNull(), F.col("n_chars")).otherwise(F.length("_clean")).cast("long").alias("n_chars")))


def _sql() -> str:
    parts = []
    for no, (kind, (pattern, group, least)) in enumerate(KINDS.items()):
        p = pattern.replace("'", "''").replace("(?i)", "")
        text = "translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')" if "(?i)" in pattern else "t"
        good = f"length(v) >= {least}"
        if kind == "live":
            good += (" AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') "
                     f"AND len(list_distinct(string_split(v, ''))) >= {LIVE_CHARS}")
        parts.append(f"""SELECT r, {no} AS no, '{kind}' AS kind, stop - length(m) AS start, stop, substr(t, (stop - length(v) + 1)::BIGINT, length(v)) AS v
    FROM (SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY r ORDER BY i ROWS UNBOUNDED PRECEDING)::BIGINT AS stop FROM (
    SELECT r, t, unnest(range(1, len(ms) + 1)) AS i, unnest(ms) AS m, unnest(vs) AS v, unnest(gs[:len(ms)]) AS g FROM (
    SELECT r, t, regexp_extract_all({text}, '{p}') AS ms, regexp_extract_all({text}, '{p}', {group}) AS vs,
        string_split_regex({text}, '{p}') AS gs FROM d))) WHERE {good}""")
    union = "\n    UNION ALL ".join(parts)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
every AS ({union}),
own AS (SELECT v, count(DISTINCT coalesce(source, chr(0))) AS owners, count(DISTINCT concat(coalesce(source, chr(0)), chr(1), doc_id)) AS repositories FROM every JOIN d ON every.r = d.r GROUP BY v),
s AS (SELECT e.*, o.owners >= {EXAMPLE_OWNERS} OR o.repositories >= {EXAMPLE_REPOSITORIES} AS example FROM every e JOIN own o ON e.v = o.v),
kept AS (SELECT * FROM s WHERE kind <> 'live' OR (NOT example AND NOT EXISTS (
    SELECT 1 FROM s b WHERE b.r = s.r AND b.kind <> 'live' AND b.start < s.stop AND b.stop > s.start))),
per AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (kind = 'live') AS n_live,
    count(*) FILTER (example) AS n_examples,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, no) FILTER (kind <> 'live') AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, no) AS spans FROM kept GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    coalesce(n_live, 0) AS n_live, coalesce(n_examples, 0) AS n_examples,
    sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN per ON d.r = per.r"""


@query(_sql())
def op1_secret_scans(spark, sf_dir):
    return find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
