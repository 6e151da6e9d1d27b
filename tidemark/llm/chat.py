"""Tool calls in chats: linked to their results, ordered, validated, and written as canonical JSON.

Rows alike are one row with a count. The different calls of an identifier are numbered, its different results too, and
calls and results are joined by identifier and number: no content is lost, and nothing multiplies. A call may name the call whose result it uses; its level is the
number of calls before it on that way, found by doubling: each round looks twice as far back, so the rounds grow with
the logarithm of the longest way. Calls on a circle never reach a start and have no level. Order by (level, id).

Arguments are parsed as variants: types are read from the value, keys come out sorted, text is escaped one way.
Everything is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import discard, running_before, stored, table
from tidemark.llm.registry import query

#: tool: {argument: (JSON type, required)}
Schemas = Mapping[str, Mapping[str, tuple[str, bool]]]
TYPES = {"string": ("STRING",), "integer": ("BIGINT",), "boolean": ("BOOLEAN",), "null": ("VOID",)}
#: Tools of the query: a question may have no text, and has a place in its conversation.
ASK: Schemas = {"ask": {"text": ("string", True), "turn": ("integer", True), "note": ("string", False)}}


def _errors(schemas: Schemas) -> Column:
    """Sorted faults of `_args` under the schema of `name`: what is missing, mistyped or unknown; a tool that is unknown."""
    def of(schema: Mapping[str, tuple[str, bool]]) -> Column:
        faults = []
        for arg, (kind, required) in schema.items():
            held = F.try_variant_get("_args", f"$.{arg}", "variant")
            wrong = ~F.schema_of_variant(held).isin(*TYPES[kind])
            faults.append(F.when(held.isNull(), F.lit(f"missing {arg}") if required else F.lit(None))
                          .when(wrong, f"{arg} is not {kind}"))
        unknown = F.transform(F.array_except("_keys", F.array(*[F.lit(a) for a in schema]).cast("array<string>")),
                              lambda k: F.concat(F.lit("unknown "), k))
        return F.array_sort(F.concat(F.array_compact(F.array(*faults).cast("array<string>")), unknown))

    known = F.array(F.lit("unknown tool"))
    for tool, schema in schemas.items():
        known = F.when(F.col("name") == tool, of(schema)).otherwise(known)
    return F.when(F.col("_keys").isNull(), F.array(F.lit("arguments are no object"))).otherwise(known)


def levels(calls: DataFrame) -> DataFrame:
    """call_id, level: calls before this one, following `after`; null on a circle or behind one.

    calls: call_id (distinct) and after. A call that names itself, nothing or no known call starts a way.
    """
    named = calls.select(F.col("call_id").alias("_up"))
    up = calls.join(named, calls["after"] == named["_up"], "left").select(
        "call_id", F.when(F.col("_up") != F.col("call_id"), F.col("_up")).alias("up"))
    up = stored(up.withColumn("steps", F.when(F.col("up").isNull(), 0).otherwise(1).cast("long")), "levels")
    rounds = max(1, up.where("up IS NOT NULL").count()).bit_length()
    for _ in range(rounds):
        if up.where("up IS NOT NULL").isEmpty():
            break
        far = up.select(F.col("call_id").alias("_at"), F.col("up").alias("_far"), F.col("steps").alias("_more"))
        up = stored(up.join(far, up["up"] == far["_at"], "left").select(
            "call_id", F.col("_far").alias("up"), (F.col("steps") + F.coalesce("_more", F.lit(0))).alias("steps")), "levels")
    return up.select("call_id", F.when(F.col("up").isNull(), F.col("steps")).alias("level"))


def _numbered(rows: DataFrame, content: list[str], n: str) -> DataFrame:
    """rows made distinct: n (how many were alike), and ordinal: the place among the rows of one call_id, from 1, by
    hash of the content; null without call_id. Identifiers with many rows are numbered in buckets."""
    key = F.md5(F.concat_ws("|", *[F.coalesce(F.concat(F.lit("1"), F.col(c).cast("string")), F.lit("0")) for c in content]))
    each = stored(rows.groupBy("call_id", *content).agg(F.count("*").alias(n)).withColumns(
        {"_key": key, "_bucket": F.substring(key, 1, 3), "_one": F.lit(1)}), "each")
    named = running_before(each.where("call_id IS NOT NULL"), ["call_id"], "_bucket", ["_key"], "_one", "ordinal")
    named = named.withColumn("ordinal", (F.col("ordinal") + 1).cast("long"))
    none = each.where("call_id IS NULL").withColumn("ordinal", F.lit(None).cast("long"))
    out = stored(named.unionByName(none).drop("_key", "_bucket", "_one"), "numbered")
    discard(each)
    return out


def link_calls(calls: DataFrame, results: DataFrame, schemas: Schemas) -> DataFrame:
    """call_id, ordinal, name, level, status, errors, n_calls, n_results, json: a row per different call, with its
    result, and per result without a call.

    calls: call_id, name, arguments (JSON text), after. results: call_id, content. Rows alike in these columns are one;
    n_calls and n_results tell how many there were. The k-th different call of an identifier goes with its k-th different
    result, k being ordinal (by hash of the content). status is linked, no_result or no_call (of that number). level is
    the identifier's, by the least `after` of its calls. errors is empty for valid arguments. Rows without identifier
    belong to nothing; they are returned under null, without ordinal. Arguments that are null, no JSON or no object
    are an error, not a failure. Empty tables are allowed. Other columns are ignored.
    """
    own = _numbered(calls, ["name", "arguments", "after"], "n_calls")
    got = _numbered(results, ["content"], "n_results")
    got = got.withColumnsRenamed({"call_id": "_result_id", "ordinal": "_k"})
    level = levels(own.where("call_id IS NOT NULL").groupBy("call_id").agg(F.min("after").alias("after"))).withColumnRenamed("call_id", "_level_id")
    named = own.where("call_id IS NOT NULL").join(level, F.col("call_id") == F.col("_level_id"), "left")
    met = (F.col("call_id") == F.col("_result_id")) & (F.col("ordinal") == F.col("_k"))
    both = named.join(got.where("_result_id IS NOT NULL"), met, "full")
    # rows without identifier stay out of the join, where all of them would meet in one task
    both = (both.unionByName(own.where("call_id IS NULL"), allowMissingColumns=True)
            .unionByName(got.where("_result_id IS NULL"), allowMissingColumns=True))
    both = both.withColumn("_args", F.try_parse_json("arguments"))
    both = both.withColumn("_keys", F.when(F.schema_of_variant("_args").startswith("OBJECT"), F.json_object_keys("arguments")))
    is_call = F.col("n_calls").isNotNull()
    status = F.when(~is_call, "no_call").when(F.col("n_results").isNull(), "no_result").otherwise("linked")
    both = both.withColumns({"_id": F.coalesce("call_id", "_result_id"), "status": status,
                             "errors": F.when(is_call, F.array_join(_errors(schemas), "; ")).otherwise("")})
    text = F.to_json(F.struct(
        F.when(is_call, F.coalesce("_args", F.to_variant_object(F.create_map().cast("map<string,string>")))).alias("arguments"),
        F.col("_id").alias("id"), F.col("level"), F.col("name"), F.col("content").alias("result"), F.col("status"),
        (F.col("errors") == "").alias("valid")))
    return both.select(F.col("_id").alias("call_id"), F.coalesce("ordinal", "_k").alias("ordinal"), "name", "level", "status", "errors",
                       F.coalesce("n_calls", F.lit(0)).cast("long").alias("n_calls"),
                       F.coalesce("n_results", F.lit(0)).cast("long").alias("n_results"), text.alias("json"))


def calls_of(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A conversation as calls and results: a user's turn asks, using the result of the question two turns before; any
    other turn answers the question right before it. Identifiers are conversation:turn; a null one gives null."""
    at = lambda back: F.concat(F.col("conv_id").cast("string"), F.lit(":"), (F.col("turn") - back).cast("string"))
    asks = F.coalesce(F.col("role") == "user", F.lit(False))
    arguments = F.to_json(F.struct(F.col("turn"), F.col("text")))
    calls = conversations.where(asks).select(at(0).alias("call_id"), F.lit("ask").alias("name"), arguments.alias("arguments"),
                                             at(2).alias("after"))
    return calls, conversations.where(~asks).select(at(1).alias("call_id"), F.col("text").alias("content"))


_SQL = """
WITH RECURSIVE each AS (SELECT conv_id || ':' || turn AS id, conv_id || ':' || (turn - 2) AS after, turn, text, count(*) AS n,
    '{' || concat_ws(',', '"turn":' || turn, '"text":' || to_json(text)) || '}' AS args
    FROM conversations WHERE coalesce(role = 'user', false) GROUP BY 1, 2, 3, 4),
same AS (SELECT id, after, args, any_value(turn) AS turn, any_value(text) AS text, sum(n) AS n FROM each GROUP BY 1, 2, 3),
calls AS (SELECT *, CASE WHEN id IS NOT NULL THEN row_number() OVER (PARTITION BY id
    ORDER BY md5('1ask|1' || args || '|' || coalesce('1' || after, '0'))) END AS k FROM same),
said AS (SELECT conv_id || ':' || (turn - 1) AS id, text AS content, count(*) AS n FROM conversations
    WHERE NOT coalesce(role = 'user', false) GROUP BY 1, 2),
answers AS (SELECT *, CASE WHEN id IS NOT NULL THEN row_number() OVER (PARTITION BY id ORDER BY md5(coalesce('1' || content, '0'))) END AS k FROM said),
asks AS (SELECT id, min(after) AS after FROM same GROUP BY 1),
lv AS (SELECT id, 0::BIGINT AS level FROM asks WHERE after IS NULL OR after NOT IN (SELECT id FROM asks WHERE id IS NOT NULL)
    UNION ALL SELECT asks.id, lv.level + 1 FROM asks JOIN lv ON asks.after = lv.id),
j AS (SELECT coalesce(a.id, r.id) AS id, coalesce(a.k, r.k) AS ordinal, a.n IS NOT NULL AS call, lv.level, a.turn, a.text, r.content,
    CASE WHEN a.n IS NULL THEN 'no_call' WHEN r.n IS NULL THEN 'no_result' ELSE 'linked' END AS status,
    CASE WHEN a.n IS NULL THEN '' ELSE concat_ws('; ', CASE WHEN text IS NULL THEN 'missing text' END,
        CASE WHEN turn IS NULL THEN 'missing turn' END) END AS errors,
    coalesce(a.n, 0)::BIGINT AS n_calls, coalesce(r.n, 0)::BIGINT AS n_results
    FROM calls a LEFT JOIN lv ON a.id = lv.id FULL JOIN answers r ON a.id = r.id AND a.k = r.k)
SELECT id AS call_id, ordinal, CASE WHEN call THEN 'ask' END AS name, level, status, errors, n_calls, n_results,
    '{' || concat_ws(',', CASE WHEN call THEN '"arguments":{' || concat_ws(',',
        CASE WHEN text IS NOT NULL THEN '"text":' || to_json(text) END, '"turn":' || turn) || '}' END,
    '"id":' || to_json(id), '"level":' || level, CASE WHEN call THEN '"name":"ask"' END,
    CASE WHEN content IS NOT NULL THEN '"result":' || to_json(content) END, '"status":"' || status || '"',
    '"valid":' || (errors = '')) || '}' AS json FROM j"""


@query(_SQL)
def op7_chat_formatting(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations")
    return link_calls(*calls_of(talk.select("conv_id", "turn", "role", "text")), ASK)
