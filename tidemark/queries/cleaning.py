"""Cleaning, stamping and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import fixed_text
from tidemark.operators import clean, conform, stamp, validate
from tidemark.queries.fixtures import (
    BATCH, CLEAN_ORDERS_SQL, DIRTY_ORDERS_SQL, DIRTY_PRICES_SQL, ORDERS_AS_OF, ORDERS_MARK, SYSTEM, dirty_orders,
    dirty_prices, plain, table,
)
from tidemark.queries.registry import query

ORDER_RULES = validate.Rules(pk="o_orderkey", date="o_orderdate")
FINITE = "CASE WHEN isfinite(l_extendedprice) THEN l_extendedprice END"


@query(f"SELECT * REPLACE ({FINITE} AS l_extendedprice) FROM ({DIRTY_PRICES_SQL})")
def clean_nonfinite(spark, sf):
    return clean.null_nonfinite(dirty_prices(spark, sf))


@query(" UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count(v) AS non_null, coalesce(bool_and(v = floor(v)), false) AS integral
FROM (SELECT CASE WHEN isfinite({c}) THEN {c} END AS v FROM ({DIRTY_PRICES_SQL}))"""
                          for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")))
def infer_integral(spark, sf):
    return clean.integral_report(dirty_prices(spark, sf))


@query(f"""SELECT * REPLACE (CAST(l_quantity AS BIGINT) AS l_quantity, {FINITE} AS l_extendedprice)
       FROM ({DIRTY_PRICES_SQL})""")
def narrow_integral(spark, sf):
    return clean.narrow_integral(clean.null_nonfinite(dirty_prices(spark, sf)))


@query("""SELECT l_orderkey, l_linenumber, round_even(l_discount / 3, 10) AS third,
       round_even(l_tax * l_discount / 7, 10) AS seventh FROM lineitem""")
def clean_round(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_discount") / 3).alias("third"),
        (F.col("l_tax") * F.col("l_discount") / 7).alias("seventh"))
    return clean.round_floats(lines)


@query(f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderpriority NOT IN ('nan', 'None', 'NULL', 'null') THEN o_orderpriority END AS o_orderpriority
FROM ({DIRTY_ORDERS_SQL})""")
def clean_null_tokens(spark, sf):
    return clean.null_tokens(dirty_orders(spark, sf))


@query("""SELECT p_partkey, printf('%.10f', p_retailprice) AS price_text,
       CASE WHEN p_size > 25 THEN printf('%.10f', p_retailprice) END AS some_text FROM part""")
def format_fixed(spark, sf):
    price = F.col("p_retailprice")
    return table(spark, sf, "part").select(
        "p_partkey", fixed_text(price).alias("price_text"), fixed_text(F.when(F.col("p_size") > 25, price)).alias("some_text"))


@query(f"""SELECT *, TIMESTAMP '2024-01-20 12:34:56' AS _loaded_at, '{BATCH}' AS _batch_id,
       CAST({SYSTEM} AS INTEGER) AS _source_system_id FROM customer""")
def stamp_metadata(spark, sf):
    return stamp.stamp(table(spark, sf, "customer"), BATCH, "2024-01-20 12:34:56.789", SYSTEM)


@query(f"""SELECT *, CAST(NULL AS TIMESTAMP) AS _loaded_at, CAST(NULL AS VARCHAR) AS _batch_id,
       CAST(NULL AS INTEGER) AS _source_system_id FROM part
UNION ALL SELECT *, TIMESTAMP '{ORDERS_AS_OF}', '{BATCH}', {SYSTEM} FROM part""")
def evolve_schema(spark, sf):
    """Rows loaded before there were stamp columns, then the same rows with them."""
    parts = table(spark, sf, "part")
    return stamp.append_evolved(stamp.ensure_stamp(parts), stamp.stamp(parts, BATCH, ORDERS_AS_OF, SYSTEM))


@query(f"""SELECT *, CASE WHEN o_orderkey IS NULL THEN 'null_pk' END AS _reject_reason
FROM ({DIRTY_ORDERS_SQL})""")
def reject_null_pk(spark, sf):
    rules = validate.Rules(pk="o_orderkey", max_text=None)
    return validate.mark(dirty_orders(spark, sf), rules, ORDERS_AS_OF)


@query(f"""SELECT * REPLACE (try_cast(o_orderdate AS TIMESTAMP) AS o_orderdate) FROM ({DIRTY_ORDERS_SQL})""")
def coerce_dates(spark, sf):
    return validate.coerce_date(dirty_orders(spark, sf), "o_orderdate")


@query(f"""SELECT * REPLACE (try_cast(o_orderdate AS TIMESTAMP) AS o_orderdate),
       CASE WHEN try_cast(o_orderdate AS TIMESTAMP) > TIMESTAMP '{ORDERS_AS_OF}' THEN 'future_date' END AS _reject_reason
FROM ({DIRTY_ORDERS_SQL})""")
def reject_future(spark, sf):
    rules = validate.Rules(date="o_orderdate")
    return validate.mark(dirty_orders(spark, sf), rules, ORDERS_AS_OF)


@query("SELECT doc_id, substring(text, 1, 4000) AS text, lang, source, n_chars FROM documents")
def truncate_strings(spark, sf):
    return clean.clip_texts(table(spark, sf, "documents"))


def marked_orders(spark, sf):
    return validate.mark(clean.clean_table(dirty_orders(spark, sf)), ORDER_RULES, ORDERS_AS_OF)


@query(f"SELECT * FROM ({CLEAN_ORDERS_SQL}) WHERE _reject_reason IS NOT NULL")
def load_ready_rejects(spark, sf):
    return validate.rejected(marked_orders(spark, sf))


@query(f"SELECT * EXCLUDE (_reject_reason) FROM ({CLEAN_ORDERS_SQL}) WHERE _reject_reason IS NULL")
def load_ready_rows(spark, sf):
    return validate.accepted(marked_orders(spark, sf))


@query(f"""SELECT count(*) AS rows_read, count(*) FILTER (_reject_reason IS NULL) AS rows_accepted,
       count(*) FILTER (_reject_reason IS NOT NULL) AS rows_rejected, count(*) FILTER (_reject_reason = 'null_pk') AS rejected_null_pk,
       count(*) FILTER (_reject_reason = 'future_date') AS rejected_future_date
FROM ({CLEAN_ORDERS_SQL}) WHERE o_orderdate >= TIMESTAMP '{ORDERS_MARK}'""")
def load_ready_counts(spark, sf):
    """The delta since the watermark: read, accepted, rejected by reason."""
    return validate.reason_counts(marked_orders(spark, sf).filter(
        F.col("o_orderdate") >= F.lit(ORDERS_MARK).cast("timestamp_ntz")))


@query("""SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
       ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
                l_tax DESC, l_returnflag DESC, l_linestatus DESC) = 1""")
def dedupe_latest(spark, sf):
    return validate.latest_by_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], [F.desc("l_shipdate")])


LINE_SCHEMA = ("l_orderkey bigint, l_partkey smallint, l_suppkey int, l_linenumber smallint, l_quantity decimal(5,2), "
               "l_extendedprice decimal(6,2), l_discount decimal(6,5), l_returnflag varchar(1), l_linestatus varchar(20), "
               "l_comment varchar(30), l_shipdate timestamp_ntz")
_FITS = (("l_orderkey", "BIGINT"), ("l_partkey", "SMALLINT"), ("l_suppkey", "INTEGER"), ("l_linenumber", "SMALLINT"),
         ("l_quantity", "DECIMAL(5,2)"), ("l_extendedprice", "DECIMAL(6,2)"), ("l_discount", "DECIMAL(6,5)"),
         ("l_returnflag", "VARCHAR"), ("l_linestatus", "VARCHAR"), ("l_shipdate", "TIMESTAMP"))


@query(" UNION ALL ".join(
    [f"""SELECT '{c}' AS column_name, 'ok' AS status, count({c}) AS non_null,
         count(*) FILTER ({c} IS NOT NULL AND try_cast({c} AS {t}) IS NULL) AS lost FROM lineitem""" for c, t in _FITS]
    + ["SELECT 'l_comment', 'missing', NULL, NULL", "SELECT 'l_tax', 'extra', NULL, NULL"]))
def conform_schema(spark, sf):
    return conform.conform_report(table(spark, sf, "lineitem"), LINE_SCHEMA)


def _shown(column: str, kind: str) -> str:
    cast = f"try_cast({column} AS {kind})"
    return f"CAST({cast} AS VARCHAR)" if kind.startswith("DECIMAL") else cast


@query("SELECT " + ", ".join(f"{_shown(c, t)} AS {c}" for c, t in _FITS) + ", CAST(NULL AS VARCHAR) AS l_comment FROM lineitem")
def conform_rows(spark, sf):
    return plain(conform.conform(table(spark, sf, "lineitem"), LINE_SCHEMA))
