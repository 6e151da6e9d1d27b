"""Source against target."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality, reconcile
from tidemark.plans.audit import quality_rows
from tidemark.queries.fixtures import (
    CHANGED_ORDERS_SQL, DIRTY_ORDERS_SQL, ORDERS_AS_OF, changed_orders, dirty_orders, lossy, plain, table,
)
from tidemark.queries.registry import query

NEAR, FAR = 211, 31   # a loss inside and one outside the 1 % tolerance
NOT_NULL = ["o_orderkey", "o_custkey", "o_orderpriority", "o_comment"]
MONEY = ["l_quantity", "l_extendedprice", "l_discount"]
BIG = 20_000_000_000_000   # a value beyond 19 digits with 6 decimals


def _both_targets(spark, sf):
    orders = table(spark, sf, "orders")
    parts = []
    for name, every in (("near", NEAR), ("far", FAR)):
        parts.append(quality.side_metrics(orders, name, "source"))
        parts.append(quality.side_metrics(lossy(orders, "o_orderkey", every), name, "target"))
    a, b, c, d = parts
    return quality.pair_sides(a.unionByName(c), b.unionByName(d))


_COUNTS_SQL = " UNION ALL ".join(f"""
SELECT '{name}' AS table_name, (SELECT count(*) FROM orders) AS s,
       (SELECT count(*) FROM orders WHERE o_orderkey % {every} <> 0) AS t""" for name, every in (("near", NEAR), ("far", FAR)))


@query(f"""SELECT table_name, s AS source_count, t AS target_count, s - t AS difference,
       CAST(abs(s - t) AS DOUBLE) / CAST(s AS DOUBLE) * 100 AS difference_percent,
       CAST(abs(s - t) AS DOUBLE) / CAST(s AS DOUBLE) <= 0.01 AS is_valid FROM ({_COUNTS_SQL})""")
def dq_row_count(spark, sf):
    return quality.row_count_check(_both_targets(spark, sf))


@query(f"""SELECT table_name, s AS source_count, t AS target_count, t - s AS difference,
       CAST(t AS DOUBLE) / CAST(s AS DOUBLE) * 100 AS target_percent, t >= s AS is_valid FROM ({_COUNTS_SQL})""")
def dq_row_count_min(spark, sf):
    return quality.row_count_at_least(_both_targets(spark, sf))


_DUPES_SQL = "SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY ALL HAVING count(*) > 1"


@query(f"""SELECT 'lineitem' AS table_name, count(*) AS duplicate_keys, CAST(coalesce(sum(occurrences), 0) AS BIGINT) AS rows_involved,
       count(*) = 0 AS is_valid FROM ({_DUPES_SQL})""")
def dq_duplicates(spark, sf):
    return quality.duplicate_check(table(spark, sf, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"])


@query(f"""SELECT 'lineitem' AS table_name, count(*) AS duplicate_keys, CAST(coalesce(sum(occurrences), 0) AS BIGINT) AS rows_involved,
       count(*) = 0 AS is_valid FROM ({_DUPES_SQL})
UNION ALL SELECT 'orders', (SELECT count(*) FROM orders WHERE o_orderkey % {FAR} = 0) + 1,
       (SELECT CAST(sum(CASE WHEN o_orderkey % {FAR} = 0 THEN 2 ELSE 0 END) + sum(CASE WHEN o_orderkey % {NEAR} = 0 THEN 1 ELSE 0 END) AS BIGINT) FROM orders), false""")
def dq_duplicates_two_pass(spark, sf):
    """Lineitem's keys, and orders with some keys twice and some missing: counter words first, then only what is in full ones."""
    orders = table(spark, sf, "orders").select("o_orderkey")
    twice = orders.unionByName(orders.filter(F.col("o_orderkey") % FAR == 0))
    keyless = F.when(F.col("o_orderkey") % NEAR != 0, F.col("o_orderkey")).alias("o_orderkey")
    more = twice.unionByName(orders.filter(F.col("o_orderkey") % NEAR == 0).select(keyless))
    lines = quality.duplicate_check(table(spark, sf, "lineitem"), "lineitem", ["l_orderkey", "l_linenumber"], two_pass=True)
    return lines.unionByName(quality.duplicate_check(more, "orders", ["o_orderkey"], two_pass=True))


@query(f"{_DUPES_SQL} ORDER BY occurrences DESC, l_orderkey, l_linenumber LIMIT 5")
def dq_duplicates_top(spark, sf):
    return quality.top_duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], 5)


@query(" UNION ALL ".join(
    [f"""SELECT 'orders' AS table_name, '{c}' AS column_name, 'checked' AS status, count(*) FILTER ({c} IS NULL) AS null_count,
         count(*) FILTER ({c} IS NULL) = 0 AS is_valid FROM ({DIRTY_ORDERS_SQL})""" for c in NOT_NULL[:3]]
    + ["SELECT 'orders', 'o_comment', 'absent', NULL, true"]))
def dq_nulls(spark, sf):
    return quality.null_check(quality.side_metrics(dirty_orders(spark, sf), "orders", "target", not_null=NOT_NULL), NOT_NULL)


@query(f"""SELECT 'orders' AS table_name, s0 AS src_min_id, t0 AS tgt_min_id, s1 AS src_max_id, t1 AS tgt_max_id, s0 = t0 AS is_valid
FROM (SELECT min(o_orderkey) AS s0, max(o_orderkey) AS s1 FROM orders),
     (SELECT min(o_orderkey) AS t0, max(o_orderkey) AS t1 FROM ({CHANGED_ORDERS_SQL}))""")
def dq_id_range(spark, sf):
    return quality.id_range_check(quality.pair_sides(
        quality.side_metrics(table(spark, sf, "orders"), "orders", "source", "o_orderkey"),
        quality.side_metrics(changed_orders(spark, sf), "orders", "target", "o_orderkey")))


@query(" UNION ALL ".join(f"""
SELECT 'lineitem' AS table_name, '{c}' AS column_name, 'checked' AS status, CAST(s AS VARCHAR) AS source_sum, CAST(t AS VARCHAR) AS target_sum,
       round(CAST(s AS DOUBLE) / sn, 4) AS source_avg, round(CAST(t AS DOUBLE) / tn, 4) AS target_avg,
       round(abs(CAST(t AS DOUBLE) - CAST(s AS DOUBLE)) / abs(CAST(s AS DOUBLE)) * 100, 6) AS difference_percent,
       su AS source_unfit, tu AS target_unfit,
       abs(CAST(t AS DOUBLE) - CAST(s AS DOUBLE)) / abs(CAST(s AS DOUBLE)) * 100 < 1 AND su = 0 AND tu = 0 AS is_valid
FROM (SELECT CAST(sum(v) AS DECIMAL(38,6)) AS s, count(v) AS sn, CAST(sum(v) FILTER (kept) AS DECIMAL(38,6)) AS t, count(v) FILTER (kept) AS tn,
             count(*) FILTER (bad) AS su, count(*) FILTER (bad AND kept) AS tu
      FROM (SELECT l_orderkey % {FAR} <> 0 AS kept, {bad} AS bad, CASE WHEN NOT {bad} THEN CAST({value} AS DECIMAL(38,6)) END AS v FROM lineitem))"""
    for c, value, bad in (*[(c, f"CAST({c} AS DECIMAL(19,6))", "false") for c in MONEY],
                          ("l_big", f"l_orderkey * {BIG}", "false"), ("l_nan", "CAST(l_quantity AS DECIMAL(19,6))", "l_linenumber = 1")))
    + " UNION ALL SELECT 'lineitem', 'l_rebate', 'absent', NULL, NULL, NULL, NULL, NULL, NULL, NULL, true")
def dq_aggregates(spark, sf):
    """Sums of three columns that differ, of very large values, of one with NaN, and of one that does not exist."""
    lines, money = table(spark, sf, "lineitem"), [*MONEY, "l_big", "l_nan", "l_rebate"]
    # a decimal, as the product of a large key is beyond a BIGINT
    lines = lines.withColumn("l_big", F.col("l_orderkey").cast("decimal(19,0)") * F.lit(BIG).cast("decimal(15,0)")).withColumn(
        "l_nan", F.when(F.col("l_linenumber") == 1, float("nan")).otherwise(F.col("l_quantity").cast("double")))
    return plain(quality.aggregate_check(quality.pair_sides(
        quality.side_metrics(lines, "lineitem", "source", numeric=money),
        quality.side_metrics(lossy(lines, "l_orderkey", FAR), "lineitem", "target", numeric=money)), money))


def _order_checks(spark, sf):
    return quality.all_checks(table(spark, sf, "orders"), changed_orders(spark, sf), "orders", "o_orderkey",
                              ["o_orderkey", "o_custkey", "o_comment"], ["o_totalprice", "o_rebate"])


_ORDER_CHECKS_SQL = f"""
WITH t AS ({CHANGED_ORDERS_SQL}),
m AS (SELECT (SELECT count(*) FROM orders) AS sc, (SELECT count(*) FROM t) AS tc,
             (SELECT min(o_orderkey) FROM orders) AS s0, (SELECT min(o_orderkey) FROM t) AS t0,
             (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(19,6))) AS DECIMAL(38,6)) FROM orders) AS ss,
             (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(19,6))) AS DECIMAL(38,6)) FROM t) AS ts,
             (SELECT count(*) FROM (SELECT 1 FROM t GROUP BY o_orderkey HAVING count(*) > 1)) AS dups),
c AS (
SELECT 'orders' AS table_name, 'ROW_COUNT' AS check_type, CAST(sc AS VARCHAR) AS source_value, CAST(tc AS VARCHAR) AS target_value,
       sc - tc AS difference, CAST(abs(sc - tc) AS DOUBLE) / CAST(sc AS DOUBLE) * 100 AS difference_percent,
       CAST(abs(sc - tc) AS DOUBLE) / CAST(sc AS DOUBLE) <= 0.01 AS is_valid FROM m
UNION ALL SELECT 'orders', 'ROW_COUNT_MIN', CAST(sc AS VARCHAR), CAST(tc AS VARCHAR), tc - sc, NULL, tc >= sc FROM m
UNION ALL SELECT 'orders', 'DUPLICATE_KEY', NULL, CAST(dups AS VARCHAR), dups, NULL, dups = 0 FROM m
UNION ALL SELECT 'orders', 'ID_RANGE', CAST(s0 AS VARCHAR), CAST(t0 AS VARCHAR), s0 - t0, NULL, s0 = t0 FROM m
UNION ALL SELECT 'orders', 'NULL_CHECK', 'o_orderkey', CAST(count(*) FILTER (o_orderkey IS NULL) AS VARCHAR), count(*) FILTER (o_orderkey IS NULL), NULL, count(*) FILTER (o_orderkey IS NULL) = 0 FROM t
UNION ALL SELECT 'orders', 'NULL_CHECK', 'o_custkey', CAST(count(*) FILTER (o_custkey IS NULL) AS VARCHAR), count(*) FILTER (o_custkey IS NULL), NULL, count(*) FILTER (o_custkey IS NULL) = 0 FROM t
UNION ALL SELECT 'orders', 'SUM_CHECK', CAST(ss AS VARCHAR), CAST(ts AS VARCHAR), NULL,
       round(abs(CAST(ts AS DOUBLE) - CAST(ss AS DOUBLE)) / abs(CAST(ss AS DOUBLE)) * 100, 6),
       abs(CAST(ts AS DOUBLE) - CAST(ss AS DOUBLE)) / abs(CAST(ss AS DOUBLE)) * 100 < 1 FROM m
UNION ALL SELECT 'orders', 'NULL_CHECK', 'o_comment', 'absent', NULL, NULL, false
UNION ALL SELECT 'orders', 'SUM_CHECK', 'absent', 'absent', NULL, NULL, false)"""


@query(_ORDER_CHECKS_SQL + f" SELECT *, 'run_1' AS run_id, TIMESTAMP '{ORDERS_AS_OF}' AS checked_at FROM c")
def dq_results(spark, sf):
    return quality_rows(_order_checks(spark, sf), "run_1", ORDERS_AS_OF)


@query(_ORDER_CHECKS_SQL + f""", l AS (
SELECT 'lineitem' AS table_name, 'ROW_COUNT_MIN' AS check_type, true AS is_valid
UNION ALL SELECT 'lineitem', 'DUPLICATE_KEY', NOT EXISTS ({_DUPES_SQL})
UNION ALL SELECT 'lineitem', 'NULL_CHECK', NOT EXISTS (FROM lineitem WHERE l_orderkey IS NULL)
UNION ALL SELECT 'lineitem', 'ID_RANGE', true),
e AS (SELECT table_name, check_type, bool_and(is_valid) AS is_valid FROM c WHERE check_type NOT IN ('ROW_COUNT', 'SUM_CHECK') GROUP BY ALL
      UNION ALL SELECT * FROM l)
SELECT table_name, count(*) FILTER (is_valid) AS checks_passed, count(*) AS checks_total,
       CASE WHEN bool_and(is_valid) THEN 'PASS' ELSE 'FAIL' END AS status FROM e GROUP BY table_name""")
def dq_scorecard(spark, sf):
    """Orders against its changed target, lineitem against itself."""
    lines = table(spark, sf, "lineitem")
    own = quality.all_checks(lines, lines, "lineitem", "l_orderkey", ["l_orderkey"], keys=["l_orderkey", "l_linenumber"])
    return quality.scorecard(_order_checks(spark, sf).unionByName(own))


_DIFF_SQL = f"""
WITH t AS ({CHANGED_ORDERS_SQL}),
j AS (SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
             CAST(s.o_orderkey IS NOT NULL AS BIGINT) AS source_rows, CAST(t.o_orderkey IS NOT NULL AS BIGINT) AS target_rows,
             CASE WHEN t.o_orderkey IS NULL THEN 'missing' WHEN s.o_orderkey IS NULL THEN 'extra'
                  WHEN (s.o_custkey, s.o_orderstatus, s.o_totalprice, s.o_orderdate, s.o_orderpriority) IS DISTINCT FROM
                       (t.o_custkey, t.o_orderstatus, t.o_totalprice, t.o_orderdate, t.o_orderpriority) THEN 'changed'
                  ELSE 'same' END AS status
      FROM orders s FULL JOIN t ON s.o_orderkey = t.o_orderkey)"""


@query(_DIFF_SQL + " SELECT * FROM j WHERE status <> 'same'")
def reconcile_rows(spark, sf):
    return reconcile.differences(table(spark, sf, "orders"), changed_orders(spark, sf), ["o_orderkey"])


@query(_DIFF_SQL + " SELECT * FROM j WHERE status <> 'same'")
def reconcile_tree(spark, sf):
    """Only nodes of the key tree whose sums differ are compared row by row."""
    return reconcile.tree_differences(table(spark, sf, "orders"), changed_orders(spark, sf), ["o_orderkey"], leaf_rows=100)


@query(f"""SELECT l_orderkey, l_linenumber, count(*) AS source_rows, count(*) FILTER (l_partkey % 500 <> 0) AS target_rows,
       CASE WHEN count(*) FILTER (l_partkey % 500 <> 0) = 0 THEN 'missing' ELSE 'changed' END AS status
FROM lineitem GROUP BY ALL HAVING count(*) FILTER (l_partkey % 500 = 0) > 0""")
def reconcile_tree_hashed(spark, sf):
    """Keys of two columns hang in the tree by their hash; the target lost the lines of some parts."""
    lines = table(spark, sf, "lineitem")
    return reconcile.tree_differences(lines, lossy(lines, "l_partkey", 500), ["l_orderkey", "l_linenumber"], leaf_rows=100)


@query(_DIFF_SQL + """ SELECT status, count(*) AS keys, CAST(sum(source_rows) AS BIGINT) AS source_rows,
       CAST(sum(target_rows) AS BIGINT) AS target_rows FROM j GROUP BY status""")
def reconcile_summary(spark, sf):
    return reconcile.summary(table(spark, sf, "orders"), changed_orders(spark, sf), ["o_orderkey"])


@query(f"""
WITH t AS (SELECT * FROM lineitem WHERE NOT (l_orderkey % {FAR} = 0 AND l_linenumber = 1)),
s AS (SELECT l_orderkey, l_linenumber, list_sort(list(row(l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
             l_returnflag, l_linestatus, l_shipdate))) AS v, count(*) AS n FROM lineitem GROUP BY ALL),
u AS (SELECT l_orderkey, l_linenumber, list_sort(list(row(l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
             l_returnflag, l_linestatus, l_shipdate))) AS v, count(*) AS n FROM t GROUP BY ALL)
SELECT l_orderkey, l_linenumber, coalesce(s.n, 0) AS source_rows, coalesce(u.n, 0) AS target_rows,
       CASE WHEN u.n IS NULL THEN 'missing' WHEN s.n IS NULL THEN 'extra' ELSE 'changed' END AS status
FROM s FULL JOIN u USING (l_orderkey, l_linenumber) WHERE s.v IS DISTINCT FROM u.v""")
def reconcile_repeated_keys(spark, sf):
    """Keys that occur several times are compared as multisets of rows."""
    lines = table(spark, sf, "lineitem")
    target = lines.filter(~((F.col("l_orderkey") % FAR == 0) & (F.col("l_linenumber") == 1)))
    return reconcile.differences(lines, target, ["l_orderkey", "l_linenumber"])


@query(f"""SELECT o_orderkey, CAST(1 AS BIGINT) AS source_rows, CAST(1 AS BIGINT) AS target_rows, 'changed' AS status FROM orders
WHERE o_orderkey % {FAR} = 0 OR o_orderkey % 29 = 0""")
def reconcile_schema_drift(spark, sf):
    """A target with prices as text, some unreadable, and one more column, filled in some rows."""
    orders = table(spark, sf, "orders")
    price = F.when(F.col("o_orderkey") % FAR == 0, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    target = orders.withColumn("o_totalprice", price).withColumn("o_channel", F.when(F.col("o_orderkey") % 29 == 0, "web"))
    return reconcile.differences(orders, target, ["o_orderkey"])
