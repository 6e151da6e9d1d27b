"""Source-versus-target checks.

Each side is read once for all of its plain metrics (counts, NULLs, min, max, sums), which leaves one
row per side. Only those rows are joined. The duplicate check is the one that needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.casts import cast_or_null
from tidemark.functions.columns import is_missing
from tidemark.session import stored

# Fixed values
COUNT_TOLERANCE = 0.01   # a fraction: 1 %
SUM_TOLERANCE_PCT = 1.0
SUM_TYPE = "decimal(38,6)"
ABSENT = "absent"
SCORED = ("ROW_COUNT_MIN", "DUPLICATE_KEY", "NULL_CHECK", "ID_RANGE")


def side_metrics(df: DataFrame, table: str, side: str, pk: str | None = None,
                 not_null: Sequence[str] = (), numeric: Sequence[str] = ()) -> DataFrame:
    """One row with all plain metrics of one side. A column that is absent gets NULL metrics."""
    have = set(df.columns)
    dtype = {f.name: f.dataType for f in df.schema}
    aggs = [F.count(F.lit(1)).alias("row_count")]
    if pk in have:
        aggs += [F.min(pk).cast("bigint").alias("min_id"), F.max(pk).cast("bigint").alias("max_id")]
    for c in not_null:
        aggs.append((F.count_if(is_missing(F.col(c), dtype[c])) if c in have
                     else F.max(F.lit(None).cast("bigint"))).alias(f"nulls_{c}"))
    for c in numeric:
        v = cast_or_null(F.col(c), dtype[c], SUM_TYPE) if c in have else F.lit(None).cast(SUM_TYPE)
        n = F.count(v) if c in have else F.max(F.lit(None).cast("bigint"))
        # NaN, infinity, text that is no number, and what is beyond the sum's type
        unfit = F.count_if(F.col(c).isNotNull() & v.isNull()) if c in have else F.max(F.lit(None).cast("bigint"))
        aggs += [F.try_sum(v).alias(f"sum_{c}"), n.alias(f"count_{c}"), unfit.alias(f"unfit_{c}")]
    return df.agg(*aggs).select(F.lit(table).alias("table_name"), F.lit(side).alias("side"), "*")


def pair_sides(source: DataFrame, target: DataFrame) -> DataFrame:
    """One row per table with src_* and tgt_* columns; a table only one side has keeps NULLs."""
    both = source.unionByName(target, allowMissingColumns=True)
    metrics = [c for c in both.columns if c not in ("table_name", "side")]
    pick = [F.max(F.when(F.col("side") == side, F.col(m))).alias(f"{prefix}_{m}")
            for m in metrics for side, prefix in (("source", "src"), ("target", "tgt"))]
    return both.groupBy("table_name").agg(*pick)


def count_difference(src: Column, tgt: Column) -> Column:
    """|src - tgt| / src; with an empty source 0 if the target is empty too, else 1."""
    return (F.when(src > 0, F.abs(src - tgt).cast("double") / src.cast("double"))
            .when(tgt == 0, F.lit(0.0)).otherwise(F.lit(1.0)))


def row_count_check(paired: DataFrame, tolerance: float = COUNT_TOLERANCE) -> DataFrame:
    src, tgt = F.col("src_row_count"), F.col("tgt_row_count")
    fraction = count_difference(src, tgt)
    return paired.select(
        "table_name", src.alias("source_count"), tgt.alias("target_count"), (src - tgt).alias("difference"),
        (fraction * 100).alias("difference_percent"), (fraction <= tolerance).alias("is_valid"),
    )


def row_count_at_least(paired: DataFrame) -> DataFrame:
    """One-sided form: the target must have at least as many rows as the source."""
    src, tgt = F.col("src_row_count"), F.col("tgt_row_count")
    pct = F.when(src > 0, tgt.cast("double") / src.cast("double") * 100).otherwise(F.lit(0.0))
    return paired.select("table_name", src.alias("source_count"), tgt.alias("target_count"),
                         (tgt - src).alias("difference"), pct.alias("target_percent"), (tgt >= src).alias("is_valid"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count; NULL keys form one group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")).filter("occurrences > 1")


_WORD = 64   # keys that one counter word holds, a bit each
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _packed(df: DataFrame, keys: Sequence[str]) -> Column | None:
    """A number that only rows of the same keys share, NULL if a key is: the place in the box that the keys span. None if
    keys are no whole numbers or their box is beyond a BIGINT. Reads the keys' smallest and largest values: one row."""
    if not all(isinstance(df.schema[k].dataType, _INTEGRAL) for k in keys):
        return None
    ends = df.agg(*[f(F.col(f"`{k}`").cast("bigint")).alias(f"{n}{i}") for i, k in enumerate(keys) for f, n in ((F.min, "lo"), (F.max, "hi"))]).first()
    code, size = F.lit(0).cast("bigint"), 1
    for i, k in enumerate(keys):
        low, high = ends[f"lo{i}"] or 0, ends[f"hi{i}"] or 0
        size *= high - low + 1
        if size >= 1 << 62 or low < -(1 << 62):
            return None
        code = code * F.lit(high - low + 1).cast("bigint") + (F.col(f"`{k}`").cast("bigint") - F.lit(low).cast("bigint"))
    return code


def counter_words(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column] | None:
    """(word, rows, bits) and the word of a row. A word counts 64 neighbouring keys: its rows, and a bit per key that
    occurs. Words merge before the shuffle, so a table that lies roughly by key sends a row per 64 keys and task."""
    code = _packed(df, keys)
    if code is None:
        return None
    word = F.shiftright(code, _WORD.bit_length() - 1)
    bit = F.expr("shiftleft(1L, int(_code & 63))")
    counted = df.select(code.alias("_code")).groupBy(F.shiftright("_code", _WORD.bit_length() - 1).alias("word")).agg(
        F.count(F.lit(1)).alias("rows"), F.bit_count(F.bit_or(bit)).alias("bits"))
    return counted, word


def duplicate_keys_two_pass(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Like duplicate_keys, for tables whose keys are nearly all unique.

    First the counter words of all keys; a word with more rows than bits has a key twice. Then only rows of such
    words are shuffled and grouped. Keys that cannot be packed into numbers go through duplicate_keys.
    """
    found = counter_words(df, keys)
    if found is None:
        return duplicate_keys(df, keys)
    words, word = found
    # a key is NULL: no word, but one group, as before; written, so that Spark knows how few they are
    full = stored(words.filter("word is null or rows > bits").select("word"), "full_words")
    rows = df.select(*keys, word.alias("_word"))
    return duplicate_keys(rows.join(full, rows["_word"].eqNullSafe(full["word"]), "left_semi"), keys)


def duplicate_check(df: DataFrame, table: str, keys: Sequence[str], two_pass: bool = False) -> DataFrame:
    n = F.count(F.lit(1))
    return (duplicate_keys_two_pass if two_pass else duplicate_keys)(df, keys).agg(
        n.alias("duplicate_keys"),
        F.coalesce(F.sum("occurrences"), F.lit(0)).alias("rows_involved"),
        (n == 0).alias("is_valid"),
    ).select(F.lit(table).alias("table_name"), "*")


def top_duplicates(df: DataFrame, keys: Sequence[str], k: int = 5) -> DataFrame:
    """The k most repeated keys; Spark keeps k rows per task and never sorts the whole set."""
    return duplicate_keys(df, keys).orderBy(F.desc("occurrences"), *keys).limit(k)


def null_check(metrics: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(table_name, column_name, status, null_count, is_valid) from a side's metrics.

    A column the table does not have is reported as absent, and does not fail.
    """
    def row(c: str) -> Column:
        n = F.col(f"nulls_{c}")
        return F.struct(
            F.lit(c).alias("column_name"), F.when(n.isNull(), "absent").otherwise("checked").alias("status"),
            n.alias("null_count"), (F.coalesce(n, F.lit(0)) == 0).alias("is_valid"))
    return metrics.select("table_name", F.inline(F.array(*[row(c) for c in columns])))


def id_range_check(paired: DataFrame) -> DataFrame:
    """Valid if both sides start at the same id; the top may differ while the source is live."""
    return paired.select("table_name", "src_min_id", "tgt_min_id", "src_max_id", "tgt_max_id",
                         F.col("src_min_id").eqNullSafe(F.col("tgt_min_id")).alias("is_valid"))


def sum_difference_percent(src: Column, tgt: Column) -> Column:
    """Percent by which the sums differ. The base is |src|, so a negative sum cannot hide a difference."""
    s, t = F.coalesce(src, F.lit(0)).cast("double"), F.coalesce(tgt, F.lit(0)).cast("double")
    return F.when(s != 0, F.abs(t - s) / F.abs(s) * 100).when(t == 0, F.lit(0.0)).otherwise(F.lit(100.0))


def all_fit(column: str) -> Column:
    """Whether both sides could sum all of the column's values."""
    return (F.coalesce(f"src_unfit_{column}", F.lit(0)) == 0) & (F.coalesce(f"tgt_unfit_{column}", F.lit(0)) == 0)


def aggregate_check(paired: DataFrame, columns: Sequence[str], tolerance_pct: float = SUM_TOLERANCE_PCT) -> DataFrame:
    """(table_name, column_name, status, sums, averages, unfit values, difference_percent, is_valid), one row per column.

    A column that neither side has is reported as absent and does not fail; one that a single side
    has counts as a sum against nothing. Values that no sum can hold are counted, and fail the column.
    """
    def average(side: str, c: str) -> Column:
        n = F.col(f"{side}_count_{c}")
        return F.round(F.when(n > 0, F.col(f"{side}_sum_{c}").cast("double") / n.cast("double")), 4)

    def row(c: str) -> Column:
        absent = F.col(f"src_count_{c}").isNull() & F.col(f"tgt_count_{c}").isNull()
        pct = F.when(~absent, sum_difference_percent(F.col(f"src_sum_{c}"), F.col(f"tgt_sum_{c}")))
        return F.struct(
            F.lit(c).alias("column_name"), F.when(absent, "absent").otherwise("checked").alias("status"),
            F.col(f"src_sum_{c}").alias("source_sum"), F.col(f"tgt_sum_{c}").alias("target_sum"),
            average("src", c).alias("source_avg"), average("tgt", c).alias("target_avg"),
            F.col(f"src_unfit_{c}").alias("source_unfit"), F.col(f"tgt_unfit_{c}").alias("target_unfit"),
            F.round(pct, 6).alias("difference_percent"), (absent | ((pct < tolerance_pct) & all_fit(c))).alias("is_valid"))
    return paired.select("table_name", F.inline(F.array(*[row(c) for c in columns])))


def scorecard(checks: DataFrame, scored: Sequence[str] = SCORED) -> DataFrame:
    """Checks passed per table, from long-form rows; PASS only if all passed. Sums do not count.

    A check with several rows, one per column, passes if all of them do.
    """
    per_check = (checks.filter(F.col("check_type").isin(*scored)).groupBy("table_name", "check_type")
                 .agg(F.bool_and("is_valid").alias("is_valid")))
    passed, total = F.count_if(F.col("is_valid")), F.count(F.lit(1))
    return per_check.groupBy("table_name").agg(
        passed.alias("checks_passed"), total.alias("checks_total"),
        F.when(passed == total, "PASS").otherwise("FAIL").alias("status"))


def check_row(check_type: str, source: Column | None, target: Column, difference: Column | None,
              percent: Column | None, valid: Column) -> Column:
    """One long-form quality row, without table, run id and time."""
    def of(c: Column | None, dtype: str) -> Column:
        return (F.lit(None) if c is None else c).cast(dtype)
    return F.struct(F.lit(check_type).alias("check_type"), of(source, "string").alias("source_value"),
                    of(target, "string").alias("target_value"), of(difference, "bigint").alias("difference"),
                    of(percent, "double").alias("difference_percent"), valid.alias("is_valid"))


def row_count_row(check_type: str, src: Column, tgt: Column, tolerance: float = COUNT_TOLERANCE) -> Column:
    fraction = count_difference(src, tgt)
    return check_row(check_type, src, tgt, src - tgt, fraction * 100, fraction <= tolerance)


def all_checks(source: DataFrame, target: DataFrame, table: str, pk: str, not_null: Sequence[str] = (),
               numeric: Sequence[str] = (), tolerance: float = COUNT_TOLERANCE,
               keys: Sequence[str] | None = None) -> DataFrame:
    """Every check of one table as long-form rows. `keys` says what must be unique, if not `pk` alone.

    A column that is asked for and not there gives a row that says absent and is not valid. All plain
    checks unfold from the one paired row, so that each side is scanned once for them; the duplicate
    check reads the target's key.
    """
    paired = pair_sides(side_metrics(source, table, "source", pk, not_null, numeric),
                        side_metrics(target, table, "target", pk, not_null, numeric))
    src_id, tgt_id = F.col("src_min_id"), F.col("tgt_min_id")
    src_n, tgt_n = F.col("src_row_count"), F.col("tgt_row_count")
    rows = [row_count_row("ROW_COUNT", src_n, tgt_n, tolerance),
            check_row("ROW_COUNT_MIN", src_n, tgt_n, tgt_n - src_n, None, tgt_n >= src_n),
            check_row("ID_RANGE", src_id, tgt_id, src_id - tgt_id, None, src_id.eqNullSafe(tgt_id))]
    for c in not_null:
        n = F.col(f"tgt_nulls_{c}")   # NULL if the target has no such column: absent, and not valid
        rows.append(check_row("NULL_CHECK", F.lit(c), F.coalesce(n.cast("string"), F.lit(ABSENT)), n, None, F.coalesce(n == 0, F.lit(False))))
    for c in numeric:
        s, t = F.col(f"src_sum_{c}"), F.col(f"tgt_sum_{c}")
        pct = sum_difference_percent(s, t)
        here = F.col(f"src_count_{c}").isNotNull() & F.col(f"tgt_count_{c}").isNotNull()
        shown = [F.when(F.col(f"{side}_count_{c}").isNull(), ABSENT).otherwise(v.cast("string")) for side, v in (("src", s), ("tgt", t))]
        rows.append(check_row("SUM_CHECK", *shown, None, F.when(here, F.round(pct, 6)),
                              here & (pct < SUM_TOLERANCE_PCT) & all_fit(c)))
    plain = paired.select("table_name", F.inline(F.array(*rows)))
    dups = duplicate_check(target, table, list(keys or [pk])).select("table_name", F.inline(F.array(check_row(
        "DUPLICATE_KEY", None, F.col("duplicate_keys"), F.col("duplicate_keys"), None, F.col("is_valid")))))
    return plain.unionByName(dups)
