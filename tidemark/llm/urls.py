"""URL filters: exact membership of keys by a cascade of Bloom filters, without joining the urls to a list.

A rule (verdict, host, path) fits its host and all subdomains if the url's path starts with the rule's. The
keys of a url are every suffix of its host at a label with no more labels than any listed host has, followed by
every prefix of its path that is as long as some rule's path; a rule fits exactly if its key is among them.

A cascade tells listed keys from the other keys of the corpus. Level 1 encodes the listed keys; level 2 the
corpus keys that level 1 lets through by mistake; level 3 the listed keys that level 2 holds by mistake; and
so on until a level makes no mistake over the complete universe. A key is listed if the first level that
turns it away is an even one. Level 1 has enough bits per listed key to let through about as many foreign
keys as there are listed ones, so all levels together grow with the list and the logarithm of the corpus:
that bounds the literal every task gets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import LOWER, UPPER, stored, table
from tidemark.llm.registry import query
from tidemark.session import one_row

#: (verdict, host, path) of the contract; fixed values
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Hosts (with their subdomains) that the method blocks where no rule speaks.
BLOCKED_HOSTS = tuple(f"{label}.example.{end}" for end in ("com", "net", "org")
                      for label in ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm"))
WORD_BITS = 64


@dataclass(frozen=True)
class Level:
    """A Bloom filter: 64-bit words and the number of hashes."""
    seed: int
    hashes: int
    words: tuple[int, ...]

    def positions(self, key: Column) -> list[Column]:
        bits = len(self.words) * WORD_BITS
        return [F.pmod(F.xxhash64(F.lit(self.seed), F.lit(i), key), F.lit(bits)) for i in range(self.hashes)]

    def holds(self, key: Column) -> Column:
        found = F.lit(True)
        stored_words = F.lit(list(self.words)).cast("array<bigint>")
        for p in self.positions(key):
            word = F.get(stored_words, F.shiftrightunsigned(p, 6).cast("int"))
            found = found & (F.getbit(word, (p % WORD_BITS).cast("int")) == 1)
        return found


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def lists(self, key: Column) -> Column:
        """Whether key is listed; exact for every key of the universe the cascade was built over."""
        said = F.lit(len(self.levels) % 2 == 1)
        for i, level in reversed(list(enumerate(self.levels))):
            said = F.when(level.holds(key), said).otherwise(F.lit(i % 2 == 1))
        return said


def _level(keys: DataFrame, n: int, bits_per_key: float, seed: int) -> Level:
    """The filter of n keys; only its words come to the driver, n * bits_per_key bits."""
    n_words = max(1, math.ceil(n * bits_per_key / WORD_BITS))
    level = Level(seed, max(1, round(bits_per_key * math.log(2))), (0,) * n_words)
    at = keys.select(F.explode(F.array(*level.positions(F.col("key")))).alias("p"))
    rows = (at.groupBy(F.shiftrightunsigned("p", 6).cast("int").alias("w"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits")).collect())
    words = [0] * n_words
    for r in rows:
        words[r.w] = r.bits
    return Level(seed, level.hashes, tuple(words))


def build_cascade(listed: DataFrame, universe: DataFrame, n_universe: int) -> Cascade:
    """listed, universe: one column `key`, distinct in listed. Universe rows need not be distinct."""
    n = max(1, listed.count())
    levels = [_level(listed, n, max(2.0, 1.44 * math.log2(max(2.0, n_universe / n))), 1)]
    # mistakes of level 1: about as many as there are listed keys, so from here on everything is small
    foreign = stored(universe.where(levels[0].holds(F.col("key"))).distinct()
                     .join(listed, "key", "left_anti"), "cascade")
    inside, outside = foreign, listed
    while (n_inside := inside.count()) > 0:
        level = _level(inside, n_inside, 2.0, len(levels) + 1)
        levels.append(level)
        inside, outside = outside.where(level.holds(F.col("key"))), inside
    return Cascade(tuple(levels))


def _url_parts(url: str) -> list[Column]:
    after = F.when(F.instr(url, "://") > 0, F.substr(F.col(url), F.instr(url, "://") + 3)).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    rest = F.substr(after, F.length(host) + 1)
    return [F.translate(host, UPPER, LOWER).alias("host"), F.regexp_extract(rest, r"^[^?#]*", 0).alias("path")]


def _labels(hosts: Sequence[str]) -> int:
    """The most labels that one of these hosts has."""
    return max((h.count(".") + 1 for h in hosts), default=0)


def _suffixes(host: Column, most: int) -> Column:
    """Suffixes of the host that start at a label and have at most so many labels, longest first."""
    if most < 1:
        return F.array().cast("array<string>")
    whole = F.size(F.split(host, r"\.")) <= most
    last = F.when(whole, host).otherwise(F.substring_index(host, ".", -most))  # the only ones that can be listed
    labels = F.split(last, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def _keys(host: Column, path: Column, lengths: Sequence[int], most: int) -> Column:
    """Keys of a url, longest first; ties (no two keys of a url are alike in text) by text."""
    prefixes = F.array_compact(F.array(*[
        F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(lengths, reverse=True)]))
    pairs = F.flatten(F.transform(_suffixes(host, most), lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))
    pairs = F.array_sort(F.transform(pairs, lambda k: F.struct((-F.length(k)).alias("n"), k.alias("key"))))
    return F.transform(pairs, lambda s: s["key"])


def judge_urls(pages: DataFrame, url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES,
               blocked_hosts: Sequence[str] = BLOCKED_HOSTS) -> DataFrame:
    """pages with host, path, rule and verdict (allow or block) of each url.

    The longest fitting rule decides. Where none fits, the url is blocked if its host or a parent of it is in
    blocked_hosts, else allowed. Both lists are asked through cascades built over all keys of `pages`.

    A null url and one without `://` has empty host and path: no rule fits, allowed. Rows that repeat, in any
    column, are judged alike and all kept; an empty table gives none. The other columns pass through; columns
    named host, path, rule or verdict are replaced. Empty lists are allowed.
    """
    spark = pages.sparkSession
    lengths = sorted({len(path) for _, _, path in rules})
    of_rules, of_hosts = _labels([host for _, host, _ in rules]), _labels(blocked_hosts)
    extra = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    parts = pages.select(*[pages[c] for c in extra], *_url_parts(url))
    keyed = parts.select("host", "path").withColumns({
        "rule_keys": _keys(F.col("host"), F.col("path"), lengths, of_rules) if lengths else F.array().cast("array<string>"),
        "host_keys": _suffixes(F.col("host"), of_hosts)})

    def cascade(column: str, keys: Sequence[str]) -> Cascade:
        universe = keyed.select(F.explode(column).alias("key"))
        listed = one_row(spark, key=F.explode(F.lit(sorted(set(keys))).cast("array<string>")))
        return build_cascade(listed, universe, n_rule_keys if column == "rule_keys" else n_host_keys)

    # an upper bound of the universe is enough to size level 1
    n_rule_keys, n_host_keys = (v or 0 for v in keyed.agg(F.sum(F.size("rule_keys")), F.sum(F.size("host_keys"))).first())
    blocking = cascade("rule_keys", [h + p for v, h, p in rules if v == "block"])
    allowing = cascade("rule_keys", [h + p for v, h, p in rules if v == "allow"])
    hosts = cascade("host_keys", blocked_hosts)

    keys = _keys(F.col("host"), F.col("path"), lengths, of_rules) if lengths else F.array().cast("array<string>")
    found = F.filter(F.transform(keys, lambda k: F.struct(
        k.alias("key"), F.when(blocking.lists(k), "block").when(allowing.lists(k), "allow").alias("verdict"))),
        lambda s: s["verdict"].isNotNull())
    by_host = F.when(F.exists(_suffixes(F.col("host"), of_hosts), hosts.lists), "block").otherwise("allow")
    judged = parts.withColumn("_found", F.get(found, F.lit(0)))
    return judged.select(*extra, "host", "path", F.col("_found.key").alias("rule"),
                         F.coalesce(F.col("_found.verdict"), by_host).alias("verdict"))


def _sql() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in RULES)
    hosts = ", ".join(f"('{h}')" for h in BLOCKED_HOSTS)
    return f"""
WITH rules(verdict, host, path) AS (VALUES {rules}), bad(host) AS (VALUES {hosts}),
rest AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, row_number() OVER () AS n,
    translate(regexp_extract(r, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(substr(r, length(regexp_extract(r, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM rest),
fit AS (SELECT n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
    arg_max(r.verdict, length(r.host || r.path)) AS verdict
    FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
    GROUP BY n),
banned AS (SELECT DISTINCT n FROM parts p JOIN bad b ON p.host = b.host OR ends_with(p.host, '.' || b.host))
SELECT p.page_id, p.host, p.path, f.rule,
    coalesce(f.verdict, CASE WHEN b.n IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM parts p LEFT JOIN fit f ON p.n = f.n LEFT JOIN banned b ON p.n = b.n"""


@query(_sql())
def op5_url_filters(spark, sf_dir):
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")
