"""URL filters: a blocked Bloom filter of listed canonical URLs before an exact hash join.

A listed rule is a canonical (host, path) pair with a verdict.  It fits its host
and all subdomains when the page's path starts with the rule's path; the longest
rule wins (longer host on a tie, then `block` before `allow`).

Every page address gives its candidate keys: each suffix of whole host labels
with each prefix of the path that has the length of some listed path.  The Bloom
filter is split into blocks of 8 words of 64 bits; a key touches one block and
one bit in each word, so a probe reads one row of the filter.  Keys that pass
meet the list in an exact hash join, which removes the false positives.

All of it is DataFrame work.  The filter is built by `bit_or` aggregation and
broadcast only if its checked size stays below `max_filter_bytes`; a larger one is
joined by its block number with a shuffle.  Addresses are judged once per distinct (host, path).

Defined cases: a null url or one without `://` has an empty host and path, no rule
and the default verdict; repeated pages keep one row each; rules with a null host
or path are left out; an empty list gives every page the default verdict.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = 8
BITS_PER_KEY = 16
MAX_FILTER_BYTES = 64_000_000


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _ADDRESS, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _ADDRESS, 2), F.lit(""))


def _key(host: str, path: str) -> Column:
    return F.xxhash64(F.col(host), F.col(path))


def _mask(word: int, key: str = "_key") -> Column:
    """One bit of word `word`, drawn from the key by a hash seeded with the word."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(F.lit(word), F.col(key)), F.lit(64)).cast("int"))


def bloom_blocks(rules: DataFrame, n_blocks: int) -> DataFrame:
    """The filter as one row per non-empty block: `_block, _w0 .. _w7`."""
    keyed = rules.select(_key("rule_host", "rule_path").alias("_key"))
    keyed = keyed.withColumn("_block", F.pmod(F.col("_key"), F.lit(n_blocks)))
    return keyed.groupBy("_block").agg(*(F.bit_or(_mask(i)).alias(f"_w{i}") for i in range(WORDS)))


def candidate_keys(addresses: DataFrame, path_lengths: list[int]) -> DataFrame:
    """`host, path, _host, _path`: all host suffixes and listed path lengths."""
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.filter(F.array(*(F.lit(n) for n in path_lengths)), lambda n: n <= F.length("path")),
                           lambda n: F.substring(F.col("path"), F.lit(1), n))
    return (addresses.filter(F.col("host") != "").withColumn("_path", F.explode(prefixes))
            .withColumn("_host", F.explode(suffixes)))


def judge_urls(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow",
               bits_per_key: int = BITS_PER_KEY, max_filter_bytes: int = MAX_FILTER_BYTES) -> DataFrame:
    """`pages` with `host`, `path`, `rule` and `verdict` (clashing input columns are
    replaced).  `rules`: `rule_host, rule_path, rule_verdict`."""
    made = ("host", "path", "rule", "verdict")
    base = pages.withColumns({"_url_host": host_of(F.col(url_col)), "_url_path": path_of(F.col(url_col))})
    base = base.drop(*made).withColumnsRenamed({"_url_host": "host", "_url_path": "path"})
    rules = rules.filter("rule_host is not null and rule_path is not null").select("rule_host", "rule_path", "rule_verdict")
    size = rules.agg(F.count(F.lit(1)).alias("n"), F.collect_set(F.length("rule_path")).alias("lengths")).first()
    n, lengths = size["n"], sorted(size["lengths"] or [])
    if not n:
        return base.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(default)})

    addresses = base.select("host", "path").distinct()
    keys = candidate_keys(addresses, lengths)
    n_blocks = max(1, -(-n * bits_per_key // (64 * WORDS)))
    probe = keys.withColumn("_key", _key("_host", "_path")).withColumn("_block", F.pmod(F.col("_key"), F.lit(n_blocks)))
    blocks = bloom_blocks(rules, n_blocks)
    if n_blocks * 8 * (WORDS + 1) <= max_filter_bytes:
        blocks = F.broadcast(blocks)
    test = reduce(lambda a, b: a & b, (F.col(f"_w{i}").bitwiseAND(_mask(i)) != 0 for i in range(WORDS)))
    keys = probe.join(blocks, "_block").filter(test)
    hits = keys.select("host", "path", "_host", "_path").join(
        rules, (F.col("_host") == F.col("rule_host")) & (F.col("_path") == F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    best = hits.groupBy("host", "path").agg(F.max(F.struct(
        F.length(rule).alias("length"), F.length("rule_host").alias("host_length"), F.col("rule_verdict").alias("verdict"),
        rule.alias("rule"))).alias("_best"))
    return (base.join(best, ["host", "path"], "left")
            .withColumns({"rule": F.col("_best.rule"), "verdict": F.coalesce("_best.verdict", F.lit(default))}).drop("_best"))
