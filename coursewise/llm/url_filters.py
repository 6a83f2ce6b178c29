"""URL filters: prefix rules, and a list of canonical URLs behind a blocked Bloom filter.

A rule is a host and a path prefix; it fits its host and all subdomains, and the longest one that
fits decides. Other URLs are looked up in the list: a blocked Bloom filter, one row of eight
32-bit lanes per block, lets possible hits pass to an exact hash join that removes the false
positives. The filter has at most MAX_BLOCKS rows whatever the size of the list, so broadcasting
it is bounded; a longer list only makes more false positives for the join. Everything is native.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LANES = 8
KEYS_PER_BLOCK = 16  # of 256 bits
MAX_BLOCKS = 1 << 16
#: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null or where there is no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading ``www.``, and path without closing slashes or ``.html``."""
    return F.concat(F.regexp_replace(host, r"^www\.", ""), F.regexp_replace(path, r"(\.html)?/*$", ""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null."""
    fits = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fit = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        fits = F.when(fit, value) if fits is None else fits.when(fit, value)
    return fits


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def lane_masks(key: Column) -> list[Column]:
    """One bit in each lane, from another hash of the key."""
    h = F.xxhash64(F.lit("lanes"), key)
    return [F.call_function("shiftleft", F.lit(1), F.shiftright(h, 5 * i).bitwiseAND(F.lit(31)).cast("int")) for i in range(LANES)]


def build_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """Rows (block, lane_0 ... lane_7), ``blocks`` at most."""
    bits = listed.select(block_of(F.col("key"), blocks).alias("block"), *[m.alias(f"lane_{i}") for i, m in enumerate(lane_masks(F.col("key")))])
    return bits.groupBy("block").agg(*[F.bit_or(f"lane_{i}").alias(f"lane_{i}") for i in range(LANES)])


def possible(key: Column) -> Column:
    masks = lane_masks(key)
    hit = F.col("lane_0").bitwiseAND(masks[0]) == masks[0]
    for i in range(1, LANES):
        hit = hit & (F.col(f"lane_{i}").bitwiseAND(masks[i]) == masks[i])
    return F.coalesce(hit, F.lit(False))


def judge_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule (null if none fits), verdict.

    ``listed`` has canonical URLs in the column ``key``; nulls and repeats are ignored. A page
    that no rule fits is blocked if its canonical URL is listed. Null URLs and those without a
    scheme have empty host and path, which no rule fits.
    """
    listed = listed.where("key is not null").select("key").distinct()
    blocks = min(MAX_BLOCKS, 1 << math.ceil(math.log2(max(1, listed.count() / KEYS_PER_BLOCK))))
    host, path = host_and_path(F.col("url"))
    split = pages.select("page_id", host.alias("host"), path.alias("path"))
    ruled = split.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules)).withColumn("key", canonical(F.col("host"), F.col("path")))
    bloom = F.broadcast(build_filter(listed, blocks))  # MAX_BLOCKS rows of 36 bytes at most
    probed = ruled.withColumn("block", F.when(F.col("fit").isNull(), block_of(F.col("key"), blocks)))
    probed = probed.join(bloom, "block", "left").withColumn("possible", possible(F.col("key")))
    hits = probed.where("possible").join(listed.withColumn("listed", F.lit(True)), "key", "left")
    columns = ["page_id", "host", "path", F.col("fit.rule").alias("rule")]
    passed = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    return (
        probed.where("not possible")
        .select(*columns, F.coalesce("fit.verdict", F.lit("allow")).alias("verdict"))
        .union(hits.select(*columns, passed.alias("verdict")))
    )


def listed_hosts(pages: DataFrame, terms: Sequence[str]) -> DataFrame:
    """A list for ``judge_urls``: the canonical URLs of pages whose host has a term in its name."""
    host, path = host_and_path(F.col("url"))
    named = F.lit(False)
    for term in terms:
        named = named | host.contains(term)
    return pages.select(named.alias("named"), canonical(host, path).alias("key")).where("named").select("key").distinct()
