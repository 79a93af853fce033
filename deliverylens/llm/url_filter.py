"""Operator 8: URL filter, rules by host and path, then a blocked Bloom filter before an exact join.

The listed canonical URLs become a blocked Bloom filter: each URL sets ``BITS``
bits in one block of 256 bits. Blocks are OR-ed in a Spark aggregate; their
number follows the counted list up to ``MAX_BLOCKS``, so the filter has at most
``MAX_BLOCKS`` * 40 bytes, which bounds what is broadcast. Beyond that it lets more
URLs pass, never fewer. Only URLs that may be listed go on to the hash join with
the list itself, which removes false positives; copies of a URL are one row there.

All of it is DataFrame functions. Defined cases: a null URL or one without
``://`` has an empty host and path, fits no rule and is never listed; null entries
of a list are left out; repeated rows have one verdict each.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Verdict, domain, start of the path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

BITS = 8
URLS_PER_BLOCK = 20  # of 256 bits, about 13 bits a URL
MAX_BLOCKS = 1 << 18
WORDS = 4


def rest_of(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(rest_of(url), r"^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; empty unless it begins with a slash."""
    return F.regexp_extract(rest_of(url), r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, and path without a trailing slash; null without a host."""
    host = F.regexp_replace(host_of(url), r"^(www|m)\.", "")
    return F.when(host != "", F.concat(host, F.regexp_replace(path_of(url), r"/+$", "")))


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null where none does."""
    name = verdict = F.lit(None).cast("string")
    # Checked from the shortest on, so that the longest is left.
    for what, domain, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(start))
        name, verdict = F.when(fits, F.lit(domain + start)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def bloom_words(key: Column) -> list[Column]:
    """The bits of a key within its block, as words of 64 bits."""
    h = F.xxhash64(F.lit(8), key)
    out = [F.lit(0).cast("long")] * WORDS
    for i in range(BITS):
        bit = F.shiftrightunsigned(h, 8 * i).bitwiseAND(F.lit(255))
        for w in range(WORDS):
            here = F.when(F.shiftright(bit, 6) == w, F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))).otherwise(F.lit(0).cast("long"))
            out[w] = out[w].bitwiseOR(here)
    return out


def bloom_filter(listed: DataFrame, n_blocks: int) -> DataFrame:
    """One row a block in use: its number and words."""
    rows = listed.select(F.pmod(F.xxhash64("key"), F.lit(n_blocks)).alias("block"), *(w.alias(f"w{i}") for i, w in enumerate(bloom_words(F.col("key")))))
    return rows.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"f{i}") for i in range(WORDS)))


def listed_hits(urls: DataFrame, listed: DataFrame) -> DataFrame:
    """The distinct keys of ``urls`` that ``listed`` holds; both have a column ``key``."""
    keys = listed.where(F.col("key").isNotNull()).select("key").distinct()
    n_blocks = min(MAX_BLOCKS, max(1, ceil(keys.count() / URLS_PER_BLOCK)))
    blocks = F.broadcast(bloom_filter(keys, n_blocks))
    probed = urls.where(F.col("key").isNotNull()).withColumn("block", F.pmod(F.xxhash64("key"), F.lit(n_blocks))).join(blocks, "block")
    masks = bloom_words(F.col("key"))
    may_be = [F.col(f"f{i}").bitwiseAND(m) == m for i, m in enumerate(masks)]
    possible = probed.where(may_be[0] & may_be[1] & may_be[2] & may_be[3]).select("key").distinct()
    return possible.join(keys.hint("shuffle_hash"), "key", "left_semi")


def judge(pages: DataFrame, listed: DataFrame, rules=RULES, url_column: str = "url") -> DataFrame:
    """The pages with host, path, rule, verdict and whether the list holds their URL.

    ``listed`` has one column ``url`` of URLs to block where no rule fits.
    """
    keyed = pages.select(F.struct(*pages.columns).alias("page"), F.col(url_column).alias("u")).withColumn("key", canonical(F.col("u")))
    hits = listed_hits(keyed.select("key"), listed.select(canonical(F.col("url")).alias("key"))).withColumn("hit", F.lit(True))
    joined = keyed.join(hits, "key", "left").withColumns({"host": host_of(F.col("u")), "path": path_of(F.col("u"))})
    name, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    found = F.coalesce(F.col("hit"), F.lit(False))
    return joined.select("page", "host", "path", name.alias("rule"), F.coalesce(verdict, F.when(found, "block").otherwise("allow")).alias("verdict"), found.alias("listed"))
