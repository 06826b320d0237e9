"""URL filter: host and path rules, then exact membership in a list by a cascade of Bloom filters.

The keys of all urls (host and path) are the universe. Level 1 encodes the listed keys; the other keys that it lets
through are encoded by level 2, the listed keys that level 2 lets through by level 3, and so on until a level lets
nothing through wrongly. Every key of the universe is then answered exactly by the first level that stops it: an even
level means listed. Nothing is joined to the urls. The filters reach the tasks as scalar subqueries.

Level 1 has so many bits a key that fewer unlisted keys pass it than there are listed ones, however many there are, so
all levels together are bounded by the number of listed keys and the logarithm of the universe. If that is more than one
task shall hold, keys and urls are written once, laid out by a hash of the key, and each shard of urls is judged with its own
filters, reading nothing but its own files. The size is checked as filters are built; more shards are taken if it is passed.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from maintlake.llm.bloom import Level, build_level, key_hashes, spread_bits
from maintlake.llm.shared import require, saved

# Rules of the contract, as verdict, host and path prefix.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Smallest level: its two hashes must not coincide too often.
MIN_WORDS = 64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def fitting_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (equally long: the one given first) and its verdict, both null if none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, h, p in reversed(sorted(rules, key=lambda r: -len(r[1] + r[2]))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, F.lit(h + p)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


class TooLarge(Exception):
    """The filters of a cascade pass their bound."""


def first_level_bits(listed: int, others: int, bits_per_key: float) -> float:
    """Bits a key of level 1: at least as many as let fewer of the other keys pass than there are listed ones."""
    return max(bits_per_key, math.log2(max(1.0, math.sqrt(2) * others / max(listed, 1))) / math.log(2))


def build_cascade(
    keys: DataFrame, bits_per_key: float = 10.0, max_bytes: float = math.inf, max_levels: int = 64
) -> list[Level]:
    """Levels for ``keys`` (key, listed), one row a key, of ``max_bytes`` in all; :class:`TooLarge` if that isn't enough."""
    levels: list[Level] = []
    inside, outside = keys.filter("listed").select("key"), keys.filter("NOT listed").select("key")
    counts = keys.agg(F.count_if("listed").alias("n"), F.count_if(~F.col("listed")).alias("m")).first()
    n, bits, used = counts["n"], first_level_bits(counts["n"], counts["m"], bits_per_key), 0.0
    while n:
        if len(levels) == max_levels:
            raise RuntimeError("the cascade doesn't end; give it more bits a key")
        used += max(8 * MIN_WORDS, n * bits / 8)
        if used > max_bytes:
            raise TooLarge
        levels.append(build_level(inside, n, len(levels), bits, MIN_WORDS))
        wrong = saved(outside.filter(levels[-1].lets_through(F.col("key"))))
        inside, outside, n, bits = wrong, inside, wrong.count(), bits_per_key
    return levels


def _judged(urls: DataFrame, levels: list[Level], rules) -> DataFrame:
    """``urls`` (page_id, host, path) with rule and verdict. Exact for keys of the universe: the level that stops one tells."""
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    hashed = urls.withColumn("key", F.concat("host", "path"))
    # each level's hashes are columns of a step of their own, computed once a url
    named = {f"{h}{level.number}": c for level in levels for h, c in zip("ab", key_hashes(F.col("key"), level.number))}
    member = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        places = spread_bits(F.col(f"a{level.number}"), F.col(f"b{level.number}"), level.bits, level.hashes)
        member = F.when(level.passes(places), member).otherwise(F.lit(level.number % 2 == 1))
    method = F.when(member, "block").otherwise("allow")
    hashed = hashed.select("*", *[c.alias(name) for name, c in named.items()])
    return hashed.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, method).alias("verdict"))


def filter_urls(
    pages: DataFrame,
    listed: Column,
    rules=RULES,
    bits_per_key: float = 10.0,
    max_filter_bytes: int = 8 << 20,
) -> DataFrame:
    """Judge every url of ``pages`` (page_id, url): ``page_id, host, path, rule, verdict``.

    ``listed`` says of a row whether it lists its key (host and path); a key is listed if any of its rows does (null
    counts as no). A url without rule is blocked if its key is listed, else allowed. Null urls and urls without ``://``
    have an empty host and path, which is a key like any other. The filters that judge a url have ``max_filter_bytes`` in
    all (4,096 at least). Repeated rows give repeated rows; without rows or
    listed keys there are no levels and every such url is allowed.
    """
    require(pages, "page_id", "url")
    url = F.col("url")
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    keys = saved(
        pages.select(F.concat(host_of(url), path_of(url)).alias("key"), F.coalesce(listed, F.lit(False)).alias("listed"))
        .groupBy("key")
        .agg(F.max("listed").alias("listed"))
    )
    counts = keys.agg(F.count_if("listed").alias("n"), F.count("*").alias("all")).first()
    first = first_level_bits(counts["n"], counts["all"] - counts["n"], bits_per_key)
    limit = max(max_filter_bytes, 64 * MIN_WORDS)
    shards = max(1, math.ceil(1.1 * counts["n"] * (first + 0.75 * bits_per_key) / 8 / limit))
    while True:
        try:
            return _sharded(judged, keys, shards, rules, bits_per_key, limit)
        except TooLarge:
            shards *= 2


def _sharded(urls: DataFrame, keys: DataFrame, shards: int, rules, bits_per_key: float, limit: int) -> DataFrame:
    if shards == 1:
        return _judged(urls, build_cascade(keys, bits_per_key, limit), rules)

    def own(key: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(-1), key), F.lit(shards)).cast("int").alias("shard")

    keys = saved(keys.select("*", own(F.col("key"))), by="shard")
    cascades = [build_cascade(keys.filter(F.col("shard") == s), bits_per_key, limit) for s in range(shards)]
    routed = saved(urls.select("*", own(F.concat("host", "path"))), by="shard")
    parts = [_judged(routed.filter(F.col("shard") == s).drop("shard"), levels, rules) for s, levels in enumerate(cascades)]
    return reduce(DataFrame.unionAll, parts)


#: What lists a key in the registered query: a link to it from a campaign.
CAMPAIGN = r"[?&]utm_[a-z]+="
ORACLE = r"""
WITH p AS (
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
listed AS (SELECT DISTINCT host || path AS k FROM p WHERE regexp_matches(url, '[?&]utm_[a-z]+=')),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM p)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN host || path IN (SELECT k FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""
