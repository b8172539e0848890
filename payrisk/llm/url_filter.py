"""URL rules behind a blocked Bloom filter.

A listed URL is a canonical ``host/path`` key. It holds for its host and all subdomains and
for every path that starts with its own; the longest one wins. A page's URL therefore stands
for a few keys: each parent host with each listed length of its path. A blocked Bloom filter
of the listed keys (one 512-bit block and eight bits per key) lets possible hits through to
an exact hash join on the key itself, which removes the false positives.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payrisk.llm.common import lower_ascii, stored

# The base rules (key, verdict).
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
# Gambling, pharmacy and tracking hosts to block where no base rule fits.
LISTED = (
    ("ads-track.example.com/", "block"),
    ("casino-win.example.com/", "block"),
    ("cheap-pills.example.com/", "block"),
    ("free-bets.example.com/", "block"),
)
WORDS = 8  # 64-bit words of a block; a key sets one bit in each
BITS_PER_KEY = 16
BROADCAST_BLOCKS = 1 << 15  # 2 MB of blocks at most are broadcast; more are joined


def url_host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``; empty without ``://``."""
    return lower_ascii(_after_scheme(url, r"(?s)^.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """From the host's end to ``?``, ``#`` or the end."""
    return _after_scheme(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column, pattern: str, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, pattern, group), F.lit(""))


def keys_frame(spark: SparkSession, entries) -> DataFrame:
    rows = [F.struct(F.lit(k).alias("key"), F.lit(v).alias("verdict")) for k, v in entries]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _bit(key: Column, word: int) -> Column:
    place = F.pmod(F.xxhash64(key, F.lit(word)), F.lit(64)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def bloom_blocks(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, w0 .. w7) of the keys; blocks without a key are left out."""
    block = F.pmod(F.xxhash64("key"), F.lit(blocks)).alias("__block")
    return keys.groupBy(block).agg(
        *[F.bit_or(_bit(F.col("key"), i)).alias(f"__w{i}") for i in range(WORDS)]
    )


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """All keys that a URL stands for: parent hosts x starts of its path of listed lengths."""
    labels = F.split(host, r"\.")
    hosts = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    starts = F.filter(
        F.transform(F.array(*map(F.lit, lengths)), lambda n: F.substring(path, F.lit(1), n)),
        lambda start: F.array_contains(F.array(*map(F.lit, lengths)), F.length(start)),
    )
    pairs = F.transform(hosts, lambda h: F.transform(starts, lambda s: F.concat(h, s)))
    return F.array_distinct(F.flatten(pairs))


def possible_hits(candidates: DataFrame, keys: DataFrame, blocks: int) -> DataFrame:
    """Candidates whose eight bits are all set in their block."""
    filled = bloom_blocks(keys, blocks)
    if blocks <= BROADCAST_BLOCKS:
        filled = F.broadcast(filled)
    probe = candidates.withColumn("__block", F.pmod(F.xxhash64("key"), F.lit(blocks)))
    hit = reduce(
        lambda a, b: a & b,
        [F.col(f"__w{i}").bitwiseAND(_bit(F.col("key"), i)) != 0 for i in range(WORDS)],
    )
    return probe.join(filled, "__block").filter(hit).select(*candidates.columns)


def matches(places: DataFrame, listed: DataFrame) -> DataFrame:
    """(host, path) x every listed key that fits it, with that key's other columns.

    Path lengths of the list bound the keys per URL, however long the URL is.
    """
    count = listed.count()
    lengths = listed.select(
        F.length(F.regexp_extract("key", r"(?s)^[^/]*(.*)$", 1)).alias("n")
    ).distinct()
    lengths = sorted(row.n for row in lengths.collect())
    if not lengths:
        return places.join(listed, F.lit(False))
    blocks = math.ceil(count * BITS_PER_KEY / (64 * WORDS))
    candidates = places.select(
        "host", "path",
        F.explode(candidate_keys(F.col("host"), F.col("path"), lengths)).alias("key"),
    )
    return possible_hits(candidates, listed, blocks).join(listed, "key")


def filter_urls(
    pages: DataFrame, rules: DataFrame, listed: DataFrame, url: str = "url"
) -> DataFrame:
    """``pages`` plus host, path, rule and verdict.

    Of the ``rules`` that fit, the longest decides and is named in ``rule``. Otherwise the
    longest ``listed`` key does, and pages on neither list are allowed; of equal keys the
    verdict ``block`` wins. Rules and listed keys share one filter and one join. Repeated
    places are matched once. A null URL, or one without ``://``, has an empty host and path
    and is allowed. Null keys fit nothing. Columns of these four names are replaced.
    """
    marked = stored(
        rules.withColumn("rank", F.lit(1))
        .unionByName(listed.withColumn("rank", F.lit(0)))
        .filter(F.col("key").isNotNull())
        .groupBy("key")
        .agg(F.max(F.struct("rank", "verdict")).alias("top"))
        .select("key", "top.rank", "top.verdict"),
        "url-keys",
    )
    added = ("host", "path", "rule", "verdict")
    kept = [F.col(c) for c in pages.columns if c not in added]
    parsed = pages.select(
        *kept, url_host(F.col(url)).alias("__host"), url_path(F.col(url)).alias("__path")
    )
    places = parsed.select(F.col("__host").alias("host"), F.col("__path").alias("path")).distinct()
    best = F.max(F.struct("rank", F.length("key").alias("n"), "key", "verdict")).alias("best")
    found = matches(places, marked).groupBy("host", "path").agg(best).select(
        F.col("host").alias("__h"), F.col("path").alias("__p"), "best.rank", "best.key", "best.verdict"
    )
    same = (F.col("__host") == F.col("__h")) & (F.col("__path") == F.col("__p"))
    return parsed.join(found, same, "left").select(
        *kept,
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.when(F.col("rank") == 1, F.col("key")).alias("rule"),
        F.coalesce("verdict", F.lit("allow")).alias("verdict"),
    )


def url_table(pages: DataFrame) -> DataFrame:
    spark = pages.sparkSession
    judged = filter_urls(
        pages.select("page_id", "url"), keys_frame(spark, RULES), keys_frame(spark, LISTED)
    )
    return judged.select("page_id", "host", "path", "rule", "verdict")


def sql() -> str:
    def rows(entries, rank: int) -> list[str]:
        return [f"('{key}', '{verdict}', {rank})" for key, verdict in entries]

    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
with parsed as (
  select page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   '{upper}', '{upper.lower()}') as host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), listed(key, verdict, rank) as (
  values {', '.join(rows(RULES, 1) + rows(LISTED, 0))}
), parts as (
  select *, split_part(key, '/', 1) as h, substr(key, strpos(key, '/')) as p from listed
)
select page_id, host, path,
       max(case when rank = 1 then key end) as rule, coalesce(max(verdict), 'allow') as verdict
from (
  select *, row_number() over (partition by page_id order by rank desc nulls last, length(key) desc) as place
  from parsed left join parts
    on (host = h or ends_with(host, '.' || h)) and starts_with(path, p)
) where place = 1
group by page_id, host, path
"""
