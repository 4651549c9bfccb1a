"""URL filters: path rules, and a list of canonical URLs behind a blocked Bloom filter.

Every listed URL sets one bit in each of the eight words of one 512-bit block. The blocks are a table that is made by a
`bit_or` aggregation. Its number of rows is bounded, so it can be sent to all tasks whatever the length of the list: a longer
list only passes more false hits. Hits are compared with the list itself in a hash join, which removes those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adstrata.llm.common import ascii_lower

#: Blocks of 64 bytes: 8 MB at most.
MOST_BLOCKS = 131_072
URLS_PER_BLOCK = 32
_WORDS = 8
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Query parameters that don't change what a URL shows. Fixed values.
TRACKING = r"(?:utm_[a-z]+|gclid|fbclid|ref)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first `://`, up to `/`, `?`, `#` or the end, in lower case; then up to `?`, `#` or the end."""
    host = F.regexp_extract(url, _PARTS, 1)
    return ascii_lower(F.coalesce(host, F.lit(""))), F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without `www.` or `m.`, path without a last slash, and the query without tracking; null for no host."""
    host, path = host_and_path(url)
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    query = F.regexp_replace(query, rf"(?:^|&){TRACKING}=[^&]*", "")
    query = F.regexp_replace(query, "^&", "")
    query = F.when(F.coalesce(query, F.lit("")) != "", F.concat(F.lit("?"), query)).otherwise("")
    whole = F.concat(F.regexp_replace(host, r"^(?:www|m)\.", ""), F.regexp_replace(path, "/$", ""), query)
    return F.when(host != "", whole)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule of `rules` (verdict, host, path) and its verdict; null for none. Ties: the first given."""
    rule = verdict = F.lit(None).cast("string")
    for says, site, start in sorted(rules, key=lambda r: -len(r[1] + r[2]))[::-1]:
        fits = ((host == site) | F.endswith(host, F.lit("." + site))) & F.startswith(path, F.lit(start))
        rule, verdict = F.when(fits, site + start).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _bit(word: int) -> str:
    """The one bit that a URL sets in a word of its block."""
    return f"shiftleft(1L, cast(pmod(shiftrightunsigned(h2, {6 * word}), 64) as int))"


def _hashed(urls: DataFrame, blocks: int) -> DataFrame:
    return urls.withColumn("h2", F.xxhash64("canonical", F.lit(2))).withColumn(
        "block", F.pmod(F.xxhash64("canonical", F.lit(1)), F.lit(blocks))
    )


def bloom_blocks(listed: DataFrame, blocks: int) -> DataFrame:
    """`block` and its words `w0` .. `w7`, for the URLs in `listed.canonical`."""
    words = [F.expr(f"bit_or({_bit(i)})").alias(f"w{i}") for i in range(_WORDS)]
    return _hashed(listed, blocks).groupBy("block").agg(*words)


def listed_urls(pages: DataFrame, listed: DataFrame) -> DataFrame:
    """The rows of `pages` (`canonical`, any others) whose `canonical` is in `listed` (`canonical`, distinct).

    Null is in no list. With an empty list there are no rows.
    """
    listed = listed.select("canonical").dropna()
    blocks = max(1, min(MOST_BLOCKS, -(-listed.count() // URLS_PER_BLOCK)))
    hit = " and ".join(f"(w{i} & {_bit(i)}) <> 0" for i in range(_WORDS))
    # At most MOST_BLOCKS rows of 72 bytes.
    hits = _hashed(pages, blocks).join(F.broadcast(bloom_blocks(listed, blocks)), "block").filter(hit)
    return hits.select(*pages.columns).join(listed, "canonical", "left_semi")


def judged(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str, str]], key: str = "page_id") -> DataFrame:
    """`key`, `host`, `path`, `rule`, `verdict` for every row of `pages` (`url`, `key`).

    A rule decides first. Without one, pages whose canonical URL is in `listed` (`canonical`) are blocked, others allowed.
    A null url, or one without `://`, has an empty host and path and is allowed. Repeated rows stay.
    """
    host, path = host_and_path(F.col("url"))
    parts = pages.select(F.col(key), host.alias("host"), path.alias("path"), canonical(F.col("url")).alias("canonical"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    parts = parts.withColumns({"rule": rule, "verdict": verdict})
    open_ = parts.filter("verdict is null and canonical is not null").select("canonical")
    blocked = listed_urls(open_.distinct(), listed).withColumn("listed", F.lit(True))
    found = parts.join(blocked, "canonical", "left")
    method = F.when(F.col("listed"), "block").otherwise("allow")
    return found.select(key, "host", "path", "rule", F.coalesce("verdict", method).alias("verdict"))
