"""URL filters: host and path rules, and a listed-URL test by blocked Bloom filter and exact join.

Native. The filter's blocks are sized from the list's count up to a bound, so it can be broadcast;
only URLs that it lets pass are shuffled to the list.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxrisk.llm.common import fresh

#: Words of 32 bits in a block, listed URLs to a block, and blocks at least and at most: 4,194,304 blocks are 128 MB of
#: bits, the proven bound of what is broadcast. Longer lists fill the blocks more and pass more URLs to the join.
WORDS = 8
URLS_PER_BLOCK = 8
LEAST_BLOCKS, MOST_BLOCKS = 64, 1 << 22

Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty for null or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` or ``m.``, and the path without index page, ``.html`` or last slash."""
    bare = F.regexp_replace(host, r"^(www|m)\.", "")
    return F.concat(bare, F.regexp_replace(F.regexp_replace(path, r"(/index)?\.html?$", ""), "/+$", ""))


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else null; rules are (verdict, host, path prefix)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, at, prefix in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(prefix)
        rule = F.when(fits, at + prefix).otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return rule, verdict


def blocks_for(urls: int) -> int:
    """Blocks of a filter for so many URLs."""
    return min(MOST_BLOCKS, max(LEAST_BLOCKS, urls // URLS_PER_BLOCK))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    """One bit for each word of the key's block."""
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(F.lit(100 + k), key), F.lit(32)).cast("int")) for k in range(WORDS)]


def bloom_filter(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """One row (block, w0 ... w7) per used block; at most ``blocks`` rows."""
    words = [bit.alias(f"w{k}") for k, bit in enumerate(_bits(F.col(key)))]
    return listed.where(F.col(key).isNotNull()).select(_block(F.col(key), blocks).alias("block"), *words).groupBy("block").agg(
        *[F.bit_or(f"w{k}").alias(f"w{k}") for k in range(WORDS)])


def listed_rows(rows: DataFrame, key: str, listed: DataFrame, listed_key: str) -> DataFrame:
    """``rows`` with boolean ``is_listed``: whether the key is among the listed ones; exact.

    The filter is sized from the list's count. Null keys are never listed. Copies in the list count once, and
    rows of a hot key are split by adaptive execution, as the list's side has one row a key. Helper columns are named so
    that no column of ``rows`` is met; an existing ``is_listed`` is replaced.
    """
    name, block, maybe, bits = (fresh(rows, n) for n in ("_key", "_block", "_maybe", "_bits"))
    names = listed.where(F.col(listed_key).isNotNull()).select(F.col(listed_key).alias(name)).distinct()
    blocks = blocks_for(names.count())
    bloom = bloom_filter(names, name, blocks).select(F.col("block").alias(block), F.array(*[f"w{k}" for k in range(WORDS)]).alias(bits))
    kept = rows.select(*[f"`{c}`" for c in rows.columns if c.lower() != "is_listed"])
    probed = kept.withColumn(maybe, _block(F.col(key), blocks)).join(F.broadcast(bloom), F.col(maybe) == F.col(block), "left")
    passes = F.col(block).isNotNull() & F.col(key).isNotNull()
    for k, bit in enumerate(_bits(F.col(key))):
        passes = passes & (F.col(bits)[k].bitwiseAND(bit) != 0)
    probed = probed.withColumn(maybe, F.coalesce(passes, F.lit(False))).drop(block, bits)
    sure = probed.where(~F.col(maybe)).withColumn("is_listed", F.lit(False))
    checked = probed.where(F.col(maybe)).join(names, F.col(key) == F.col(name), "left").withColumn("is_listed", F.col(name).isNotNull())
    return sure.drop(maybe).unionByName(checked.drop(maybe, name))


def judged_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """page_id, host, path, rule, verdict, canonical and is_listed for each row of ``pages`` (page_id, url).

    ``listed`` has the canonical URLs to block, in its column ``canonical``. Where a rule fits, its
    verdict holds; else listed URLs are blocked and all others allowed. Null and malformed urls have
    an empty host and path, fit no rule and are allowed. Repeated rows are each judged.
    """
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    parts = parts.withColumn("rule", rule).withColumn("_says", verdict).withColumn(
        "canonical", F.when(F.col("host") != "", canonical(F.col("host"), F.col("path"))))
    return listed_rows(parts, "canonical", listed, "canonical").select(
        "page_id", "host", "path", "rule",
        F.coalesce("_says", F.when(F.col("is_listed"), "block").otherwise("allow")).alias("verdict"), "canonical", "is_listed")
