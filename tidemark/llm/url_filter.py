"""URL filter: short rules first, then a list of URLs behind a blocked Bloom filter.

URLs are compared in a canonical form. The list is written once, without repeats; its blocked Bloom filter is a table of
blocks, eight words of 64 bits each, in which a URL sets one bit a word. A URL looks at one block alone, found by a
join: broadcast while the number of blocks, known from the list's, is at most ``BROADCAST_BLOCKS``, by exchange beyond it. URLs that
the filter passes meet the list in a hash join on the whole canonical URL, which removes false positives; the others
are never exchanged. A URL that very many rows share meets a table on the other side, so
``spark.sql.adaptive.skewJoin`` can split it.

Rules are given by the caller, as code or settings are, and become an expression; what is long belongs in the list.

Defined cases: a URL that is null or has no ``://`` has an empty host and path, is never listed and fits no rule. Repeated rows
are judged alike. Entries of the list that are null or no URLs are left out, repeated ones count once; an empty list
blocks nothing. Of rules with the same host and path that disagree, ``block`` wins. A URL may have any length.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise

#: Bits of the filter for a listed URL: about one in a hundred others passes.
BITS = 12
WORDS, WORD_BITS = 8, 64
#: Most blocks that are broadcast: about 10 MB, for a list of 5.5 million URLs.
BROADCAST_BLOCKS = 1 << 17

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)\A.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
#: Parameters that say where a visitor comes from, not which page it is.
TRACKING = r"\A(?:utm_[^=]*|gclid|fbclid|ref)(?:=|\z)"


class Rule(NamedTuple):
    """``verdict`` for ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str


def host(url: Column) -> Column:
    """What stands after the first ``://`` up to a slash, question mark or number sign, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host up to a question mark or number sign."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host, path and query of a URL as one text, the same for its usual spellings; null where there is no host.

    Scheme, user, default port, final dot and leading ``www.`` go, so do fragment, repeated and final slashes and tracking
    parameters; the other parameters are sorted.
    """
    name = F.regexp_replace(F.regexp_replace(host(url), r"(?s)\A.*@", ""), r"(?::(?:80|443)?)?\z", "")
    name = F.regexp_replace(F.regexp_replace(name, r"\.\z", ""), r"\Awww\.", "")
    place = F.regexp_replace(F.regexp_replace(path(url), "/+", "/"), r"/\z", "")
    pairs = F.split(F.coalesce(F.regexp_extract(url, _PARTS, 3), F.lit("")), "&", -1)
    own = F.array_sort(F.filter(pairs, lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.when(F.size(own) > 0, F.concat(F.lit("?"), F.array_join(own, "&"))).otherwise("")
    return F.when(name != "", F.concat(name, place, query))


def fitting(host: Column, path: Column, rules: list[Rule]) -> Column:
    """``rule`` (host and path as one text) and ``verdict`` of the longest rule that fits, as a struct; null without one."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), r.host + r.path, r.verdict == "block")):
        own = F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = F.when(fits, own).otherwise(out)
    return out


def _bits(key: Column) -> list[Column]:
    """The bit of a key in each word of its block."""
    h = F.xxhash64(key, F.lit(1))
    places = [F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(WORD_BITS - 1)).cast("int") for i in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in places]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def blocked_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """Blocks ``block, w0 ... w7`` of the filter of ``canonical``; blocks without a key have no row."""
    key = F.col("canonical")
    bits = listed.select(_block(key, blocks).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(_bits(key))])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def judge(
    pages: DataFrame, listed: DataFrame, scratch: str, rules: list[Rule], url: str = "url", listed_url: str = "url",
    columns: tuple[str, ...] = (), broadcast_blocks: int = BROADCAST_BLOCKS,
) -> DataFrame:
    """Of each row of ``pages``: the named ``columns`` as the struct ``row``, ``host, path, canonical, rule, listed, verdict``.

    ``verdict`` is that of the longest fitting rule; without one ``block`` if the URL is listed, else ``allow``.
    """
    unique = listed.select(canonical(F.col(listed_url)).alias("canonical")).where("canonical IS NOT NULL").distinct()
    unique = materialise(unique, f"{scratch}/listed")
    blocks = max(1, -(-unique.count() * BITS // (WORDS * WORD_BITS)))
    words = materialise(blocked_filter(unique, blocks), f"{scratch}/filter")
    words = F.broadcast(words) if blocks <= broadcast_blocks else words

    address = F.col(url)
    rows = pages.select(
        F.struct(F.lit(0).alias("_"), *columns).alias("row"), host(address).alias("host"), path(address).alias("path"),
        canonical(address).alias("canonical"),
    )
    rows = rows.select("*", fitting(F.col("host"), F.col("path"), rules).alias("fit"), _block(F.col("canonical"), blocks).alias("block"))
    passed = F.lit(True)
    for i, bit in enumerate(_bits(F.col("canonical"))):
        passed = passed & (F.col(f"w{i}").bitwiseAND(bit) == bit)
    probed = rows.join(words, "block", "left").select(
        "row", "host", "path", "canonical", "fit.rule", F.col("fit.verdict").alias("ruled"),
        (F.col("canonical").isNotNull() & F.coalesce(passed, F.lit(False))).alias("passed"),
    )
    probed = materialise(probed, f"{scratch}/probed")
    exact = probed.where("passed").join(
        unique.withColumn("listed", F.lit(True)).hint("shuffle_hash"), "canonical", "left"
    ).withColumn("listed", F.coalesce("listed", F.lit(False)))
    every = exact.unionByName(probed.where("NOT passed").withColumn("listed", F.lit(False)))
    verdict = F.coalesce("ruled", F.when(F.col("listed"), "block").otherwise("allow"))
    return every.select("row", "host", "path", "canonical", "rule", "listed", verdict.alias("verdict"))
