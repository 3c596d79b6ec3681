"""URL filter: a blocked Bloom filter in front of an exact hash join.

What is listed is one table of keys: rules (a host and a path prefix, with their
verdict) and whole canonical urls. A url has a key for each of its host's suffixes
with each path prefix as long as some rule's, and one for its canonical form. The
filter is a table of blocks of 256 bits: a key's hash names its block, a second
hash sets ``BITS`` bits there. Keys that fail the filter are certainly not listed
and go no further; the others are counted per key, and an exact join of these
counts with the list removes false positives. Only what is really listed is joined
to the urls; keys that many urls share are broadcast (no more than
``common.SHARE`` of them can be that frequent), so no host is one task's work.

The filter has at most ``MAX_BLOCKS`` blocks (8 MB): a longer list only lets more
keys through to the exact join.

Defined results: a url that is null or has no ``://`` has an empty host and path;
A-Z of a host are lower-cased, nothing else is. Of the rules that fit, the longest
(host and path together, then host) wins; of rules that are listed twice for one
host and path, block wins. Without a rule a listed canonical url has its verdict,
and every other url is allowed. Repeated rows are judged each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import as_row, join_by_share, let, named, of_row, ship, written

ship(__name__)

BITS = 6                    # bits of a key in its block
KEY_BITS = 12               # bits of the filter for each key
WORDS = 4                   # 64-bit words of a block
MAX_BLOCKS = 1 << 18
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host and path without the slashes at its end; scheme, query and fragment do not count."""
    return F.concat(host, F.regexp_replace(path, "/+$", ""))


def listed_keys(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """(key, size, host_size, rule, verdict) of ``rules`` (host, path, verdict)
    and ``urls`` (canonical, verdict). Entries that are empty or null list nothing."""
    own = rules.where((F.col("host") != "") & F.col("path").isNotNull()).select(
        F.concat(F.lit("r"), "host", "path").alias("key"), F.length(F.concat("host", "path")).alias("size"),
        F.length("host").alias("host_size"), F.concat("host", "path").alias("rule"), "verdict")
    whole = urls.where(F.col("canonical") != "").select(
        F.concat(F.lit("u"), "canonical").alias("key"), F.lit(-1).alias("size"), F.lit(-1).alias("host_size"),
        F.lit(None).cast("string").alias("rule"), "verdict")
    both = own.unionByName(whole)
    return both.groupBy("key").agg(*[F.max(c).alias(c) for c in ("size", "host_size", "rule", "verdict")])


def _shift(x, n) -> Column:
    return F.call_function("shiftrightunsigned", x, n)


def _places(key: Column, blocks: int) -> tuple[Column, list[Column]]:
    """Block of a key and its bits (0 to 255) there."""
    other = F.xxhash64(key, F.lit(1))
    return (F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"),
            [_shift(other, F.lit(8 * j)).bitwiseAND(F.lit(255)).cast("int") for j in range(BITS)])


def block_table(keys: DataFrame, blocks: int) -> DataFrame:
    """The filter: (block, w0, ... of 64 bits) for the blocks that hold a key."""
    block, bits = _places(F.col("key"), blocks)
    marks = []
    for w in range(WORDS):
        mark = F.lit(0).cast("long")
        for bit in bits:
            own = F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)))
            mark = mark.bitwiseOR(F.when(_shift(bit, F.lit(6)) == w, own).otherwise(F.lit(0).cast("long")))
        marks.append(mark.alias(f"w{w}"))
    return keys.select(block.alias("block"), *marks).groupBy("block").agg(
        *[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(WORDS)])


def bloom_filter(keys: DataFrame) -> tuple[Column, int]:
    """The filter as one constant array of words, and its blocks. Its size is
    bounded by ``MAX_BLOCKS``, whatever the list holds."""
    blocks = min(MAX_BLOCKS, max(1, keys.count() * KEY_BITS // (64 * WORDS) + 1))
    words = ["0"] * (blocks * WORDS)
    for r in block_table(keys, blocks).collect():           # at most MAX_BLOCKS rows
        for w in range(WORDS):
            words[r["block"] * WORDS + w] = str(r[f"w{w}"])
    return F.split(F.lit(",".join(words)), ",").cast("array<bigint>"), blocks


def may_hold(words: Column, blocks: int, key: Column) -> Column:
    """Whether the filter holds a key: never false for a listed one."""
    block, bits = _places(key, blocks)
    test = None
    for bit in bits:
        word = F.get(words, block * WORDS + _shift(bit, F.lit(6)))
        one = _shift(word, bit.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1).cast("long")) == 1
        test = one if test is None else test & one
    return test


def filter_urls(pages: DataFrame, rules: DataFrame, urls: DataFrame, url: str = "url",
                keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) plus ``host``, ``path``, ``rule`` (host and
    path of the rule that wins, or null) and ``verdict``. Columns of ``pages``
    named like new ones are replaced. ``rules``: host, path, verdict (allow or
    block); ``urls``: canonical, verdict."""
    new = ["host", "path", "rule", "verdict"]
    cols = [c for c in (keep if keep is not None else pages.columns) if c not in new]
    listed = written(listed_keys(rules, urls), "listed-urls")
    words, blocks = bloom_filter(listed)
    # path lengths of rules and the most labels of a rule's host: what keys a url needs
    need = rules.where((F.col("host") != "") & F.col("path").isNotNull()).agg(
        F.collect_set(F.length("path")).alias("sizes"), F.max(F.size(F.split("host", "\\."))).alias("labels")).first()
    sizes, most = F.array(*[F.lit(n) for n in sorted(need["sizes"])]).cast("array<int>"), need["labels"] or 0
    suffixes = let(F.split("host", "\\."), lambda x: F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(x) - most + 1), F.size(x)), lambda i: F.array_join(F.slice(x, i, F.size(x)), ".")))
    prefixes = F.transform(F.filter(sizes, lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n))
    keys = F.concat(F.flatten(F.transform(suffixes, lambda h: F.transform(
        prefixes, lambda p: F.concat(F.lit("r"), h, p)))), F.array(F.concat(F.lit("u"), canonical(F.col("host"), F.col("path")))))
    judged = pages.select(as_row(cols), host_of(named(url)).alias("host"), path_of(named(url)).alias("path"))
    judged = judged.withColumn("hits", let(words, lambda w: F.filter(keys, lambda k: may_hold(w, blocks, k))))
    judged = written(judged.withColumn("id", F.monotonically_increasing_id()), "judged-urls")
    hits = judged.select("id", F.explode("hits").alias("key"))
    # counted before the shuffle, so a key of a third of all urls is one row here
    found = written(hits.groupBy("key").agg(F.count("*").alias("n")).join(listed, "key"), "found-urls")
    entry = F.struct("size", "host_size", "rule", "verdict")
    best = (join_by_share(hits, found, "key", "n").where(F.col("verdict").isNotNull())
            .groupBy("id").agg(F.max(entry).alias("best")))
    return judged.join(best, "id", "left").select(
        *of_row(cols), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit("allow")).alias("verdict"))
