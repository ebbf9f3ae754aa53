"""URL filter rules by a sort-merge range join, with DataFrame functions only.

A rule ``(host, path, verdict)`` fits its host and all subdomains if the url's path starts with the rule's; the
longest host wins, then the longest path.  The canonical key of a host and path is the host's labels reversed,
``#`` and the path, in bytes.  All keys with a rule's key as prefix form an interval, and such intervals are
nested or apart.  A url with the host ``a.b.c`` has a key for each of ``c``, ``b.c`` and ``a.b.c``.

The sweep sorts interval starts, interval ends and url keys together.  A start puts its rule on top of the
stack, an end puts back the rule below, so a stack is known by its top; the top at a url's key is the last
event's before it, a running window.  The sorted space is cut at sampled keys; every part begins with the top
that is active there.  Equal keys are collapsed before the sweep and the verdicts joined back by host and path,
so a host or url with a third of all rows weighs one key, and its rows are split by the skew join.

Parents of rules and the tops at the cuts come from equality joins on those prefixes of these few keys that are as
long as some rule key.  Keys are cut one byte behind the longest rule key.

Defined results.  Null url, or one without ``://``: host and path empty.  No rule fits: ``rule`` null and the
default verdict (allow).  Repeated rows are each judged.  Of equal rules the one with the verdict first in
alphabetical order counts.  Without rules everything gets the default; empty table: no rows.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranges import range_bucket
from ..functions.sampling import hash_sample
from .common import shuffle_partitions

DEFAULT = "allow"
SAMPLE_PER_PART = 32    # sampled keys from which a cut is taken
SALTS = 32              # parts over which the urls of one key are dealt
_END = bytes([0xFF])    # after every UTF-8 byte


def parts_of(url: Column) -> tuple[Column, Column]:
    """``(host, path)`` of a url."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    host = F.translate(F.regexp_extract(url, pattern, 1), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(url, pattern, 2)


def key_of(host: Column, path: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("#"), path).cast("binary")


def _innermost(keys: DataFrame, rules: DataFrame, lengths: list[int], proper: bool) -> DataFrame:
    """``(key, top)``: the longest rule key that is a (proper) prefix of ``key``; null if none.

    Only prefixes as long as some rule key are looked up (``lengths``), so a key costs the rules' lengths, not its own."""
    sizes = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: (n < F.octet_length("key")) if proper else (n <= F.octet_length("key")))
    every = keys.select("key", F.explode(F.transform(sizes, lambda n: F.substring("key", F.lit(1), n))).alias("prefix"))
    found = every.join(rules.select(F.col("key").alias("prefix")), "prefix").groupBy("key").agg(F.max("prefix").alias("top"))
    return keys.select("key").join(found, "key", "left")


def _cut_keys(keys: DataFrame, parts: int) -> list[bytes]:
    """At most ``parts - 1`` keys that cut the sorted keys evenly: the keys of smallest hash are a fair sample."""
    sample = sorted(bytes(k) for k in hash_sample(keys, ["key"], F.col("key"), parts * SAMPLE_PER_PART, keys.count()))
    return sorted({sample[i * len(sample) // parts] for i in range(1, parts)}) if sample else []


def longest_rules(keys: DataFrame, rules: DataFrame, lengths: list[int], parts: int) -> DataFrame:
    """``(key, top)`` of all distinct ``keys``: the longest rule key that is a prefix of each, by the sweep.

    ``lengths``: the distinct lengths of the rule keys, ascending."""
    cuts = _cut_keys(keys, parts)
    spark = keys.sparkSession
    below = _innermost(rules, rules, lengths, proper=True)
    starts = rules.select("key", F.lit(0).alias("kind"), F.col("key").alias("top"))
    ends = below.select(F.concat("key", F.lit(_END)).alias("key"), F.lit(1).alias("kind"), F.coalesce("top", F.lit(b"")).alias("top"))
    points = keys.select("key", F.lit(2).alias("kind"), F.lit(None).cast("binary").alias("top"))
    rows = starts.unionByName(ends).unionByName(points).withColumn("part", range_bucket(F.col("key"), cuts))
    if cuts:
        first = spark.createDataFrame([(bytearray(c),) for c in cuts], "key binary")
        opening = _innermost(first, rules, lengths, proper=False).select(
            "key", F.lit(-1).alias("kind"), F.coalesce("top", F.lit(b"")).alias("top"), range_bucket(F.col("key"), cuts).alias("part"))
        rows = rows.unionByName(opening)
    sweep = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (rows.withColumn("top", F.last("top", ignorenulls=True).over(sweep)).where("kind = 2")
            .select("key", F.when(F.octet_length("top") > 0, F.col("top")).alias("top")))


def judged(pages: DataFrame, rules: DataFrame, default: str = DEFAULT, parts: int | None = None) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of every page; ``rules(host, path, verdict)``."""
    spark = pages.sparkSession
    parts = parts or 4 * shuffle_partitions(spark)
    host, path = parts_of(pages["url"].cast("string"))
    pages = pages.select("page_id", host.alias("host"), path.alias("path"))
    rules = (rules.groupBy("host", "path").agg(F.min("verdict").alias("verdict"))
             .withColumn("key", key_of(F.col("host"), F.col("path"))).withColumn("rule", F.concat("host", "path")))
    lengths = sorted(r[0] for r in rules.select(F.octet_length("key")).distinct().collect())
    if not lengths:
        return pages.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    # A suffix or key is of interest as far as the longest rule key reaches, and one byte more: beyond, neither a rule's
    # start nor its end can differ.  So a url costs the rules' lengths, however long it is.
    reach = lengths[-1] + 1
    places = pages.select("host", "path").distinct()
    tail = F.right("host", F.lit(reach))
    labels = F.split(tail, r"\.")
    whole = F.when(F.length("host") > reach, 2).otherwise(1)  # (the first label of a cut host is a part of one)
    suffix = F.explode(F.transform(F.filter(F.sequence(F.lit(1), F.size(labels)), lambda i: i >= whole), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    keys = (places.withColumn("suffix", suffix)
            .select("host", "path", F.octet_length("suffix").alias("__size"),
                    F.substring(key_of(F.col("suffix"), F.left("path", F.lit(reach))), F.lit(1), F.lit(reach)).alias("key")))
    tops = longest_rules(keys.select("key").distinct(), rules.select("key"), lengths, parts).where("top is not null")
    # (urls whose keys begin alike share a cut key: dealt over salts)
    keys = keys.withColumn("__salt", F.pmod(F.xxhash64("host", "path"), F.lit(SALTS)))
    tops = tops.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    best = (keys.join(tops, ["key", "__salt"]).groupBy("host", "path").agg(F.max_by("top", "__size").alias("key"))
            .join(rules.select("key", "rule", "verdict"), "key").drop("key"))
    return (pages.join(best, ["host", "path"], "left")
            .select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")))
