"""URL filter by host and path rules: a sort-merge range join, native only.

Hosts become keys of reversed labels (``www.example.com`` ->
``com|example|www|``), so a host with all its subdomains is one interval of
keys, and the intervals of the rules nest. The borders of these intervals,
each with the stack of the rules active right after it, are sorted together
with the pages; a running "last border seen" hands every page its stack. The
path and length tests then pick the longest fitting rule.

Pages are dealt by a hash into ``lanes`` (no host is ever a partition key, so
a host with a third of all pages is spread evenly); the borders, two a rule,
are repeated in every lane.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import shuffle_width

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
RULE_TYPE = "struct<host:string,path:string,verdict:string>"


def url_host(url: Column) -> Column:
    """Text after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def _labels(host: Column) -> Column:
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.reverse(F.split(host, r"\.")))


def _key(labels: Column) -> Column:
    """Label bytes, each label ended by 0x01: no host's key is a prefix of
    another's unless it is a parent domain."""
    return F.encode(F.concat_ws("", F.transform(labels, lambda x: F.concat(x, F.lit("\x01")))), "UTF-8")


def borders(rules: DataFrame) -> DataFrame:
    """(key, stack): where a rule host's interval begins or ends, and the
    rules active from there on. A parent's rules are found by an equality
    join on the key of each ancestor host."""
    host = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER)
    own = (rules.where("verdict is not null")
           .select(host.alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict").distinct())
    own = own.withColumn("labels", _labels(F.col("host"))).withColumn("key", _key(F.col("labels")))
    level = (own.select("key", "labels").distinct()
             .select("key", F.explode(F.sequence(F.lit(0), F.size("labels"))).alias("depth"), "labels")
             .select("key", _key(F.slice("labels", F.lit(1), F.col("depth"))).alias("above")))
    held = own.select(F.col("key").alias("above"), F.struct("host", "path", "verdict").alias("rule"))
    active = level.join(held, "above")
    stack = F.collect_list("rule").cast(f"array<{RULE_TYPE}>")
    begins = active.groupBy("key").agg(stack.alias("stack"))
    left = F.collect_list(F.when(F.col("above") != F.col("key"), F.col("rule"))).cast(f"array<{RULE_TYPE}>")
    ends = active.groupBy("key").agg(left.alias("stack")).select(F.concat("key", F.unhex(F.lit("FF"))).alias("key"), "stack")
    return begins.unionByName(ends)


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow",
               lanes: int | None = None) -> DataFrame:
    """All columns of ``pages`` in struct ``page``, with host, path, rule and
    verdict.

    ``rules``: host, path, verdict. A rule fits its host and all subdomains
    where the url's path starts with the rule's path; the longest host + path
    wins, then the longer host, then the greater verdict text. A host '' fits
    every url. ``rule`` is host + path, null where none fits; the verdict is
    then ``default``. Null or malformed urls have an empty host and path.
    Repeated rows stay; empty tables give an empty result; input columns may
    have any name."""
    lanes = lanes or 2 * shuffle_width(pages.sparkSession)
    dealt = pages.select(F.struct("*").alias("page"), F.col(url).alias("_url"))
    dealt = dealt.select("page", url_host(F.col("_url")).alias("host"), url_path(F.col("_url")).alias("path"),
                         F.pmod(F.xxhash64(F.to_json("page")), F.lit(lanes)).cast("int").alias("lane"))
    dealt = dealt.withColumn("key", _key(_labels(F.col("host")))).withColumn("kind", F.lit(1))
    marks = borders(rules).select("key", "stack", F.lit(0).alias("kind"),
                                  F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane"))
    swept = dealt.unionByName(marks, allowMissingColumns=True).withColumn(
        "stack", F.last("stack", ignorenulls=True).over(
            Window.partitionBy("lane").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)))
    stack = F.coalesce("stack", F.array().cast(f"array<{RULE_TYPE}>"))  # null before the first border
    fits = F.filter(stack, lambda r: F.startswith(F.col("path"), r["path"]))
    best = F.array_max(F.transform(fits, lambda r: F.struct(
        F.length(F.concat(r["host"], r["path"])).alias("n"), F.length(r["host"]).alias("h"),
        r["verdict"].alias("verdict"), F.concat(r["host"], r["path"]).alias("rule"))))
    return (swept.where("kind = 1").withColumn("best", best)
            .select("page", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce("best.verdict", F.lit(default)).alias("verdict")))
