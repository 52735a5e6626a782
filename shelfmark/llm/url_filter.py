"""URL filters by a sort-merge range join, in DataFrame functions only.

A rule (host, path, verdict) fits the urls of its host and of all hosts below it whose path starts with the rule's; of the rules that fit, the longest
(characters of host and path, then of the host) decides.

1. Keys. A host is written label by label from its end, then `#`, then the path: `org.example#/es/`. On one host, the paths that start alike are then one interval of keys,
   from the rule's key up to that key and a byte above all others. As a rule also holds below its host, a url has one key for each end of its host, up to the most labels that any rule has.
   Keys end after as many bytes of path as the longest rule has: what follows can't change which rules the path starts with.
2. Sorted ranges. Urls' keys and both ends of the rules' intervals are range-partitioned together. The url's number is the last sort key, so a url that
   makes up much of the table is spread over several ranges. A rule that opens in one range and closes in a later one is opened again at the start of the ranges between.
3. Sweep. In each range, in key order, an opened rule is pushed and a closed one popped. Intervals nest or are apart, so the stack is as high as openings so far less closings, and what
   stands at a height is the last rule opened at that height: a running sum and the last rule of each height, both window functions, read the stack's top for every url key.
4. The longest of what a url's keys found wins; urls without a rule get the default, `allow`.

Nothing is broadcast by hint, and neither rules nor urls are collected. Defined results: a null url, or one without `://`, has an empty host and path, which only a rule of an empty host
fits. Of rules with equal host and path, `block` wins. Rows that repeat a page_id are judged each; urls of any length are judged whole. An empty table gives an empty one;
without rules all get the default. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, by_part, free_name, range_parts, store, table

#: The rules of `op11`.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
DEFAULT = "allow"
_CLOSE, _OPEN, _URL = 0, 1, 2


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, lower-cased, and path of a url; both empty where it has no `://`."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(url, shape, 1), UPPER, LOWER), F.regexp_extract(url, shape, 2)


def _key(labels: Column, path: Column) -> Column:
    return F.concat(F.encode(F.array_join(labels, "."), "UTF-8"), F.lit("#").cast("binary"), F.encode(path, "UTF-8"))


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _prepared_rules(rules: DataFrame) -> DataFrame:
    """key, rule (length, host_length, rule, verdict) and the rule's number."""
    host, path = F.translate(F.coalesce(F.col("host"), F.lit("")), UPPER, LOWER), F.coalesce(F.col("path"), F.lit(""))
    rows = rules.select(host.alias("host"), path.alias("path"), F.col("verdict")).groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    rule = F.struct(F.length(F.concat("host", "path")).alias("length"), F.length("host").alias("host_length"), F.concat("host", "path").alias("rule"), "verdict")
    rows = rows.select(_key(_labels(F.col("host")), F.col("path")).alias("key"), rule.alias("rule"), F.size(_labels(F.col("host"))).alias("labels"), F.octet_length("path").alias("path_bytes"))
    return store(rows.withColumn("id", F.monotonically_increasing_id()), "rules")


def judged(urls: DataFrame, rules: DataFrame, default: str = DEFAULT, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """The columns `keep` of each row of `urls` (url), with host, path, rule (host and path of the rule that decides, or null) and verdict."""
    host, path = host_and_path(F.col("url"))
    rows = store(urls.select(*keep, host.alias("host"), path.alias("path")).withColumn("id", F.monotonically_increasing_id()), "urls")
    rules = _prepared_rules(rules)
    labels, path_bytes = rules.agg(F.coalesce(F.max("labels"), F.lit(0)), F.coalesce(F.max("path_bytes"), F.lit(0))).first()

    # Keys of urls and ends of rules, in sorted ranges.
    own = rows.select("id", _labels(F.col("host")).alias("labels"), F.substring(F.encode("path", "UTF-8"), 1, path_bytes).alias("path"))
    depth = F.explode(F.sequence(F.lit(1), F.least(F.size("labels"), F.lit(labels)))) if labels else F.explode(F.array().cast("array<int>"))
    own = own.withColumn("depth", depth)
    own = own.select(F.concat(F.encode(F.array_join(F.slice("labels", 1, F.col("depth")), "."), "UTF-8"), F.lit("#").cast("binary"), "path").alias("key"), F.lit(_URL).alias("kind"), "id", F.lit(None).cast(rules.schema["rule"].dataType).alias("rule"))
    opened = rules.select("key", F.lit(_OPEN).alias("kind"), "id", "rule")
    closed = rules.select(F.concat("key", F.unhex(F.lit("FF"))).alias("key"), F.lit(_CLOSE).alias("kind"), "id", "rule")
    events, n = range_parts(own.unionByName(opened).unionByName(closed), "url-ranges", "key", "kind", "id")

    # A rule that is open where a range begins is opened there again, the outermost first.
    opens = events.filter(F.col("kind") == _OPEN).select("id", "rule", F.col("part").alias("from"))
    closes = events.filter(F.col("kind") == _CLOSE).select("id", F.col("part").alias("to"))
    carried = opens.join(closes, "id").filter(F.col("to") > F.col("from"))
    carried = carried.select(F.lit(b"").alias("key"), F.lit(_OPEN).alias("kind"), "id", "rule", F.explode(F.sequence(F.col("from") + 1, F.col("to"))).alias("part"))

    # The sweep.
    order = ("key", "kind", F.col("rule.length"), "id")
    step = F.when(F.col("kind") == _OPEN, 1).when(F.col("kind") == _CLOSE, -1).otherwise(0)
    swept = by_part(events.unionByName(carried), n).withColumn("height", F.sum(step).over(Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))
    at_height = Window.partitionBy("part", "height").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    swept = swept.withColumn("top", F.last(F.when(F.col("kind") == _OPEN, F.col("rule")), ignorenulls=True).over(at_height))
    best = swept.filter((F.col("kind") == _URL) & (F.col("height") > 0)).groupBy("id").agg(F.max("top").alias("top"))
    out = rows.join(best, "id", "left")
    return out.select(*keep, "host", "path", F.col("top.rule").alias("rule"), F.coalesce("top.verdict", F.lit(default)).alias("verdict"))


def drop_blocked(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """The rows of `pages` whose url isn't blocked, with all their columns."""
    name = free_name(pages, "blocked_url")
    blocked = judged(pages.select("url").distinct(), rules, default, keep=("url",)).filter("verdict = 'block'").select(F.col("url").alias(name))
    return pages.join(blocked, pages["url"].eqNullSafe(F.col(name)), "left_anti")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return judged(table(spark, sf_dir, "pages"), rules)


#: Every rule tried on every url.
OP11_SQL = f"""
WITH r(host, path, verdict) AS (VALUES {', '.join(str(r) for r in RULES)}),
u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
b AS (SELECT u.*, (SELECT max({{'n': length(r.host || r.path), 'h': length(r.host), 'rule': r.host || r.path, 'verdict': r.verdict}}) FROM r
  WHERE (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path)) AS best FROM u)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, '{DEFAULT}') AS verdict FROM b
"""
