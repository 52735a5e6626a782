"""Exact deduplication by content sort.

Normalised texts (A-Z lower-cased, nothing else) are range-partitioned by sampled splitters, Spark's external sort puts
equal texts side by side, and the window over the sorted run compares each row's whole text with its neighbour's.
Range keys are short, as the driver sees the sampled ones: a text's first 32 characters, then its 64-bit hash for texts that begin alike, and last
a salt from doc_id, which cuts a text with very many copies over several partitions; what each run found is then summed
by the text's SHA-256. The texts themselves are shuffled once.

Defined results: a null text counts as empty, and empty texts equal each other. Null doc_ids come after all others; where all
of a group are null, keep_id is null and one row stays. Of rows that repeat a doc_id and text, one stays: the one whose columns hash least, so reruns agree.
Texts of any length are compared whole. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import free_name, store, table, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(column: str = "text"):
    return F.translate(text_of(column), UPPER, LOWER)


def exact_dedup(docs: DataFrame, salts: int = 64) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, keep_id, group_size, kept, text_sha256. Of equal texts the row with the largest doc_id stays."""
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(salts))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised().alias("body")).withColumn("salt", salt)
    rows = rows.withColumn("head", F.substring("body", 1, 32)).withColumn("digest", F.xxhash64("body"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    runs = rows.repartitionByRange(parts, "head", "digest", "salt")
    same = Window.partitionBy("head", "digest", "body", "salt")
    runs = runs.withColumn("place", F.row_number().over(same.orderBy(F.col("doc_id").desc_nulls_last())))
    runs = runs.withColumn("run_size", F.count(F.lit(1)).over(same))
    found = store(runs.select("doc_id", "salt", "place", "run_size", F.sha2(F.encode("body", "UTF-8"), 256).alias("text_sha256")), "content-runs")
    # One row for each run; what a text's runs sum to goes back to each run, and from there to its rows.
    first = found.filter("place = 1")
    groups = first.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.sum("run_size").alias("group_size"))
    groups = first.select("text_sha256", "salt").join(groups, "text_sha256")
    kept = (F.col("place") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))
    return found.join(groups, ["text_sha256", "salt"]).select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def drop_exact_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, with all their columns."""
    key = lambda sha: F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), sha)
    name, place = free_name(docs, "stay_key"), free_name(docs, "stay_place")
    stay = exact_dedup(docs).filter("kept").select(key(F.col("text_sha256")).alias(name))
    marked = docs.withColumn(name, key(F.sha2(F.encode(normalised(), "UTF-8"), 256)))
    plain = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]
    first = F.row_number().over(Window.partitionBy(name).orderBy(F.xxhash64(*plain), "text"))
    out = marked.join(stay, name, "left_semi").withColumn(place, first)
    return out.filter(F.col(place) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256 FROM d
"""
