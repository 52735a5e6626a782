"""Resampling of documents towards a target text, by hashed-feature importance weights and perturbed scores.

1. Features, runs of up to `longest` words, are hashed into `buckets` buckets once a document, in column expressions, and the bucket numbers are written. All documents and all target texts are counted;
   what is gathered for that is one row a bucket, so never more than `buckets` rows.
2. A bucket's gain is its smoothed log ratio in target and corpus, in thousandths. A document's weight is the floored mean of its features' gains, read from the gains as an
   array (numpy over whole Arrow batches of bucket numbers). Its score adds Gumbel noise drawn from doc_id, so the best scores are a sample without
   replacement by weight.
3. Cutoff. Scores are written once. The number to draw is found exactly: the score of the last drawn document by bisection, one count job a step, then among documents
   with just that score the last doc_id, and among rows with both equal the last row number, likewise. No score is sorted to find it.
4. Ranks. Only drawn rows are range-partitioned by score, doc_id and row number; a row's rank is its place in its range after the sizes of those before. Rows that aren't drawn are never shuffled.

Defined results: a null text has no words. Documents of fewer than `least_words` words get weight and score but aren't drawn. A null doc_id is drawn as an empty one and comes last among ties;
rows that repeat a doc_id have the same noise and rank in the order they are read. Empty tables give no rows, an empty target gains by corpus counts alone. Texts of any length
are read whole. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import CRC_TABLE, LOWER, UPPER, by_part, duck_crc32, range_parts, small_batches, store, table, text_of

NOT_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS, LONGEST, LEAST_WORDS, PERCENT, SEED = 10_000, 1, 20, 10, 2024
_LAST = 2**63 - 1


def words(text: Column) -> Column:
    """Runs of a-z, digits and characters beyond ASCII, after A-Z is lower-cased."""
    return F.filter(F.split(F.translate(text, UPPER, LOWER), NOT_WORDS), lambda w: w != "")


def _runs(own: Column, n: int) -> Column:
    """All runs of n consecutive words."""
    if n == 1:
        return own
    starts = F.when(F.size(own) >= n, F.sequence(F.lit(1), F.size(own) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(own, i, n), " "))


def hashed_features(text: Column, longest: int = LONGEST, buckets: int = BUCKETS) -> Column:
    """(n_words, buckets): the bucket of each run of up to `longest` words. The lambda sees the words as a plain value, split once."""
    bucket = lambda w: (F.crc32(F.encode(w, "UTF-8")) % buckets).cast("int")
    each = lambda own: F.struct(F.size(own).cast("long").alias("n_words"), F.flatten(F.array(*[F.transform(_runs(own, n), bucket) for n in range(1, longest + 1)])).alias("buckets"))
    return F.transform(F.array(words(text)), each)[0]


def bucket_counts(rows: DataFrame) -> dict[int, int]:
    """How many features fall into each bucket, over all rows (buckets); one entry a bucket."""
    counts = rows.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    return {r["bucket"]: r["n"] for r in counts.collect()}


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket in thousandths, with one more count in each."""
    all_corpus, all_target = sum(corpus.values()), sum(target.values())
    ratio = lambda b: float((target.get(b, 0) + 1) * (all_corpus + buckets)) / float((corpus.get(b, 0) + 1) * (all_target + buckets))
    return np.array([math.floor(1000 * math.log(ratio(b))) for b in range(buckets)], np.int64)


def weighed(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """`rows` (id, doc_id, n_words, buckets) with n_features and weight in place of the buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("buckets")
            ends = lists.offsets.to_numpy().astype(np.int64)
            sums = np.concatenate([[0], np.cumsum(gain[lists.values.to_numpy()[: ends[-1]]])])
            n = np.diff(ends)
            # Floors go down, as numpy's integer division does.
            weight = np.where(n > 0, (sums[ends[1:]] - sums[ends[:-1]]) // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("doc_id"), batch.column("n_words"), pa.array(n, pa.int64()), pa.array(weight, pa.int64())], names=["id", "doc_id", "n_words", "n_features", "weight"])

    small_batches(rows.sparkSession)
    return rows.mapInArrow(run, "id long, doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from the first 32 bits of a hash of seed and doc_id."""
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((drawn + 0.5) / F.lit(4294967296.0))))


def least_reaching(rows: DataFrame, column: str, k: int) -> tuple[int, int]:
    """The least value v of a long column so that k rows are at or below it, by bisection, and how many rows are below v. Each step is one exact count."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    below = 0
    while low < high:
        middle = (low + high) // 2
        n = rows.filter(F.col(column) <= middle).count()
        if n >= k:
            high = middle
        else:
            low, below = middle + 1, n
    return low, below


def _drawn(scored: DataFrame, k: int) -> Column:
    """The condition that a row (order: score negated, doc, id) is one of the first k."""
    if k == 0:
        return F.lit(False)
    cut, below = least_reaching(scored, "order", k)
    tied = scored.filter(F.col("order") == cut)
    doc, less = least_reaching(tied, "doc", k - below)
    last, _ = least_reaching(tied.filter(F.col("doc") == doc), "id", k - below - less)
    return (F.col("order") < cut) | (F.col("order") == cut) & ((F.col("doc") < doc) | (F.col("doc") == doc) & (F.col("id") <= last))


def resampled(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank (1 for the best drawn; null where not drawn) for each row of `docs`, towards the texts of `target`."""
    features = hashed_features(text_of(), longest, buckets).alias("features")
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), features).select("doc_id", "features.*")
    hashed = store(hashed.withColumn("id", F.monotonically_increasing_id()), "hashed-features")
    wanted = bucket_counts(target.select(features).select("features.buckets"))
    scored = weighed(hashed.select("id", "doc_id", "n_words", "buckets"), gains(bucket_counts(hashed), wanted, buckets))
    scored = scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = store(scored.withColumns({"order": -F.col("score"), "doc": F.coalesce("doc_id", F.lit(_LAST))}), "scores")
    able = scored.filter(F.col("n_words") >= least_words)
    drawn = (F.col("n_words") >= least_words) & _drawn(able, percent * able.count() // 100)

    ranges, n = range_parts(scored.filter(drawn), "drawn", "order", "doc", "id")
    sizes = ranges.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    # One row a range.
    sizes = sizes.select("part", F.coalesce(F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy("order", "doc", "id"))
    ranked = by_part(ranges, n).withColumn("place", place).join(F.broadcast(sizes), "part").withColumn("rank", F.col("before") + F.col("place"))
    columns = ["doc_id", "n_features", "weight", "score"]
    return ranked.select(*columns, "rank").unionByName(scored.filter(~drawn).select(*columns, F.lit(None).cast("long").alias("rank")))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_WORDS = f"list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"
#: Unigrams counted word by word; the draw by a sort of all scores.
OP12_SQL = f"""
WITH {CRC_TABLE},
d AS (SELECT doc_id, {_WORDS} AS ws FROM documents), dw AS (SELECT doc_id, unnest(ws) AS w FROM d), bw AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
h AS (SELECT w, {duck_crc32('w')} % 10000 AS b FROM (SELECT w FROM dw UNION SELECT w FROM bw), crc),
s AS (SELECT b, count(*) AS s FROM dw JOIN h USING (w) GROUP BY b), t AS (SELECT b, count(*) AS t FROM bw JOIN h USING (w) GROUP BY b),
g AS (SELECT b, floor(1000 * ln(((coalesce(t, 0) + 1) * ((SELECT sum(s) FROM s) + 10000))::DOUBLE / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000))::DOUBLE)) AS gain FROM s FULL JOIN t USING (b)),
m AS (SELECT doc_id, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM dw JOIN h USING (w) JOIN g USING (b) GROUP BY doc_id),
x AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, CAST('0x' || sha256('2024:' || doc_id)[1:8] AS BIGINT) AS h FROM d LEFT JOIN m USING (doc_id)),
y AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM x),
z AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_features >= 20) AS n FROM y)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM z
"""
