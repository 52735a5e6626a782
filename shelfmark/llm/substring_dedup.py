"""Substring deduplication by relative Lempel-Ziv parsing.

Every document is parsed against an index of reference blocks that covers the text of all documents. A block is a run of
50 words; the index holds it at its first occurrence: the smallest doc_id in which it starts, and its first place there. The parse is greedy: a factor begins
at the first word whose block occurs in an earlier document and goes on as long as each next block is the reference's next one, that is, one word further in the same
document; so a factor is a run of 50 words or more that the source has too, the longest from that reference place. Blocks that begin inside a factor but
reach past its end are checked at that boundary, so no repeated run of 50 words is missed where two factors meet.

The index stays small without losing a block: each block names its *anchor*, the least hash of its runs of `ANCHOR` words.
Equal blocks have equal anchors, so only blocks whose anchor occurs in two documents or more are indexed. A block is known by 96 bits of two hashes over
64-bit hashes of its words; words themselves aren't compared again.
Documents with the same words are parsed once: a later copy of 50 words or more is one factor. Counts are summed before
each shuffle, pairs of documents are never formed, and hot keys meet in joins that adaptive execution can split. Texts meet what was found in them by doc_id and
a hash of the text, so many rows of one doc_id cost what as many documents cost.

Defined results: null or empty texts have no words and an empty kept text. Null doc_ids come after all others and are no source
for each other. Rows that repeat a doc_id are no source for each other either. A text of one repeated word has one factor for each place. Texts of any length are
hashed in pieces and parsed whole, one at a time. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, store, table
from .hashing import runs, sequence_hash, sliding_min, word_hashes

WINDOW, ANCHOR = 50, 12
_SALT = 0x5851F42D4C957F2D
#: Stands for a null doc_id: after all others.
_LAST = 2**63 - 1


def _block_anchors(words: np.ndarray, window: int, anchor: int) -> np.ndarray:
    return sliding_min(runs(words, anchor), window - anchor + 1).view(np.int64)


def _profile(window: int, anchor: int):
    def profile(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, row, text in zip(batch["doc"], batch["row"], batch["text"], strict=True):
                words = word_hashes(text)
                anchors = np.unique(_block_anchors(words, window, anchor)) if len(words) >= window else []
                whole = sha256(b" ".join((text or "").encode("utf-8", "surrogatepass").split())).hexdigest()
                rows.append((doc, row, len(words), sequence_hash(words), sequence_hash(words, _SALT), whole, anchors))
            yield pd.DataFrame(rows, columns=["doc", "row", "n_words", "key", "key2", "whole_sha256", "anchors"])

    return profile


def _blocks(window: int, anchor: int):
    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for doc, row, text, shared in zip(batch["doc"], batch["row"], batch["text"], batch["shared"], strict=True):
                words = word_hashes(text)
                at = np.flatnonzero(np.isin(_block_anchors(words, window, anchor), shared))
                if at.size:
                    first, second = runs(words, window)[at], runs(words, window, _SALT)[at]
                    yield pd.DataFrame({"block": first.view(np.int64), "block2": (second >> np.uint64(32)).astype(np.uint32).view(np.int32), "doc": doc, "row": row, "at": at.astype(np.int32)})

    return blocks


def parse(starts: np.ndarray, sources: np.ndarray, places: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """Greedy factors (first word, length, source, place in the source) over the blocks that occur in an earlier document, sorted by start.

    A factor goes on while the next block is the next one of its source. A block that begins within the last factor and reaches past its end is a
    boundary case: it begins a factor of its own.
    """
    factors: list[tuple[int, int, int, int]] = []
    covered, i = 0, 0
    while i < len(starts):
        j = i
        while j + 1 < len(starts) and starts[j + 1] == starts[j] + 1 and sources[j + 1] == sources[i] and places[j + 1] == places[j] + 1:
            j += 1
        end = int(starts[j]) + window
        if end > covered:
            factors.append((int(starts[i]), end - int(starts[i]), int(sources[i]), int(places[i])))
            covered = end
        i = j + 1
    return factors


def _remove(window: int):
    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc, row, text, found in zip(batch["doc"], batch["row"], batch["text"], batch["found"], strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                found = sorted((x["at"], x["source"], x["place"]) for x in found)
                factors = parse(*(np.array(x, np.int64) for x in zip(*found, strict=True)), window)
                keep = np.ones(len(words), bool)
                for start, length, *_ in factors:
                    keep[start : start + length] = False
                kept = b" ".join(w for w, k in zip(words, keep, strict=True) if k)
                told = [{"start": a, "length": b, "source": c, "place": d} for a, b, c, d in factors]
                rows.append((doc, row, int((~keep).sum()), sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass"), told))
            yield pd.DataFrame(rows, columns=["doc", "row", "n_removed", "kept_sha256", "kept_text", "factors"])

    return remove


_FACTORS = "array<struct<start:int,length:int,source:long,place:int>>"


def parsed(docs: DataFrame, window: int, anchor: int) -> tuple[DataFrame, DataFrame]:
    """The profile of each row with the first document of the same words; and n_removed, kept_sha256, kept_text and factors by (doc, key) where something is removed."""
    spark = docs.sparkSession
    small_batches(spark, 500)
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"), F.col("text").cast("string").alias("text")).withColumn("row", F.xxhash64("text"))
    profile = store(rows.mapInPandas(_profile(window, anchor), "doc long, row long, n_words long, key long, key2 long, whole_sha256 string, anchors array<long>"), "profiles")
    # Sums are written, so that the joins with them shuffle both sides for themselves and a hot key can be split.
    firsts = store(profile.groupBy("key", "key2").agg(F.min("doc").alias("first_doc")), "first-documents")
    marked = profile.drop("anchors").join(firsts, ["key", "key2"])

    # Anchors that documents of different words share; a copy adds nothing to its first.
    anchors = profile.filter("n_words >= %d" % window).groupBy("key", "key2").agg(F.min(F.struct("doc", "row")).alias("own"), F.first("anchors").alias("anchors"))
    anchors = store(anchors.select("key", F.col("own.doc").alias("doc"), F.col("own.row").alias("row"), F.explode("anchors").alias("anchor")), "anchors")
    shared = anchors.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).filter("low < high").select("anchor")
    shared = store(shared, "shared-anchors")
    shared = store(anchors.join(shared, "anchor").groupBy("doc", "row", "key").agg(F.collect_list("anchor").alias("shared")), "anchored")

    texted = rows.join(shared.drop("key"), ["doc", "row"]).select("doc", "row", "text", "shared")
    blocks = store(texted.mapInPandas(_blocks(window, anchor), "block long, block2 int, doc long, row long, at int"), "blocks")
    sources = blocks.groupBy("block", "block2").agg(F.min(F.struct("doc", "at")).alias("first"), F.max("doc").alias("high")).filter("first.doc < high")
    sources = store(sources.select("block", "block2", F.col("first.doc").alias("source"), F.col("first.at").alias("place")), "sources")
    found = blocks.join(sources, ["block", "block2"]).filter("source < doc")
    found = found.groupBy("doc", "row").agg(F.collect_set(F.struct("at", "source", "place")).alias("found"))

    cut = rows.join(found, ["doc", "row"]).mapInPandas(_remove(window), f"doc long, row long, n_removed long, kept_sha256 string, kept_text string, factors {_FACTORS}")
    return marked, cut.dropDuplicates(["doc", "row"]).join(shared.select("doc", "row", "key"), ["doc", "row"]).drop("row")


def substring_dedup(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, n_words, n_removed, kept_sha256, factors (start, length, source: the document that first has it, place: where there)."""
    marked, cut = parsed(docs, window, anchor)
    empty = sha256(b"").hexdigest()
    copy = (F.col("first_doc") < F.col("doc")) & (F.col("n_words") >= window)
    none = F.array().cast(_FACTORS)
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_words").cast("int").alias("length"), F.col("first_doc").alias("source"), F.lit(0).alias("place")))
    rows = marked.join(cut.drop("kept_text"), ["doc", "key"], "left")
    return rows.select(
        F.when(F.col("doc") != _LAST, F.col("doc")).alias("doc_id"),
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(empty)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
        F.when(copy, whole).otherwise(F.coalesce("factors", none)).alias("factors"),
    )


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


#: Every window of 50 words by brute force.
OP7_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(doc_id, 9223372036854775807) AS rank,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS w FROM documents),
s AS (SELECT r, rank, unnest(generate_series(1, len(w) - 49)) AS i, unnest(list_transform(generate_series(1, len(w) - 49), lambda k: md5(array_to_string(w[k:k + 49], ' ')))) AS h FROM d WHERE len(w) >= 50),
hit AS (SELECT r, i FROM (SELECT r, i, rank, min(rank) OVER (PARTITION BY h) AS first FROM s) WHERE first < rank),
gone AS (SELECT DISTINCT r, unnest(generate_series(i, i + 49)) AS j FROM hit),
words AS (SELECT r, unnest(generate_series(1, len(w))) AS j, unnest(w) AS word FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS t FROM words ANTI JOIN gone USING (r, j) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)
"""
