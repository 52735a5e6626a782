"""Candidate pairs of flyer and master rows, combined scores, and the best candidates of each description.

Every feature of a pair's boost is an equality of keys, so a pair without a common key has a boost of 0. `candidate_pairs` therefore joins key frames of
(kind, key, row id) and counts under which kinds a pair meets, which is its boost: nothing of a text is compared again.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions import text as tx
from shelfmark.sources.work import store

#: Which kinds of keys each feature of the boost counts.
FEATURES = {"devowel": ("devowel",), "upper": ("cut", "whole"), "first": ("first",), "word": ("word",)}
#: Bytes of flyer keys, with 40 for the rest of each row, up to which they are broadcast; beyond, both sides are shuffled by key.
BROADCAST_BYTES = 50_000_000
SCORES = ("Description_Similarity", "Ncat_Description_Similarity", "Brand_Description_Similarity", "Boost_Score", "Brand_Word_Score", "ncat_word_score")


def _key(kind: str, keys: Column) -> Column:
    """The distinct keys of a kind; empty ones can't meet."""
    return F.transform(F.array_distinct(F.filter(keys, lambda k: k != "")), lambda k: F.struct(F.lit(kind).alias("kind"), k.alias("key")))


def flyer_key_array(text: Column) -> Column:
    """All (kind, key) under which a flyer description can meet a master text."""
    f = tx.flyer_features(text)
    capitals = F.coalesce(f["capitals"], F.lit(""))
    # The capitals cut to any length, which meet first words of that length, and all of them, which meet longer first words.
    cut = F.when(capitals != "", F.transform(F.sequence(F.lit(1), F.length(capitals)), lambda n: F.left(capitals, n))).otherwise(F.array().cast("array<string>"))
    whole = F.when(f["capitals"].isNotNull(), F.array(F.concat(F.lit("="), capitals))).otherwise(F.array(F.lit("-")))
    return F.concat(_key("devowel", F.array(f["prefix"])), _key("cut", cut), _key("whole", whole), _key("first", F.array(f["first"])), _key("word", f["words"]))


def master_key_array(text: Column) -> Column:
    """All (kind, key) under which a master text can meet a flyer description."""
    m = tx.master_features(text)
    letters = F.rtrim(m["abbreviation"], F.lit("_"))
    none = F.array().cast("array<string>")
    full = (m["n"] > 0) & (F.length(letters) == m["n"])
    # A blank text has the capitals of a flyer text without any, and of a blank one.
    whole = F.when(full, none).when(m["n"] > 0, F.array(F.concat(F.lit("="), letters))).otherwise(F.array(F.lit("="), F.lit("-")))
    return F.concat(_key("devowel", F.array(m["prefix"])), _key("cut", F.when(full, F.array(letters)).otherwise(none)), _key("whole", whole), _key("first", F.array(m["first"])), _key("word", m["words"]))


def flyer_keys(flyer: DataFrame) -> DataFrame:
    """kind, key, flyer_row of the descriptions."""
    return flyer.select("flyer_row", F.inline(flyer_key_array(F.col("Description"))))


def master_keys(master: DataFrame) -> DataFrame:
    """field, kind, key, master_row of the descriptions (field 0), and of the brands (field 1) where there are any."""
    fields = [c for c in ("Description", "BRAND") if c in master.columns]
    each = [master.select("master_row", F.lit(i).alias("field"), F.inline(master_key_array(F.col(c)))) for i, c in enumerate(fields)]
    return functools.reduce(DataFrame.union, each)


def candidate_pairs(flyer: DataFrame, master: DataFrame, threshold: float | None = 0.2, weights: dict[str, float] | None = None) -> DataFrame:
    """flyer_row, master_row, PDF_Description, Excel_Description, Excel_BRAND, Boost_Score for the pairs whose boost reaches the threshold.

    Needs flyer_row and master_row as unique ids. Without a positive threshold every pair is a candidate.
    """
    brands = ["BRAND"] if "BRAND" in master.columns else []
    f = flyer.select("flyer_row", F.col("Description").alias("PDF_Description"))
    m = master.select("master_row", *[F.col(c).alias(f"Excel_{c}") for c in ("Description", *brands)])
    if threshold is None or threshold <= 0:
        f = store(f.withColumn("__f", tx.flyer_features(F.col("PDF_Description"))), "flyer-features")
        m = store(m.withColumns({f"__{c}": tx.master_features(F.col(f"Excel_{c}")) for c in ("Description", *brands)}), "master-features")
        boosts = [tx.featured_boost(F.col("__f"), F.col(f"__{c}"), weights) for c in ("Description", *brands)]
        return f.crossJoin(m).withColumn("Boost_Score", sum(boosts[1:], boosts[0])).select("flyer_row", "master_row", "PDF_Description", *[f"Excel_{c}" for c in ("Description", *brands)], "Boost_Score")
    left = store(flyer_keys(flyer), "flyer-keys")
    # By row, so that the pairs of a row meet in one task: with the flyer's keys broadcast, pairs are counted where they arise and never shuffled.
    right = master_keys(master).repartition(int(master.sparkSession.conf.get("spark.sql.shuffle.partitions")), "master_row")
    if (left.agg(F.sum(F.octet_length("key") + 40)).first()[0] or 0) <= BROADCAST_BYTES:
        left = F.broadcast(left)
    counts = [F.count_if((F.col("field") == i) & F.col("kind").isin(*kinds)).cast("int").alias(f"{k}_{i}") for i in range(1 + len(brands)) for k, kinds in FEATURES.items()]
    found = right.join(left, ["kind", "key"]).groupBy("flyer_row", "master_row").agg(*counts)
    boosts = [tx.weighted({k: F.col(f"{k}_{i}") for k in FEATURES}, weights) for i in range(1 + len(brands))]
    found = found.select("flyer_row", "master_row", sum(boosts[1:], boosts[0]).alias("Boost_Score")).filter(F.col("Boost_Score") >= threshold - 1e-9)
    out = found.join(f, "flyer_row").join(m, "master_row")
    return out.select("flyer_row", "master_row", "PDF_Description", *[f"Excel_{c}" for c in ("Description", *brands)], "Boost_Score")


def combined_score(df: DataFrame) -> DataFrame:
    """The sum of the six scores; absent ones count as 0."""
    parts = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in SCORES if c in df.columns]
    return df.withColumn("total_Combined_Score", sum(parts[1:], parts[0]) if parts else F.lit(0.0))


def min_max_scale(df: DataFrame, column: str, to: str = "Combined_Score") -> DataFrame:
    """(x - min) / (max - min) over all rows; 0 where all are equal. The two bounds are one row."""
    ends = df.agg(F.min(column).alias("__low"), F.max(column).alias("__high"))
    scaled = F.when(F.col("__high") > F.col("__low"), (F.col(column) - F.col("__low")) / (F.col("__high") - F.col("__low"))).otherwise(0.0)
    return df.crossJoin(F.broadcast(ends)).withColumn(to, scaled).drop("__low", "__high")


def top_k_per_key(df: DataFrame, key: str = "PDF_Description", score: str = "total_Combined_Score", k: int = 65, ids: tuple[str, ...] = ("flyer_row", "master_row")) -> DataFrame:
    """The k best rows of each key; ties go by the row ids."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.col(score).desc(), *ids))
    return df.withColumn("__place", place).filter(F.col("__place") <= k).drop("__place")
