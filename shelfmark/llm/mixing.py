"""Mixing sources to target weights by a low-discrepancy schedule.

Slot k of the mix takes a block of equally many words (`ordered` is the mix in slot order, `mixed` what it takes of each document). The golden-ratio point of k, read in the cumulated target shares, names
the slot's source; the slots of a source are ranked in order, and rank r takes block r of that source's shuffled word stream, which
is laid end to end up to three times. Sources are summed first and their targets found over one row a source. Long ranks and running sums are computed in two levels (chunk totals first), so a
source with a third of all rows is not one task's work.

Defined results: a null text has no words and takes none. Null sources form one source, the last. Rows that repeat a doc_id are documents of
their own, with the same place in the shuffle; ties follow size. A source without words has target 0. Without any words nothing is taken.
Words of texts of any length are counted whole. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import by_part, n_words_of, range_parts, store, table, text_of

BLOCK_WORDS, MOST_REPEATS = 32, 3
#: The golden ratio's fraction in 32 bits, and the period kept so that products fit a long.
GOLDEN, PERIOD = 2654435769, 2**31


def golden_point(k: Column) -> Column:
    """The k-th point of the golden-ratio sequence in [0, 1)."""
    return F.pmod((k % PERIOD + 1) * F.lit(GOLDEN), F.lit(2**32)) / F.lit(float(2**32))


def _running(rows: DataFrame, name: str, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """`rows` with each sum's total over the rows before, in order: within ranges, after the sums of the ranges before. Only one row a range is ordered as a whole."""
    ranges, n = range_parts(rows, name, *order)
    each = ranges.groupBy("part").agg(*[F.sum(v).alias(f"{k}_of") for k, v in sums.items()])
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    each = each.select("part", *[F.coalesce(F.sum(f"{k}_of").over(before), F.lit(0)).alias(f"{k}_base") for k in sums])
    within = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = by_part(ranges, n).withColumns({k: F.coalesce(F.sum(v).over(within), F.lit(0)) for k, v in sums.items()})
    out = out.join(F.broadcast(each), "part").withColumns({k: F.col(k) + F.col(f"{k}_base") for k in sums})
    return out.drop("part", *[f"{k}_base" for k in sums])


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST_REPEATS) -> DataFrame:
    """source, source_size -> with target and the interval [low, high) of its share.

    All sizes are shared out by weight; a source stops at `most` times its size and what is over goes to the others by weight. Sorted by
    how soon they fill, the full sources are a prefix, so one pass of running sums finds the level of the rest. Sources are ranked and summed in ranges, so they may be as many as hosts or paths are.
    """
    n, one = len(weights), F.lit(1)
    by_source = [F.col("source").asc_nulls_last()]
    ranked = _running(sizes, "sources", by_source, {"place": one})
    rows = ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % n + 1).cast("int"))).drop("place")
    rows = rows.withColumn("full", F.col("source_size") * float(most))
    total, all_weights = rows.agg(F.coalesce(F.sum("source_size"), F.lit(0)).cast("double"), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    rows = _running(rows, "filling", [F.col("full") / F.col("weight"), *by_source], {"filled": F.col("full"), "weighed": F.col("weight")})
    # Sources that the level at their own place would overfill are full; the first that it doesn't sets the level for all the rest.
    rows = rows.withColumn("level", (F.lit(total) - F.col("filled")) / (F.lit(all_weights) - F.col("weighed")))
    rows = store(rows.withColumn("is_full", F.col("full") <= F.col("level") * F.col("weight")), "levels")
    # Of sources that fill equally soon, the first has the highest level.
    first = rows.filter("NOT is_full").agg(F.min(F.struct((F.col("full") / F.col("weight")).alias("soon"), (-F.col("level")).alias("less"))).alias("first")).first()["first"]
    level = F.lit(-first["less"] if first else 0.0)
    rows = rows.withColumn("target", F.when(F.col("is_full"), F.col("full")).otherwise(F.least("full", F.col("weight") * level)))
    rows = _running(rows.select("source", "source_size", "target"), "shares", by_source, {"before": F.col("target")})
    whole = F.lit(rows.agg(F.sum("target")).first()[0] or 0.0)
    rows = rows.withColumn("low", F.coalesce(F.try_divide("before", whole), F.lit(0.0))).withColumn("high", F.try_divide(F.col("before") + F.col("target"), whole))
    return rows.select("source", "source_size", "target", "low", "high", F.lit(total).alias("total"))


def schedule(goals: DataFrame, block_words: int = BLOCK_WORDS, chunk: int = 1 << 16) -> DataFrame:
    """slot, source, rank: which source's which block goes where in the mix."""
    spark = goals.sparkSession
    total = goals.agg(F.max("total")).first()[0] or 0.0
    slots = spark.range(int(-(-total // block_words))).withColumn("point", golden_point(F.col("id")))
    slots = slots.withColumn("chunk", F.floor(F.col("id") / chunk))
    # A source finds its slots by the share it holds: cells of equal width are the equi-join key of the interval join.
    cells = 1024
    spans = goals.filter("high > low").withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") * cells), F.least(F.floor(F.col("high") * cells), F.lit(cells - 1)).cast("long"))))
    spans = spans.withColumn("high", F.when(F.col("high") >= 1 - 1e-12, F.lit(2.0)).otherwise(F.col("high"))).select("source", "low", "high", "cell")
    slots = slots.withColumn("cell", F.floor(F.col("point") * cells)).join(spans, "cell").filter("point >= low and point < high").select("id", "chunk", "source")
    counts = slots.groupBy("source", "chunk").agg(F.count(F.lit(1)).alias("n"))
    run = Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("source").alias("s"), F.col("chunk").alias("c"), F.coalesce(F.sum("n").over(run), F.lit(0)).alias("base"))
    placed = slots.withColumn("place", F.row_number().over(Window.partitionBy("source", "chunk").orderBy("id")) - 1)
    placed = placed.join(counts, F.col("source").eqNullSafe(F.col("s")) & (F.col("chunk") == F.col("c")))
    return placed.select(F.col("id").alias("slot"), "source", (F.col("base") + F.col("place")).alias("rank"))


def streams(docs: DataFrame, seed: str = "mix", buckets: int = 256) -> DataFrame:
    """doc_id, source, size, source_size and `begin`: the document's first place in its source's shuffled stream of words."""
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words_of(text_of()).alias("size")).withColumn("key", key)
    rows = store(rows.withColumn("bucket", F.conv(F.substring("key", 1, 2), 16, 10).cast("int")), "stream")
    totals = rows.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    run = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(run), F.lit(0)).alias("base"), F.sum("n").over(Window.partitionBy("source")).alias("source_size"))
    within = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ahead", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(totals, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    return rows.select("doc_id", "source", "size", "source_size", (F.col("base") + F.col("ahead")).alias("begin"))


def blocks(stream: DataFrame, block_words: int = BLOCK_WORDS, most: int = MOST_REPEATS) -> DataFrame:
    """source, rank, begin, words: the words that each document gives to each block of its source's stream, which repeats `most` times."""
    rows = stream.filter("size > 0").withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    rows = rows.withColumn("from", F.col("round") * F.col("source_size") + F.col("begin")).withColumn("to", F.col("from") + F.col("size"))
    first, last = F.floor(F.col("from") / block_words), F.floor((F.col("to") - 1) / block_words)
    rows = rows.withColumn("rank", F.explode(F.sequence(first, last)))
    words = F.least(F.col("to"), (F.col("rank") + 1) * block_words) - F.greatest(F.col("from"), F.col("rank") * block_words)
    return rows.select("source", "rank", "begin", "doc_id", "round", words.alias("words"))


def _slotted(stream: DataFrame, goals: DataFrame, block_words: int) -> DataFrame:
    slots = schedule(goals, block_words).select("slot", F.col("source").alias("s"), F.col("rank").alias("r"))
    given = blocks(stream, block_words)
    return given.join(slots, given["source"].eqNullSafe(F.col("s")) & (F.col("rank") == F.col("r"))).drop("s", "r")


def ordered(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix: slot, source, rank, begin, doc_id, round, words. Read by slot, then round and begin; `round` is which reading of its source a block belongs to."""
    stream = store(streams(docs), "streams")
    return _slotted(stream, store(targets(stream.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets"), block_words)


def mixed(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, size, source_size, target, taken for each row of `docs`: the schedule's slots joined to the blocks of the sources' streams."""
    stream = store(streams(docs), "streams")
    goals = store(targets(stream.groupBy("source").agg(F.sum("size").alias("source_size"))), "targets")
    taken = _slotted(stream, goals, block_words).groupBy("source", "begin").agg(F.sum("words").alias("got")).withColumnsRenamed({"source": "t", "begin": "at"})
    goals = goals.select(F.col("source").alias("s"), "target")
    rows = stream.join(taken, stream["source"].eqNullSafe(F.col("t")) & (F.col("begin") == F.col("at")), "left")
    rows = rows.join(goals, rows["source"].eqNullSafe(F.col("s")))
    got = F.when(F.col("size") > 0, F.coalesce("got", F.lit(0))).otherwise(0).cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target", got.alias("taken"))


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
