"""Benchmark decontamination by SimHash windows and multi-index Hamming search, in DataFrame functions only.

A benchmark item of L words is looked for in windows of L words; of a document with fewer words the whole is the one window. Windows and items are multisets of five-word shingles of lower-cased words,
and a document leaks an item if a window has a weighted Jaccard similarity of 0.8 or more to it.

1. Windows. At 0.8 a window of a shingles and an item of b share at least 4/9 (a + b) of them, which is 8/9 of the L - 4 that both have unless the
   document is shorter. Windows of L words are built where as many of their shingles are in some item of L words, whichever; that
   loses nothing and leaves few windows. Which item a window is like isn't known yet.
2. Fingerprints. Each window and item gets a 64-bit SimHash of its weighted shingles.
3. Multi-index blocks. The 64 bits are cut into 5 blocks. Two fingerprints within a Hamming radius of 24 differ in some block by at most 4 bits, so both windows and items are
   listed under every value within 2 bits of each block: an equi-join on (L, block, value) finds all pairs within the radius, and only these are candidates.
   At a similarity of 0.8 the distance is 9.5 +- 2.8 bits, so the radius is 5 standard deviations away; of 300,000 simulated pairs of 5 to 100 shingles at 0.8 none was
   outside it, and the brute-force SQL gives the same rows. Windows of unequal size are nearer at the same similarity.
4. The exact weighted similarity decides.

The item side is broadcast only up to `broadcast_rows` rows of at most 40 bytes (40 MB), else it is shuffled. Documents are never paired with each other.

Defined results: null texts are empty. Items under five words are too short to tell and match nothing; a null item_id is an item of its own. Rows that
repeat a doc_id are searched each by its own text; equal rows count once. Of equal windows the first is reported. Texts of any length are searched whole. Other columns are
ignored, whatever their names. `OP9_SQL` has no windows in documents shorter than an item.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import store, table, text_of, without, words_of

SHINGLE, SIMILAR, RADIUS, BROADCAST_ROWS = 5, 0.8, 24, 1_000_000
#: First bit and width of each block.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))


def shingle_hashes(text: Column) -> Column:
    """A hash for each run of five lower-cased words, in text order."""
    words = F.transform(words_of(F.lower(text)), lambda w: F.xxhash64(w))
    return _runs(words)


def _runs(words: Column) -> Column:
    # A let-binding: the inner lambda sees the words as a plain value, computed once.
    each = lambda w: F.when(F.size(w) >= SHINGLE, F.transform(F.sequence(F.lit(1), F.size(w) - (SHINGLE - 1)), lambda i: F.xxhash64(F.slice(w, i, SHINGLE))))
    return F.coalesce(F.transform(F.array(words), each)[0], F.array().cast("array<bigint>"))


def simhash(shingles: Column) -> Column:
    """64 bits: each is the majority of that bit over all shingles, repeats counted."""
    bits = F.transform(
        F.sequence(F.lit(0), F.lit(63)),
        lambda b: F.aggregate(shingles, F.lit(0), lambda n, h: n + F.when(F.getbit(h, b) == 1, 1).otherwise(-1)) > 0,
    )
    places = F.zip_with(bits, F.array(*[F.lit(1 << b if b < 63 else -(1 << 63)).cast("bigint") for b in range(64)]), lambda on, p: F.when(on, p).otherwise(F.lit(0).cast("bigint")))
    return F.aggregate(places, F.lit(0).cast("bigint"), lambda s, p: s.bitwiseOR(p))


def _block(print_: Column, first: int, width: int) -> Column:
    return F.shiftrightunsigned(print_, first).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))


def _masks(width: int, most: int) -> Column:
    """All masks of at most so many bits, as an array."""
    return F.filter(F.sequence(F.lit(0).cast("bigint"), F.lit((1 << width) - 1).cast("bigint")), lambda m: F.bit_count(m) <= most)


def indexed(print_: Column, most: int) -> Column:
    """(block, value) for every value within `most` bits of each block of a fingerprint."""
    each = lambda b, own, width: F.transform(_masks(width, most), lambda m: F.struct(F.lit(b).alias("block"), own.bitwiseXOR(m).alias("value")))
    return F.flatten(F.array(*[each(b, _block(print_, first, width), width) for b, (first, width) in enumerate(BLOCKS)]))


def weighted_jaccard(a: Column, b: Column) -> Column:
    """Of two multisets given as arrays: the sum of least counts over the sum of greatest counts."""
    count = lambda xs, e: F.size(F.filter(xs, lambda x: x == e))
    common = F.aggregate(F.array_intersect(a, b), F.lit(0), lambda s, e: s + F.least(count(a, e), count(b, e)))
    return common / (F.size(a) + F.size(b) - common)


def item_index(items: DataFrame) -> DataFrame:
    """item_id, length, shingles, print for each item of five words or more."""
    words = F.size(words_of(text_of())).alias("length")
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), words, shingle_hashes(text_of()).alias("shingles"))
    return rows.filter(F.size("shingles") > 0).withColumn("print", simhash(F.col("shingles")))


def contaminated(docs: DataFrame, items: DataFrame, similar: float = SIMILAR, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, row (a hash of the text), item_id, start (first word of the best window, from 0), length (its words), similarity: one row for each row of `docs` and item it leaks."""
    items = store(item_index(items).withColumn("item", F.xxhash64("item_id", "shingles")), "items")
    hint = lambda df, rows: F.broadcast(df) if rows <= broadcast_rows else df
    n_items, n_shingles = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("shingles")), F.lit(0))).first()

    # 1. Where documents have shingles of items of each length.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    row = F.xxhash64("text").alias("row")
    have = items.select("length", F.explode(F.array_distinct("shingles")).alias("shingle")).distinct()
    seen = texts.select("doc_id", row, shingle_hashes(F.col("text")).alias("all"))
    seen = seen.select("doc_id", "row", F.size("all").alias("own"), F.posexplode("all").alias("at", "shingle"))
    hits = seen.join(hint(have, n_shingles), "shingle")
    size = F.col("length") - (SHINGLE - 1)
    need = F.ceil(similar / (1 + similar) * (size + F.least("own", size)) - 1e-9).cast("int")
    at = hits.groupBy("doc_id", "row", "own", "length").agg(F.sort_array(F.collect_set("at")).alias("at")).withColumn("need", need)
    # A window that holds hits i to i + need - 1 starts at the earliest so that it reaches the last of them, at the latest at the first.
    span = lambda i: F.sequence(
        F.greatest(F.lit(0), F.element_at("at", i + F.col("need") - 1) - (F.col("length") - SHINGLE)), F.element_at("at", i)
    )
    fits = lambda i: F.element_at("at", i + F.col("need") - 1) - F.element_at("at", i) <= F.col("length") - SHINGLE
    firsts = F.filter(F.sequence(F.lit(1), F.size("at") - F.col("need") + 1), fits)
    starts = F.array_distinct(F.flatten(F.transform(firsts, span)))
    at = at.filter(F.size("at") >= F.col("need")).select("doc_id", "row", "length", F.explode(starts).alias("start")).distinct()
    places = at.groupBy("doc_id", "row").agg(F.collect_list(F.struct("length", "start")).alias("places"))
    places = store(places.withColumnsRenamed({"doc_id": "d", "row": "r"}), "places")

    # 2. The windows there, and their fingerprints.
    # Of rows that repeat a doc_id and text, one is searched; only texts with places are compared for that.
    rows = texts.withColumn("row", row).join(places, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("row") == F.col("r"))).dropDuplicates(["doc_id", "row"])
    rows = rows.select("doc_id", "row", shingle_hashes(F.col("text")).alias("all"), "places")
    cut = F.transform("places", lambda p: F.struct(p["length"].alias("length"), p["start"].alias("start"), F.slice("all", p["start"] + 1, p["length"] - (SHINGLE - 1)).alias("window")))
    windows = rows.select("doc_id", "row", F.size("all").alias("own"), F.inline(cut)).filter(F.size("window") == F.least("own", size)).drop("own")
    windows = store(windows.withColumn("print", simhash(F.col("window"))), "windows")

    # 3. All pairs of fingerprints within the radius: in some block both are within half of its share of one value.
    half = RADIUS // len(BLOCKS) // 2
    listed = items.select("item", "length", F.col("print").alias("item_print"), F.inline(indexed(F.col("print"), half)))
    probes = windows.select("doc_id", "row", "start", "length", "print", F.inline(indexed(F.col("print"), half)))
    near = probes.join(hint(listed, n_items * sum(comb(w, k) for _, w in BLOCKS for k in range(half + 1))), ["length", "block", "value"])
    near = near.filter(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS).select("doc_id", "row", "start", "length", "item").distinct()

    # 4. The exact similarity.
    near = near.withColumnsRenamed({c: f"{c}_" for c in ("doc_id", "row", "start", "length")})
    same = F.col("doc_id").eqNullSafe(F.col("doc_id_")) & (F.col("row") == F.col("row_")) & (F.col("start") == F.col("start_")) & (F.col("length") == F.col("length_"))
    checked = windows.join(near, same).select("doc_id", "row", "start", "window", "item")
    checked = checked.join(hint(items, n_shingles), "item").withColumn("similarity", weighted_jaccard(F.col("window"), F.col("shingles"))).withColumn("length", F.size("window") + (SHINGLE - 1))
    best = checked.filter(F.col("similarity") >= similar).groupBy("doc_id", "row", "item_id", "item", "length").agg(F.max(F.struct("similarity", -F.col("start"))).alias("best"))
    return best.select("doc_id", "row", "item_id", (-F.col("best.col2")).cast("long").alias("start"), F.col("length").cast("long").alias("length"), F.col("best.similarity").alias("similarity"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` that leak no item, with all their columns."""
    return without(docs, contaminated(docs, items).select("doc_id", "row").distinct())


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "start", "length", F.floor(F.col("similarity") * 1e6 + 0.5).cast("long").alias("similarity_millionths"))


#: Every window that shares a shingle with an item, by brute force.
OP9_SQL = """
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS w FROM benchmark),
ds AS (SELECT doc_id, unnest(generate_series(0, len(w) - 5)) AS p, unnest(list_transform(generate_series(1, len(w) - 4), lambda k: array_to_string(w[k:k+4], ' '))) AS s FROM d WHERE len(w) >= 5),
ish AS (SELECT item_id, len(w) AS l, unnest(list_transform(generate_series(1, len(w) - 4), lambda k: array_to_string(w[k:k+4], ' '))) AS s FROM i WHERE len(w) >= 5),
ic AS (SELECT item_id, l, s, count(*) AS c FROM ish GROUP BY ALL),
hit AS (SELECT doc_id, item_id, l, p, s, c FROM ds JOIN ic USING (s)),
many AS (SELECT doc_id, item_id FROM hit GROUP BY ALL HAVING count(*) * 9 >= 8 * (max(l) - 4)),
starts AS (SELECT DISTINCT doc_id, item_id, l, unnest(generate_series(greatest(0, p - (l - 5)), p)) AS start FROM hit JOIN many USING (doc_id, item_id)),
ok AS (SELECT doc_id, item_id, l, start FROM starts JOIN d USING (doc_id) WHERE start + l <= len(d.w)),
wc AS (SELECT o.doc_id, o.item_id, o.l, o.start, h.s, h.c, count(*) AS n FROM ok o JOIN hit h ON h.doc_id = o.doc_id AND h.item_id = o.item_id AND h.p BETWEEN o.start AND o.start + o.l - 5 GROUP BY ALL),
sim AS (SELECT doc_id, item_id, l, start, sum(least(c, n)) AS m FROM wc GROUP BY ALL),
best AS (SELECT doc_id, item_id, l, start, m / (2.0 * (l - 4) - m) AS similarity, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY m DESC, start) AS place FROM sim)
SELECT doc_id, item_id, start, CAST(l AS BIGINT) AS length, CAST(floor(similarity * 1e6 + 0.5) AS BIGINT) AS similarity_millionths FROM best WHERE place = 1 AND similarity >= 0.8
"""
