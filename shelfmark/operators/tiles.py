"""The best candidates of each flyer description, found in tiles of flyer texts by master rows without a list of pairs.

A pair's total score is the sum of what the flyer description scores with the master row's description, with its brand and with its category. So each part is a matrix over distinct texts: similarities
are one matrix product of vectors, the boost one product of key incidences a feature, fuzzy ratios one batch of text pairs. A row's total is read from these by place.
Master rows are range-partitioned by description into blocks, as rows with equal texts then share a block; flyer texts are dealt into chunks. A tile is one chunk with one block, in one task: it
returns at most k rows for each of its flyer texts, with all six scores, and the least and greatest total of its candidates, which scaling needs. What leaves the tiles is then
k rows for each flyer text and block, and no pair is shuffled.

Sizes decide how the plane is cut: blocks hold at most about BLOCK_ROWS rows, and there are only as many chunks as keep all cores busy or as CHUNK_TEXTS allows, since each side is sent
once for each part of the other.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions import fuzzy
from shelfmark.functions import text as tx
from shelfmark.operators import pairs, vectors
from shelfmark.sources.work import range_parts, store

BLOCK_ROWS, CHUNK_TEXTS, AT_ONCE = 16_384, 16_384, 32
#: Similarities are rounded to so many places, so that the order of their sums can't decide between equal totals.
PLACES = 1e9
FIELDS = ("Description", "BRAND", "nCat_Desc")
_OUT = ", ".join(["text string", "master_row long", *[f"{c} double" for c in pairs.SCORES], "total_Combined_Score double", "low double", "high double"])


def _keys(array: Column) -> Column:
    return F.transform(array, lambda k: F.concat(k["kind"], F.lit("\x01"), k["key"]))


def _features(texts: DataFrame, keys: Callable[[Column], Column], vector: DataFrame | None) -> DataFrame:
    """`texts` (text and others) with clean, keys and vector."""
    text = F.col("text")
    out = texts.withColumns({"clean": tx.match_text(text), "keys": _keys(keys(text))})
    if vector is None:
        return out.withColumn("vector", F.lit(None).cast("array<float>"))
    return out.join(vector.select(F.col("text").alias("__text"), F.col("vector").alias("__vector")), text == F.col("__text"), "left").drop("__text").withColumnRenamed("__vector", "vector")


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """A list column's values in one array and where each list ends."""
    held = column.combine_chunks()
    held = held.chunk(0) if isinstance(held, pa.ChunkedArray) else held
    flat = held.flatten()
    return flat, np.cumsum(np.diff(held.offsets.to_numpy()))


class _Texts:
    """Distinct texts of one side and field: cleaned forms, keys by kind, vectors."""

    def __init__(self, table: pa.Table):
        self.texts = table.column("text").to_pylist()
        self.clean = table.column("clean").to_pylist()
        flat, ends = _lists(table.column("keys"))
        self.keys, self.owners = np.array(flat.to_pylist(), dtype=object), np.repeat(np.arange(len(ends)), np.diff(np.concatenate([[0], ends])))
        flat, ends = _lists(table.column("vector"))
        width = int(np.diff(np.concatenate([[0], ends])).max()) if len(ends) else 0
        self.vectors = np.zeros((len(self.texts), width))
        if width:
            has = np.flatnonzero(np.diff(np.concatenate([[0], ends])) == width)
            self.vectors[has] = flat.to_numpy(zero_copy_only=False).reshape(-1, width)

    def incidence(self, places: dict[str, int], kinds: tuple[str, ...]) -> np.ndarray:
        """[text, key]: which of the numbered keys of some kinds each text has."""
        out = np.zeros((len(self.texts), len(places)), np.float32)
        for owner, key in zip(self.owners, self.keys, strict=True):
            if key in places and key.split("\x01", 1)[0] in kinds:
                out[owner, places[key]] = 1
        return out


def _boosts(flyer: _Texts, master: _Texts, weights: dict[str, float]) -> np.ndarray:
    counts = {}
    for feature, kinds in pairs.FEATURES.items():
        common = {k for k in set(flyer.keys) & set(master.keys) if k.split("\x01", 1)[0] in kinds}
        places = {k: i for i, k in enumerate(sorted(common))}
        counts[feature] = (flyer.incidence(places, kinds) @ master.incidence(places, kinds).T).astype(float)
    # In the order of `weighted`, so that sums are equal to the last bit.
    out = counts["devowel"] * weights["devowel"]
    for feature in ("upper", "first", "word"):
        out = out + counts[feature] * weights[feature]
    return out


def _similarities(flyer: _Texts, master: _Texts) -> np.ndarray:
    if not flyer.vectors.shape[1] or not master.vectors.shape[1]:
        return np.zeros((len(flyer.texts), len(master.texts)))
    return np.floor(flyer.vectors @ master.vectors.T * PLACES + 0.5) / PLACES


def _words(flyer: list[str], field: list[str], ratio: Callable | None) -> np.ndarray:
    """1 where a field's text is part of the flyer text, else the ratio of both; 0 where either is empty."""
    a, b = np.array(flyer, dtype=np.str_), np.array(field, dtype=np.str_)
    some = (np.strings.str_len(a) > 0)[:, None] & (np.strings.str_len(b) > 0)[None, :]
    out = ((np.strings.find(a[:, None], b[None, :]) >= 0) & some).astype(float)
    if ratio is not None:
        i, j = np.nonzero(some & (out == 0))
        if len(i):
            out[i, j] = ratio(field, j, flyer, i) / 100
    return out


def _tile(k: int, threshold: float | None, weights: dict[str, float], full: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "double": pa.float64()}[t]) for n, t in (c.split() for c in _OUT.split(", "))])
    ratios = (fuzzy.pair_partial_ratios, fuzzy.pair_wratios) if full else (None, None)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        field = right.column("field").to_numpy()
        sides = [_Texts(right.filter(pa.array(field == f))) for f in range(len(FIELDS))]
        rows = right.filter(pa.array(field < 0)).sort_by("master_row")
        place = [{t: i for i, t in enumerate(s.texts)} for s in sides]
        at = [np.array([p[t] for t in rows.column(c).to_pylist()], np.int64) for p, c in zip(place, ("text", "brand", "category"), strict=True)]
        ids = rows.column("master_row").to_numpy()
        found, low, high = [], np.inf, -np.inf
        for first in range(0, left.num_rows, AT_ONCE):
            flyer = _Texts(left.slice(first, AT_ONCE))
            d, b, n = (_similarities(flyer, s) for s in sides)
            boost = _boosts(flyer, sides[0], weights)[:, at[0]] + _boosts(flyer, sides[1], weights)[:, at[1]]
            brand, category = (_words(flyer.clean, s.clean, r) for s, r in zip(sides[1:], ratios, strict=True))
            # As `combined_score` adds them up, so that sums are equal to the last bit.
            total = d[:, at[0]] + n[:, at[2]]
            total += b[:, at[1]]
            total += boost
            total += brand[:, at[1]]
            total += category[:, at[2]]
            if threshold is not None and threshold > 0:
                total[boost < threshold - 1e-9] = -np.inf
            least = np.where(np.isinf(total), np.inf, total).min()
            low, high = min(low, least), max(high, total.max())
            for i, own in enumerate(total):
                cut = np.partition(own, len(own) - k)[len(own) - k] if len(own) > k else -np.inf
                over = np.flatnonzero(own > cut)
                # Equal totals go by master_row, as the rows do.
                tied = np.flatnonzero(own == cut)[: k - len(over)] if cut > -np.inf else over[:0]
                best = np.concatenate([over, tied])
                x, y, z = (a[best] for a in at)
                scores = (d[i, x], n[i, z], b[i, y], boost[i, best], brand[i, y], category[i, z])
                found.append(pa.Table.from_arrays([pa.array([flyer.texts[i]] * len(best), pa.string()), pa.array(ids[best]), *map(pa.array, scores), pa.array(own[best]), *[pa.nulls(len(best), pa.float64())] * 2], schema=schema))
        if high > -np.inf:
            found.append(pa.Table.from_pylist([{"low": low, "high": high}], schema))
        return pa.concat_tables(found) if found else schema.empty_table()

    return run


def best_candidates(flyer: DataFrame, master: DataFrame, k: int = 65, threshold: float | None = 0.2, weights: dict[str, float] | None = None, encode: Callable[[list[str]], np.ndarray] | None = None) -> DataFrame:
    """The k best candidates of each flyer description: flyer_row, master_row, PDF_Description, the six scores, total_Combined_Score and Combined_Score (scaled by all candidates).

    `flyer` has flyer_row and Description, `master` master_row, Description, nCat_Desc and BRAND where there is any. With `encode`, similarities and fuzzy ratios are scored; without, containment alone. Null texts
    count as empty.
    """
    partitions = int(flyer.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = lambda c, df: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")
    flyer = flyer.select("flyer_row", text("Description", flyer).alias("PDF_Description"))
    own = store(flyer.select(F.col("PDF_Description").alias("text")).distinct(), "flyer-texts")
    rows = master.select("master_row", text("Description", master).alias("text"), text("BRAND", master).alias("brand"), text("nCat_Desc", master).alias("category"))
    n_texts, n_rows = own.count(), rows.count()
    n_blocks = max(1, -(-n_rows // BLOCK_ROWS))
    n_chunks = max(1, min(n_texts, max(-(-n_texts // CHUNK_TEXTS), -(-4 * partitions // n_blocks))))
    rows, _ = range_parts(rows, "master-blocks", "text", "master_row", n=n_blocks)
    fields = F.explode(F.array(*[F.struct(F.lit(i).alias("field"), F.col(c).alias("text")) for i, c in enumerate(("text", "brand", "category"))]))
    used = rows.select("part", fields.alias("f")).select("part", "f.field", "f.text").distinct()
    vector = None
    if encode is not None:
        vector = store(vectors.encode_texts(used.select("text").union(own).distinct(), encode), "vectors")
    no_brand = "BRAND" not in master.columns
    keys = lambda c: F.when((F.col("field") == 2) | F.lit(no_brand) & (F.col("field") == 1), F.array().cast("array<struct<kind:string,key:string>>")).otherwise(pairs.master_key_array(c))
    used = _features(used, keys, vector)
    none = lambda kind: F.lit(None).cast(kind)
    right = used.select("part", "field", "text", "clean", "keys", "vector", none("long").alias("master_row"), none("string").alias("brand"), none("string").alias("category"))
    right = right.union(rows.select("part", F.lit(-1).alias("field"), "text", none("string"), none("array<string>"), none("array<float>"), "master_row", "brand", "category"))
    right = right.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))))
    left = _features(own, pairs.flyer_key_array, vector).withColumn("chunk", F.pmod(F.xxhash64("text"), F.lit(n_chunks)).cast("int"))
    left = left.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    run = _tile(k, threshold, {**tx.WEIGHTS, **(weights or {})}, encode is not None)
    found = store(left.groupBy("chunk", "part").cogroup(right.groupBy("chunk", "part")).applyInArrow(run, _OUT), "tile-bests")

    place = F.row_number().over(Window.partitionBy("PDF_Description").orderBy(F.col("total_Combined_Score").desc(), "flyer_row", "master_row"))
    best = found.filter("master_row IS NOT NULL").drop("low", "high").join(flyer, F.col("text") == F.col("PDF_Description"))
    best = best.withColumn("place", place).filter(F.col("place") <= k).drop("place", "text")
    # One row: the ends of all candidates' totals.
    ends = found.agg(F.min("low").alias("low"), F.max("high").alias("high"))
    scaled = F.when(F.col("high") > F.col("low"), (F.col("total_Combined_Score") - F.col("low")) / (F.col("high") - F.col("low"))).otherwise(0.0)
    return best.crossJoin(F.broadcast(ends)).withColumn("Combined_Score", scaled).drop("low", "high")
