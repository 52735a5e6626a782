"""Near-duplicate classes by ProbMinHash, banding and verification.

A document is its runs of five lower-cased words, weighted by how often each occurs. ProbMinHash lets every shingle arrive as a Poisson
process whose rate is its weight; each arrival falls on one of the registers, the earliest stays, and a shingle stops once its
next arrival is later than every register's. Two documents then agree on a register with a probability that is their
probability Jaccard similarity. Bands of registers give candidates, and the exact similarity of the shingles decides.

From candidates to classes without all pairs of a bucket:
1. Documents with the same words are one vertex, named by a 64-bit hash of the word sequence; copies are never paired.
2. Each bucket has a leader: the vertex that meets most others over all its buckets, so the most central one of a group of near copies.
   Every vertex is compared with the leaders of its buckets, exactly; connected components follow.
3. What is left are vertices that share a leader but no component. Shingles that at most 8 unsettled texts have are rare: pairs that share one are
   listed by it. For all other pairs, rare shingles are in one text only, and three weights of each vertex bound the similarity from
   above: that of its rare shingles, that of the others it shares with the leader, and that of the rest (`_open`). A vertex
   that is too rare for any partner is settled. The others are put into cells of these weights, relative to size; a leader has a bounded number
   of cells, however many vertices it has. Cells are compared with cells, and only vertices in two cells that the bound leaves open are
   paired, bounded again each for itself, and verified.
So a group of near copies costs its members' comparisons with the leader and those pairs that lie at the edge of the bound. No link between texts in
a common bucket is lost: nothing is dropped by an estimate.

With 24 bands of 4 registers a pair at similarity 0.8 shares a bucket with probability 1 - 3e-6.

Defined results: documents without words are classes of their own. A null doc_id can't name a class: such rows are returned with
a null class and not compared. Rows that repeat a doc_id are compared each by its own text; rows that repeat doc_id and text stay or go together.
Documents under five words are one shingle. Texts of any length are hashed in pieces and compared whole. Ties of leaders go to the lesser hash.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, store, table, without
from .hashing import mix, runs, sequence_hash, word_hashes

SHINGLE, SIMILAR, BANDS, ROWS, RARE = 5, 0.8, 24, 4, 8
_STEP, _SLOT = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
#: Cells of a leader: steps of the logarithm of size, of the rare share and of the share in common with the leader.
_SIZE_STEP, _SHARE_STEPS = 0.05, 40


def shingles(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, and the distinct shingles with their counts."""
    words = word_hashes((text or "").lower())
    own = runs(words, min(SHINGLE, len(words))) if len(words) else words
    return words, *np.unique(own, return_counts=True)


def probminhash(doc: np.ndarray, element: np.ndarray, weight: np.ndarray, n_docs: int, registers: int) -> np.ndarray:
    """For each document and register, the element that arrives first. Rows of doc, element and weight are the documents' weighted elements."""
    time = np.full(n_docs * registers, np.inf)
    first = np.zeros(n_docs * registers, np.uint64)
    now, live, seed, k = np.zeros(len(doc)), np.arange(len(doc)), mix(element), 0
    while live.size:
        k += 1
        draw = mix(seed[live] + np.uint64(k * _STEP % 2**64))
        now[live] -= np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0**53) / weight[live]
        slot = doc[live] * registers + (mix(draw ^ np.uint64(_SLOT)) % np.uint64(registers)).astype(np.int64)
        early = now[live] < time[slot]
        slot, who = slot[early], live[early]
        np.minimum.at(time, slot, now[who])
        won = now[who] == time[slot]
        first[slot[won]] = element[who[won]]
        last = time.reshape(n_docs, registers).max(axis=1)
        live = live[now[live] < last[doc[live]]]
    return first.reshape(n_docs, registers)


def _sign(registers: int, most: int = 200_000):
    def flush(rows: list[tuple], parts: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
        filled = [i for i, (e, _) in enumerate(parts) if len(e) > 1]
        signs = [np.full(registers, e[0]) if len(e) else np.zeros(0, np.uint64) for e, _ in parts]
        if filled:
            doc = np.repeat(np.arange(len(filled)), [len(parts[i][0]) for i in filled])
            found = probminhash(doc, np.concatenate([parts[i][0] for i in filled]), np.concatenate([parts[i][1] for i in filled]).astype(float), len(filled), registers)
            for i, row in zip(filled, found, strict=True):
                signs[i] = row
        out = pd.DataFrame(rows, columns=["doc", "row", "key", "more"])
        out["sign"] = [(s >> np.uint64(32)).astype(np.uint32).view(np.int32) for s in signs]
        return out

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows, parts, size = [], [], 0
            for doc, row, text in zip(batch["doc"], batch["row"], batch["text"], strict=True):
                words, elements, counts = shingles(text)
                rows.append((doc, row, sequence_hash(words), sequence_hash(words, _SLOT)))
                parts.append((elements, counts))
                size += len(elements)
                if size >= most:
                    yield flush(rows, parts)
                    rows, parts, size = [], [], 0
            if rows:
                yield flush(rows, parts)

    return sign


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The probability Jaccard similarity of two weighted sets (sorted elements, weights): the sum over common elements i of 1 / sum over j of max(x_j / x_i, y_j / y_i)."""
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not common.size:
        return 0.0
    x, y = a[1][i].astype(float), b[1][j].astype(float)
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    # By rising x / y: for each i, those at or after it count with x_j / x_i, those before with y_j / y_i.
    after = np.cumsum(x[::-1])[::-1] + (a[1].sum() - x.sum())
    before = np.concatenate(([0.0], np.cumsum(y)[:-1])) + (b[1].sum() - y.sum())
    return float((1.0 / (after / x + before / y)).sum())


def _weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(v, e.view(np.int64), n.astype(np.int32)) for v, (_, e, n) in zip(batch["vertex"], map(shingles, batch["text"]), strict=True)]
        yield pd.DataFrame(rows, columns=["vertex", "elements", "counts"])


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The exact similarity, and the weight that a's shingles in common with b have in a."""
    for batch in batches:
        rows = []
        for e, n, f, m in zip(*[batch[c] for c in ("elements_a", "counts_a", "elements_b", "counts_b")], strict=True):
            a, b = (np.asarray(e).view(np.uint64), np.asarray(n)), (np.asarray(f).view(np.uint64), np.asarray(m))
            rows.append((similarity(a, b), int(a[1][np.isin(a[0], b[0], assume_unique=True)].sum())))
        found = pd.DataFrame(rows, columns=["similarity", "common"])
        yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "similarity": found["similarity"].astype(float), "common": found["common"].astype("int64")})


def _similarities(pairs: DataFrame, weighed: DataFrame) -> DataFrame:
    """a, b -> a, b, similarity, common."""
    side = lambda s: weighed.select(F.col("vertex").alias(s), F.col("elements").alias(f"elements_{s}"), F.col("counts").alias(f"counts_{s}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(_compare, "a long, b long, similarity double, common long")


def components(links: DataFrame, name: str = "components", rounds: list[int] | None = None) -> DataFrame:
    """a, b -> vertex, component (its least vertex) for every vertex of a link.

    Each round hooks every vertex to its least neighbour, if that is less; pointer doubling then leads every vertex to the root of its tree, and links are
    contracted to roots. Only vertices that are less than all their neighbours stay, at most half; so n vertices take at most log2 n
    rounds of at most log2 n doublings. `rounds` takes the number of doublings of each round, for tests.
    """
    edges = store(links.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), f"{name}-links")
    labels = None
    while True:
        near = edges.select("a", "b").union(edges.select("b", "a")).groupBy(F.col("a").alias("from")).agg(F.min("b").alias("low"))
        hooks, doublings = store(near.select("from", F.least("from", "low").alias("to")), f"{name}-hooks"), 0
        while True:
            ahead = hooks.select(F.col("from").alias("to"), F.col("to").alias("further"))
            hooks = store(hooks.join(ahead, "to").select("from", F.col("further").alias("to"), (F.col("further") < F.col("to")).alias("moved")), f"{name}-hooks")
            doublings += 1
            moved = not hooks.filter("moved").isEmpty()
            hooks = hooks.drop("moved")
            if not moved:
                break
        if rounds is not None:
            rounds.append(doublings)
        if labels is None:
            labels = hooks.select(F.col("from").alias("vertex"), F.col("to").alias("component"))
        else:
            labels = labels.join(hooks, F.col("component") == F.col("from"), "left").select("vertex", F.coalesce("to", "component").alias("component"))
            labels = store(labels, name)
        end = lambda c: hooks.select(F.col("from").alias(c), F.col("to").alias(f"{c}_to"))
        edges = edges.join(end("a"), "a").join(end("b"), "b").filter("a_to != b_to")
        edges = store(edges.select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b")).distinct(), f"{name}-links")
        if edges.isEmpty():
            return labels


def _rare_weights(weighed: DataFrame, placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """vertex, component, weight, rare (the weight of shingles that at most `RARE` unsettled texts have), plain (all counts are 1); and vertex pairs a, b with the weight of the rare shingles they share, on either side."""
    open_docs = weighed.join(placed.select("vertex", "component").distinct(), "vertex")
    each = open_docs.select("vertex", F.inline(F.arrays_zip(F.col("elements").alias("element"), F.col("counts").alias("n"))))
    rare = each.groupBy("element").agg(F.count(F.lit(1)).alias("holders")).filter(F.col("holders") <= RARE)
    rare = store(each.join(rare, "element"), "rare-shingles")
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda s, n: s + n)
    sizes = open_docs.select("vertex", "component", total.alias("weight"), (F.array_max("counts") == 1).alias("plain"))
    own = sizes.join(rare.groupBy("vertex").agg(F.sum("n").alias("some")), "vertex", "left")
    own = own.select("vertex", "component", "weight", F.coalesce("some", F.lit(0)).alias("rare"), "plain")
    # At most RARE holders each.
    held = rare.filter("holders > 1").groupBy("element").agg(F.sort_array(F.collect_set(F.struct("vertex", "n"))).alias("v"))
    two = F.flatten(F.transform("v", lambda x, i: F.transform(F.slice("v", i + 2, RARE), lambda y: F.struct(x["vertex"].alias("a"), y["vertex"].alias("b"), x["n"].alias("n1"), y["n"].alias("n2")))))
    shared = held.select(F.inline(two)).groupBy("a", "b").agg(F.sum("n1").alias("shared1"), F.sum("n2").alias("shared2"))
    return store(own, "rare-weights"), store(shared, "rare-pairs")


def _most_similar(shared: Callable[[int], Column]) -> Column:
    """An upper bound of the similarity of two weighted sets of which at least shares u1 and u2 aren't common: (1 - (u1 + u2) / 2) / (1 + min(u1, u2)).

    With p, q as shares and U, V as the exclusive shares, element i's term is at most 1 / (1/p + V/q) and at most 1 / (1/q + U/p), so at most
    2pq / (p (1 + V) + q (1 + U)) <= (p + q) / 2 / (1 + min(U, V)); summed over the common elements that is the bound.
    """
    u1, u2 = ((F.col(f"rare{n}") - shared(n)) / F.col(f"weight{n}") for n in (1, 2))
    return (1 - (u1 + u2) / 2) / (1 + F.least(u1, u2))


def _gap(column: str) -> Column:
    """How far apart the ranges low..high of two sides are at least."""
    return F.greatest(F.lit(0), F.col(f"{column}_low1") - F.col(f"{column}_high2"), F.col(f"{column}_low2") - F.col(f"{column}_high1"))


def _open(similar: float) -> Column:
    """Whether two cells, or two vertices, may hold a pair of `similar` or more that shares no rare shingle.

    The texts differ at least by their rare shingles, by the difference of what they share with the leader and by that of the rest. For sets, that is
    at most (1 - t) / (1 + t) of their sizes together. In general a similarity of t needs distributions that differ by 1 - t at most, as a similarity is a
    probability that two samples agree; the same differences, as shares, count on each side.
    """
    sets = F.col("rare_low1") + F.col("rare_low2") + _gap("led") + _gap("rest") <= (F.col("weight_high1") + F.col("weight_high2")) * ((1 - similar) / (1 + similar)) + 1e-9
    shares = F.col("rare_share1") + F.col("rare_share2") + _gap("led_share") + _gap("rest_share") <= 2 * (1 - similar) + 1e-9
    return F.when(F.col("plain1") & F.col("plain2"), sets).otherwise(shares)


_RANGES = ("led", "rest", "led_share", "rest_share")


def _cells(members: DataFrame, similar: float) -> tuple[DataFrame, DataFrame]:
    """The members with their cell, and the pairs of a leader's cells that may hold links between components."""
    share = lambda c: F.col(c) / F.col("weight")
    rows = members.withColumns({"led_share": share("led"), "rest_share": share("rest"), "rare_share": share("rare")})
    rows = rows.withColumn("cell", F.xxhash64("plain", F.floor(F.ln("weight") / _SIZE_STEP), F.floor(F.col("rare_share") * _SHARE_STEPS), F.floor(F.col("led_share") * _SHARE_STEPS)))
    rows = store(rows, "unsettled")
    ends = [f(c).alias(f"{c}_{n}") for c in _RANGES for f, n in ((F.min, "low"), (F.max, "high"))]
    cells = rows.groupBy("leader", "cell", "plain").agg(
        F.min("component").alias("first"), F.max("component").alias("last"), F.min("rare").alias("rare_low"), F.min("rare_share").alias("rare_share"), F.max("weight").alias("weight_high"), *ends
    )
    cells = store(cells, "cells")
    side = lambda n: cells.select("leader", *[F.col(c).alias(f"{c}{n}") for c in cells.columns if c != "leader"])
    both = side(1).join(side(2), "leader").filter("cell1 <= cell2 AND NOT (first1 = last1 AND first2 = last2 AND first1 = first2)")
    return rows, both.filter(_open(similar)).select("leader", "cell1", "cell2")


def _unsettled_pairs(placed: DataFrame, weighed: DataFrame, similar: float) -> tuple[DataFrame, DataFrame]:
    """All pairs a, b of different components that share a leader or a rare shingle and may be as similar; and vertex, component of all that are unsettled."""
    own, shared = _rare_weights(weighed, placed)
    sides = ("component", "weight", "rare", "plain")
    end = lambda c, n: own.select(F.col("vertex").alias(c), *[F.col(x).alias(f"{x}{n}") for x in sides])
    # Pairs with a rare shingle in common, and what their other shingles could add.
    most = F.least(F.col("weight1") - F.col("rare1"), F.col("weight2") - F.col("rare2")) + F.col("shared1")
    reach = most >= similar * (F.col("weight1") + F.col("weight2") - most) - 1e-9
    linked = shared.join(end("a", 1), "a").join(end("b", 2), "b").filter("component1 != component2")
    linked = linked.filter((_most_similar(lambda n: F.col(f"shared{n}")) >= similar - 1e-9) & (~(F.col("plain1") & F.col("plain2")) | reach)).select("a", "b")

    # Pairs without: a vertex with too many rare shingles has no partner.
    members = placed.drop("component").join(own.filter(F.col("rare") <= (1 - similar) * F.col("weight") + 1e-9), "vertex").filter("vertex != leader")
    # Rare shingles of the leader's count as rare only.
    of_leader = shared.select(F.col("a").alias("vertex"), F.col("b").alias("leader"), F.col("shared1").alias("both")).union(shared.select("b", "a", "shared2"))
    members = members.join(of_leader, ["vertex", "leader"], "left").withColumn("led", F.col("led") - F.coalesce("both", F.lit(0))).drop("both")
    members = members.withColumn("rest", F.col("weight") - F.col("rare") - F.col("led"))
    rows, cells = _cells(members, similar)
    # Written, so that the joins of their members shuffle for themselves and a hot cell can be split.
    cells = store(cells, "open-cells")
    ends = [F.col(c).alias(f"{c}_{n}") for c in _RANGES for n in ("low", "high")]
    each = rows.select("leader", "cell", "vertex", "component", "plain", F.col("rare").alias("rare_low"), "rare_share", F.col("weight").alias("weight_high"), *ends)
    side = lambda n: each.select("leader", *[F.col(c).alias(f"{c}{n}") for c in each.columns if c != "leader"])
    different = (F.col("component1") != F.col("component2")) & ((F.col("cell1") != F.col("cell2")) | (F.col("vertex1") < F.col("vertex2")))
    plain = cells.join(side(1), ["leader", "cell1"]).join(side(2), ["leader", "cell2"]).filter(different & _open(similar))
    plain = plain.select(F.least("vertex1", "vertex2").alias("a"), F.greatest("vertex1", "vertex2").alias("b"))
    return store(plain.union(linked).distinct(), "unsettled-pairs"), own.select("vertex", "component")


def _apart(signed: DataFrame) -> DataFrame:
    """`signed` with the key of word sequences that differ told apart: of those that share one of 64 bits, all but one get a key of both hashes."""
    both = signed.groupBy("key").agg(F.min("more").alias("least"), F.max("more").alias("most")).filter("least != most")
    both = store(both.select(F.col("key").alias("shared"), "least"), "shared-keys")
    # About n^2 / 2^65 keys of n texts, so mostly none.
    if both.isEmpty():
        return signed
    out = signed.join(both, F.col("key") == F.col("shared"), "left")
    return out.withColumn("key", F.when(F.col("more") != F.col("least"), F.xxhash64("key", "more")).otherwise(F.col("key"))).drop("shared", "least")


def near_classes(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, similar: float = SIMILAR) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, row (a hash of the text), class_id, class_size, kept."""
    small_batches(docs.sparkSession, 500)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text")).withColumn("row", F.xxhash64("text"))
    signed = _apart(store(texts.mapInPandas(_sign(bands * rows), "doc long, row long, key long, more long, sign array<int>"), "signs"))
    known = signed.filter("doc IS NOT NULL AND size(sign) > 0")
    # Copies are one vertex, whose text is that of its first document.
    alike = known.groupBy(F.col("key").alias("vertex")).agg(F.min(F.struct("doc", "row")).alias("own"), F.first("sign").alias("sign"))
    alike = store(alike.select("vertex", F.col("own.doc").alias("doc"), F.col("own.row").alias("row"), "sign"), "vertices")

    band = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.struct(i.alias("band"), F.xxhash64(F.slice("sign", i * rows + 1, rows), i).alias("bucket")))
    buckets = alike.select("vertex", F.inline(band))
    # Sums are written, so that the joins with them shuffle both sides for themselves and a hot bucket can be split.
    sizes = store(buckets.groupBy("band", "bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "bucket-sizes")
    buckets = store(buckets.join(sizes, ["band", "bucket"]), "buckets")
    met = buckets.groupBy("vertex").agg(F.sum("n").alias("met"))
    leaders = buckets.join(met, "vertex").groupBy("band", "bucket").agg(F.max(F.struct("met", (-F.col("vertex")).alias("less"))).alias("top"))
    leaders = store(leaders.select("band", "bucket", (-F.col("top.less")).alias("leader")), "leaders")
    led_by = store(buckets.join(leaders, ["band", "bucket"]).select("vertex", "leader").distinct(), "led-by")

    involved = alike.join(led_by.select("vertex").distinct(), "vertex").select("vertex", "doc", "row")
    involved = texts.join(involved, ["doc", "row"]).dropDuplicates(["doc", "row"]).select("vertex", "text")
    weighed = store(involved.mapInPandas(_weigh, "vertex long, elements array<long>, counts array<int>"), "weighed")
    star = led_by.filter("vertex != leader").select(F.col("vertex").alias("a"), F.col("leader").alias("b"))
    stars = store(_similarities(star, weighed), "stars")
    first = components(stars.filter(F.col("similarity") >= similar).select("a", "b"), "star-components")

    # Vertices that share a leader but no component yet.
    placed = led_by.join(first, "vertex", "left").withColumn("component", F.coalesce("component", "vertex"))
    mixed = placed.groupBy("leader").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = store(mixed.filter("low < high").select("leader"), "mixed-leaders")
    led = stars.select(F.col("a").alias("vertex"), F.col("b").alias("leader"), F.col("common").alias("led"))
    placed = store(placed.join(mixed, "leader").join(led, ["vertex", "leader"], "left"), "placed")
    pairs, part_of = _unsettled_pairs(placed, weighed, similar)
    more = _similarities(pairs, weighed).filter(F.col("similarity") >= similar)
    part = lambda c: part_of.select(F.col("vertex").alias(c), F.col("component").alias(f"{c}_part"))
    more = more.join(part("a"), "a").join(part("b"), "b").select(F.col("a_part").alias("a"), F.col("b_part").alias("b"))
    last = components(more, "components").select(F.col("vertex").alias("component"), F.col("component").alias("whole"))
    of = led_by.select("vertex").distinct().join(first, "vertex", "left").withColumn("component", F.coalesce("component", "vertex"))
    of = store(of.join(last, "component", "left").select(F.col("vertex").alias("key"), F.coalesce("whole", "component").alias("group")), "groups")

    # Rows without words, and vertices that meet no other, are groups of their own.
    out = signed.select("doc", "row", "key", (F.col("doc").isNotNull() & (F.size("sign") > 0)).alias("known")).join(of, "key", "left")
    out = store(out.select("doc", "row", "known", F.coalesce("group", "key").alias("group")), "grouped")
    classes = out.filter("known").groupBy("group").agg(F.min(F.struct("doc", "row")).alias("own"), F.count(F.lit(1)).alias("class_size"))
    classes = store(classes.withColumn("known", F.lit(True)), "classes")
    out = out.join(classes, ["group", "known"], "left")
    kept = F.coalesce((F.col("doc") == F.col("own.doc")) & (F.col("row") == F.col("own.row")), F.lit(True))
    return out.select(F.col("doc").alias("doc_id"), "row", F.coalesce("own.doc", "doc").alias("class_id"), F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), kept.alias("kept"))


def near_duplicates(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, similar: float = SIMILAR) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, class_id (the least doc_id of its class), class_size, kept."""
    return near_classes(docs, bands, rows, similar).drop("row")


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The rows of `docs` that stay, one document of each class, with all their columns."""
    gone = near_classes(docs).filter("NOT kept").select("doc_id", "row").distinct()
    return without(docs, gone)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
