"""Exact, near and substring deduplication against brute force on small fixtures."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.llm import exact_dedup, near_dedup, substring_dedup
from shelfmark.llm.hashing import runs, sliding_min, word_hashes

COLUMNS = "doc_id long, text string, source string, `place` string, `body` string"


def frame(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "s", "p", "b") for i, t in rows], COLUMNS).repartition(3)


def words(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


ODD = [(1, None), (2, ""), (3, None), (None, "Null Id"), (None, "null id"), (7, "Same"), (7, "Same"), (8, "sAME"), (9, "ÄB"), (10, "äb"), (11, " \n\t ")]


def test_exact_dedup_edges(spark):
    got = {}
    for r in exact_dedup.exact_dedup(frame(spark, ODD)).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert {r.keep_id for i in (1, 2, 3) for r in got[i]} == {3} and [got[i][0].group_size for i in (1, 2, 3)] == [3, 3, 3]
    assert [r.keep_id for r in got[None]] == [None, None] and sorted(r.kept for r in got[None]) == [False, True]
    assert all(r.keep_id == 8 and r.group_size == 3 for r in got[7]) and got[8][0].kept and not any(r.kept for r in got[7])
    assert got[9][0].kept and got[10][0].kept  # only A-Z is lower-cased
    assert got[8][0].text_sha256 == hashlib.sha256(b"same").hexdigest()


def test_exact_dedup_keeps_one_of_repeated_rows(spark):
    docs = frame(spark, ODD + [(8, "sAME")])
    out = exact_dedup.drop_exact_copies(docs)
    assert out.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in out.collect())[8, "sAME"] == 1
    assert exact_dedup.drop_exact_copies(frame(spark, []).limit(0)).count() == 0


def brute_substrings(rows, window):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    rank = lambda i: 2**63 if i is None else i
    for i, w in split:
        for s in range(len(w) - window + 1):
            k = tuple(w[s : s + window])
            first[k] = min(first.get(k, 2**64), rank(i))
    out = []
    for i, w in split:
        keep = [True] * len(w)
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < rank(i):
                keep[s : s + window] = [False] * window
        kept = b" ".join(x for x, k in zip(w, keep, strict=True) if k)
        out.append((i, len(w), len(w) - sum(keep), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_substring_dedup_matches_brute_force(spark):
    rng = random.Random(3)
    passages = [words(rng, n) for n in (12, 15, 20, 33)]
    rows = []
    for i in range(60):
        parts = words(rng, rng.randrange(0, 30))
        for _ in range(rng.randrange(0, 4)):
            p = rng.choice(passages)
            at = rng.randrange(0, 5)
            parts += p[at:] + words(rng, rng.randrange(0, 6))
        rows.append((i, " ".join(parts)))
    rows += [(100 + i, rows[i][1]) for i in range(5)] + [(3, rows[9][1]), (None, rows[4][1]), (None, rows[5][1]), (70, None), (71, ""), (72, "a " * 300), (73, "a " * 290), (74, "x\x00y  " + rows[2][1])]
    got = substring_dedup.substring_dedup(frame(spark, rows), window=12, anchor=4).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_substrings(rows, 12)
    for r in got:
        assert all(f.length >= 12 for f in r.factors)


def test_substring_dedup_of_nothing(spark):
    assert substring_dedup.substring_dedup(frame(spark, [(1, "a")]).limit(0)).count() == 0


def test_parse_checks_factor_boundaries():
    starts, sources, places = np.array([0, 1, 2, 8, 30, 31, 32]), np.array([5, 5, 4, 4, 4, 4, 4]), np.array([7, 8, 1, 7, 2, 3, 9])
    assert substring_dedup.parse(starts, sources, places, 10) == [(0, 11, 5, 7), (2, 10, 4, 1), (8, 10, 4, 7), (30, 11, 4, 2), (32, 10, 4, 9)]


def test_substring_dedup_of_documents_at_50_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = substring_dedup.substring_dedup(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_substrings(rows, 50)
    words = {i: (t or "").split() for i, t in rows}
    some = 0
    for r in got:  # each factor is a run of its source
        for f in r.factors:
            some += 1
            assert f.length >= 50 and f.source < r.doc_id
            assert words[r.doc_id][f.start : f.start + f.length] == words[f.source][f.place : f.place + f.length]
    assert some > 50


def test_substring_dedup_of_many_rows_with_one_id(spark):
    rng = random.Random(4)
    passage = words(rng, 30)
    rows = [(1, " ".join(passage))] + [(2, " ".join(passage + words(rng, 5 + i % 7))) for i in range(1000)] + [(None, " ".join(passage))] * 20
    rows += [(3, " ".join(words(rng, 120_000) + passage))]
    got = substring_dedup.substring_dedup(frame(spark, rows), window=12, anchor=4).collect()
    assert len(got) == len(rows) and Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == brute_substrings(rows, 12)


def test_hashes():
    text = "eins zwei\tdrei\x0bvier\x0cfünf \r\n"
    assert len(word_hashes(text)) == 5 and len(word_hashes(None)) == 0
    assert word_hashes("a b")[1] == word_hashes("xx  b")[1] and word_hashes("a")[0] != word_hashes("a\x00")[0]
    long = "wort " * 300_000 + "ende"
    assert len(word_hashes(long)) == 300_001 and len(set(word_hashes(long).tolist())) == 2
    w = word_hashes("a b c a b c")
    assert runs(w, 3)[0] == runs(w, 3)[3] and len(set(runs(w, 3).tolist())) == 3
    v = np.random.default_rng(1).integers(0, 1000, 97).astype(np.uint64)
    for k in (1, 2, 7, 97):
        assert (sliding_min(v, k) == [v[i : i + k].min() for i in range(98 - k)]).all()


def shingle_counts(text):
    w = (text or "").lower().split()
    k = min(5, len(w))
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def brute_similarity(a, b):
    if max(a.values()) == max(b.values()) == 1:  # plain Jaccard
        return len(a.keys() & b.keys()) / len(a.keys() | b.keys())
    return sum(1 / sum(max(a.get(j, 0) / a[i], b.get(j, 0) / b[i]) for j in {*a, *b}) for i in a if i in b)


def brute_classes(rows):
    sets = {i: shingle_counts(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = [i for i in sorted(sets) if sets[i]]
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if root(i) != root(j) and sets[i].keys() & sets[j].keys() and brute_similarity(sets[i], sets[j]) >= 0.8:
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: root(i) for i in sets}


def test_near_duplicates_match_brute_force(spark):
    rng = random.Random(5)
    rows, base = [], words(rng, 90)
    for _ in range(90):  # copies of one text, changed a little or a lot
        copy = list(base)
        for _ in range(rng.choice((0, 1, 1, 2, 3, 4, 6))):
            copy[rng.randrange(90)] = f"x{rng.randrange(60)}"
        rows.append((len(rows), " ".join(copy)))
    passage = words(rng, 60)
    for _ in range(30):
        rows.append((len(rows), " ".join(passage + words(rng, rng.randrange(3, 40)))))
    for _ in range(20):
        rows.append((len(rows), " ".join(words(rng, 50) * rng.choice((1, 2)))))
    rows += [(500, None), (501, ""), (502, "one two"), (503, "One  TWO"), (504, "la " * 400), (505, "la " * 500)]
    got = {r.doc_id: r for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    want = brute_classes(rows)
    assert {i: r.class_id for i, r in got.items()} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[want[i]] and r.kept == (want[i] == i) for i, r in got.items())


def test_near_duplicates_edges(spark):
    text = " ".join(f"t{i}" for i in range(40))
    docs = frame(spark, [(None, text), (1, text), (2, text), (2, text), (3, "other words than these here")])
    rows = near_dedup.near_duplicates(docs).collect()
    assert sorted((r.doc_id or 0, r.class_id, r.kept) for r in rows) == [(0, None, True), (1, 1, True), (2, 1, False), (2, 1, False), (3, 3, True)]
    kept = near_dedup.drop_near_copies(docs)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3] and kept.columns == docs.columns
    assert near_dedup.near_duplicates(docs.limit(0)).count() == 0


def test_probminhash_estimates_probability_jaccard():
    rng = np.random.default_rng(2)
    elements = rng.integers(0, 2**63, 120).astype(np.uint64)
    x = (np.sort(elements[:90]), rng.integers(1, 5, 90))
    y = (np.sort(elements[20:]), rng.integers(1, 5, 100))
    doc = np.repeat([0, 1], [90, 100])
    sign = near_dedup.probminhash(doc, np.concatenate([x[0], y[0]]), np.concatenate([x[1], y[1]]).astype(float), 2, 4096)
    assert (sign[0] == sign[1]).mean() == pytest.approx(near_dedup.similarity(x, y), abs=0.03)


def test_similarity_and_its_bound():
    rng = random.Random(7)
    for _ in range(300):
        a = Counter({i: rng.randrange(1, 4) for i in rng.sample(range(20), rng.randrange(1, 15))})
        b = Counter({i: rng.randrange(1, 4) for i in rng.sample(range(20), rng.randrange(1, 15))})
        pack = lambda c: (np.array(sorted(c), np.uint64), np.array([c[k] for k in sorted(c)]))
        s = near_dedup.similarity(pack(a), pack(b))
        assert s == pytest.approx(brute_similarity(a, b))
        u, v = (sum(n for k, n in p.items() if k not in q) / sum(p.values()) for p, q in ((a, b), (b, a)))
        assert s <= (1 - (u + v) / 2) / (1 + min(u, v)) + 1e-9


def test_near_duplicates_of_documents_are_all_found(spark):
    """Every link of the given documents, from all pairs with a shingle in common."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    sets = {i: shingle_counts(t) for i, t in rows}
    holders = {}
    for i, c in sets.items():
        for k in c:
            holders.setdefault(k, []).append(i)
    size = {i: sum(c.values()) for i, c in sets.items()}
    links = 0
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(docs).collect()}
    found = 0
    for i, c in sets.items():
        for j in {j for k in c for j in holders[k] if j > i}:
            # Distributions that differ by more than 0.2 can't be 0.8 similar.
            if c == sets[j] or sum(min(c[k] / size[i], sets[j][k] / size[j]) for k in c.keys() & sets[j].keys()) >= 0.8 and brute_similarity(c, sets[j]) >= 0.8:
                links += 1
                found += got[i] == got[j]
    assert links > 50 and found == links


def test_near_duplicates_of_a_group_without_its_centre(spark):
    """Many copies of one text, each with edits of its own, and no copy without edits."""
    rng = random.Random(11)
    base, rows = words(rng, 150), []
    for i in range(160):
        copy = list(base)
        for at in rng.sample(range(150), rng.choice((1, 2, 3, 4, 6))):
            copy[at] = f"x{rng.randrange(100000)}"
        rows.append((i, " ".join(copy)))
    got = {r.doc_id: r.class_id for r in near_dedup.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute_classes(rows)


def test_components_of_a_long_chain_in_order(spark):
    rounds = []
    links = spark.range(1000).select((1 + F.col("id")).alias("b"), F.col("id").alias("a"))
    found = near_dedup.components(links, rounds=rounds).collect()
    assert len(found) == 1001 and {r.component for r in found} == {0}
    assert len(rounds) <= 10 and sum(rounds) <= 22
    rng = random.Random(1)
    name = list(range(300))
    rng.shuffle(name)
    links = [(name[i], name[i + 1]) for i in range(299) if i % 50] + [(5, 5)]
    found = {r.vertex: r.component for r in near_dedup.components(spark.createDataFrame(links, "a long, b long"), rounds=rounds).collect()}
    want = {name[i]: min(name[j] for j in range(300) if (j - 1) // 50 == (i - 1) // 50) for i in range(1, 300)}
    assert {v: found[v] for v in want} == want


def test_near_duplicates_with_clashing_columns_repeated_ids_and_a_long_text(spark):
    text = " ".join(f"t{i}" for i in range(40))
    long = " ".join(f"v{i % 5003}" for i in range(150_000))
    rows = [(1, text), (2, text + " more"), (2, "quite another text of the same id"), (3, long), (4, long + " end"), (5, None)]
    docs = spark.createDataFrame([(i, t, *"abcdefg") for i, t in rows], "doc_id long, text string, row string, doc string, key string, gone_id string, GONE_ROW string, vertex string, `group` string")
    kept = near_dedup.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in kept.collect()) == [(1, text), (2, rows[2][1]), (3, long), (5, "")]


def test_exact_dedup_with_clashing_columns_long_texts_and_repeated_rows(spark):
    long = "Lorem Ipsum " * 100_000
    rows = [(1, long, "a"), (2, long.upper(), "b"), (3, long + "!", "c"), (4, "x", "second"), (4, "x", "first"), (4, "x", None)]
    docs = spark.createDataFrame([(*r, "k", "p") for r in rows], "doc_id long, text string, stay_key string, __key string, STAY_PLACE string")
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    out = sorted((r.doc_id, r.stay_key) for r in kept.collect())
    assert [i for i, _ in out] == [2, 3, 4]
    again = sorted((r.doc_id, r.stay_key) for r in exact_dedup.drop_exact_copies(docs.repartition(5)).collect())
    assert out == again  # of repeated rows the same one stays


def test_texts_that_share_a_key_are_told_apart(spark):
    rows = [(1, 5, 7, 70, [1]), (2, 6, 7, 71, [2]), (3, 7, 7, 70, [1]), (4, 8, 9, 1, [3])]
    out = near_dedup._apart(spark.createDataFrame(rows, "doc long, row long, key long, more long, sign array<int>"))
    keys = {r.doc: r.key for r in out.collect()}
    assert keys[1] == keys[3] == 7 and keys[4] == 9 and keys[2] not in (7, 9)
    assert near_dedup._apart(out.filter("doc != 2")).filter("key = 7").count() == 2
