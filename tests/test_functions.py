"""Scalar functions against values worked out by hand."""

import random

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import fuzzy
from shelfmark.functions import numeric as nm
from shelfmark.functions import text as tx


def one(spark, **named):
    """Columns of one row: name=(function, arguments...)."""
    values = {f"{n}_{i}": v for n, (_, *args) in named.items() for i, v in enumerate(args)}
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return df.select(*[f(*[F.col(f"{n}_{i}") for i in range(len(args))]).alias(n) for n, (f, *args) in named.items()]).first()


def test_text_features(spark):
    r = one(
        spark,
        start=(tx.clean_text_start, "  **Éclair 3"), none=(tx.clean_text_start, None), devowel=(tx.devowel, "Orange Juice a 12"),
        prefix=(tx.devowel_prefix_match, "Choc bar", "CHC milk"), blank=(tx.devowel_prefix_match, "", ""),
        upper=(tx.upper_abbrev_match, "no capitals", "none here"), other=(tx.upper_abbrev_match, "ABC def", "ABCD x"), first=(tx.first_char_match, "*apple", "Avocado"),
        words=(tx.overlapping_words, "Peanut Butter", "PNT BTTR pntt butter"), count=(tx.word_variant_overlap, "Peanut Butter", "PNT BTTR pntt butter"),
        tokens=(tx.tokenize, " Crème-brûlée, 2x! "), number=(tx.first_number, "between 0 and 1: 0.8"), signed=(tx.first_number, "score -.5"), nothing=(tx.first_number, "none"),
        inside=(tx.contained, "Big Coca-Cola 2L", "coca cola"), joined=(tx.contained, "Big CocaCola", "coca-cola"), empty=(tx.contained, "abc", "!!"),
    )
    assert r.start == "Éclair 3" and r.none == "" and r.devowel == "OrngJca" and r.prefix == 1 and r.blank == 0
    assert r.upper == 1 and r.other == 0 and r.first == 1 and sorted(r.words) == ["bttr", "butter", "pnt"] and r["count"] == 3
    assert r.tokens == ["crèmebrûlée", "2x"] and r.number == 0 and r.signed == -0.5 and r.nothing is None
    assert r.inside is False and r.joined is True and r.empty is False


def test_boost_is_the_weighted_sum(spark):
    df = spark.createDataFrame([("Peanut Butter", "PNT BTTR")], "a string, b string")
    parts = df.select(*[v.alias(k) for k, v in tx.boost_parts(F.col("a"), F.col("b")).items()], tx.boost_score(F.col("a"), F.col("b")).alias("boost")).first()
    assert parts.boost == pytest.approx(0.4 * parts.devowel + 0.4 * parts.upper + 0.2 * parts.first + 0.5 * parts.word)
    assert (parts.devowel, parts.first, parts.word) == (1, 1, 2)


def test_match_score(spark):
    df = spark.createDataFrame([("big apple pie", "apple"), ("big apple pie", "apple tart"), ("", "apple")], "a string, b string")
    rows = df.select(tx.match_score(F.col("a"), F.col("b"), F.lit(70.0), "wratio", 0.6)["score"].alias("s"), tx.match_score(F.col("a"), F.col("b"), F.lit(70.0), "wratio", 0.8)["score"].alias("t")).collect()
    assert [tuple(r) for r in rows] == [(1.0, 1.0), (0.7, 0.0), (0.0, 0.0)]


@pytest.mark.parametrize(
    "a, b, want",
    [("12 oz", "12 oz", 100), ("10-14 oz", "12", 100), ("10-14 oz", "15 oz", 93.33), ("0-4", "9", 0), ("0", "5", 0), ("8", "10", 80), ("8", "6-10", 100), ("x", "10", 0), (None, "1", 0), ("1 2 3", "1", 100), ("1,299", "299", 100)],
)
def test_number_similarity(spark, a, b, want):
    assert one(spark, s=(nm.number_similarity, a, b)).s == pytest.approx(want)


@pytest.mark.parametrize("a1, a2, f1, f2, want", [("$4.00", "$2.00", "2", "1", 100), ("$1,000", "$900", "1", "1", 90), ("x", "1", "1", "1", 0), ("1", "1", "0", "1", 0), ("1", "2d", "1", "1", 0)])
def test_unit_price_similarity(spark, a1, a2, f1, f2, want):
    assert one(spark, s=(nm.unit_price_similarity, a1, a2, f1, f2)).s == pytest.approx(want)


def test_coercion(spark):
    df = spark.createDataFrame([("0.456", "abc", "85"), (None, "1d", "0.5")], "a string, b string, c string")
    assert [tuple(r) for r in nm.coerce_scores(df, ["a", "b", "x"]).select("a", "b").collect()] == [(0.46, 0.0), (0.0, 0.0)]
    assert [r[0] for r in df.select(nm.score_to_unit(F.col("c"))).collect()] == [0.85, 0.5]


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def test_fuzzy_ratios():
    rng = random.Random(1)
    for _ in range(100):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randrange(0, n))) for n in (12, 90))
        assert fuzzy.lcs(fuzzy.coded([a]), fuzzy.coded([b]))[0] == slow_lcs(a, b)
        if a and b:
            short, long = sorted((a, b), key=len)
            windows = {long[max(0, i) : i + len(short)] for i in range(1 - len(short), len(long))}
            assert fuzzy.partial_ratio(a, b) == pytest.approx(max(200 * slow_lcs(short, w) / (len(short) + len(w)) for w in windows))
    assert fuzzy.ratio("abcd", "abcd") == 100 and fuzzy.partial_ratio("bcd", "abcde") == 100
    assert fuzzy.wratio("new york mets", "mets new york") == pytest.approx(95) and fuzzy.wratio("", "x") == 0
    assert 0 <= fuzzy.wratio("a", "a long text without it") <= 100


def test_ratios_against_slow_versions():
    import random

    from shelfmark.functions import fuzzy

    def slow_lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
        return row[-1]

    ratio = lambda a, b: 200 * slow_lcs(a, b) / (len(a) + len(b)) if a or b else 100.0

    def partial(a, b):
        if not a or not b:
            return 100.0 if a == b else 0.0
        s, t = sorted((a, b), key=len)
        return max(ratio(s, t[max(0, i) : i + len(s)]) for i in range(1 - len(s), len(t)))

    def tokens(a, b, by):
        x, y = set(a.split()), set(b.split())
        join = lambda w: " ".join(sorted(w))
        sort = by(join(a.split()), join(b.split()))
        if not x or not y:
            return sort
        both = join(x & y)
        left, right = (f"{both} {join(s)}".strip() for s in (x - y, y - x))
        return max(sort, by(left, right), *((by(both, left), by(both, right)) if both else ()))

    def wratio(a, b):
        if not a or not b:
            return 0.0
        longer = max(len(a), len(b)) / min(len(a), len(b))
        if longer < 1.5:
            return max(ratio(a, b), 0.95 * tokens(a, b, ratio))
        scale = 0.9 if longer <= 8 else 0.6
        return max(ratio(a, b), scale * partial(a, b), 0.95 * scale * tokens(a, b, partial))

    rng = random.Random(3)
    some = ["", "a", "tea bags", "x" * 70]
    for _ in range(60):
        some.append(" ".join("".join(rng.choice("abcd") for _ in range(rng.randrange(1, 6))) for _ in range(rng.randrange(1, 7))))
    for _ in range(300):
        a, b = rng.choice(some), rng.choice(some)
        assert fuzzy.partial_ratio(a, b) == partial(a, b) and abs(fuzzy.wratio(a, b) - wratio(a, b)) < 1e-9, (a, b)


def test_ratios_of_batches_are_those_of_single_pairs(monkeypatch):
    """Many pairs at once, of all lengths about a word of 64 letters and with repeated words, in lanes of few and of many."""
    import numpy as np

    rng = random.Random(5)
    text = lambda n, letters: "".join(rng.choice(letters) for _ in range(n))
    xs = [text(n, "ab  c") for n in (0, 1, 2, 9, 31, 63, 64, 65, 127, 128, 129, 200)] + ["tea tea tea", "tea bag", " ", "bag  tea", "a b c d"]
    ys = [text(n, "abcd ") for n in (0, 1, 3, 8, 40, 64, 65, 130)] + ["tea", "bag of tea", "x y z", "bag tea"]
    i, j = (a.ravel() for a in np.meshgrid(range(len(xs)), range(len(ys)), indexing="ij"))
    for lanes in (7, 1 << 16):
        monkeypatch.setattr(fuzzy, "LANES", lanes)
        plain = fuzzy.ratios(fuzzy.coded(xs)[i], fuzzy.coded(ys)[j])
        partial, weighted = fuzzy.pair_partial_ratios(xs, i, ys, j), fuzzy.pair_wratios(xs, i, ys, j)
        for k in rng.sample(range(len(i)), 60):
            a, b = xs[i[k]], ys[j[k]]
            assert plain[k] == (200 * slow_lcs(a, b) / (len(a) + len(b)) if a or b else 100)
            assert partial[k] == fuzzy.partial_ratio(a, b) and weighted[k] == fuzzy.wratio(a, b), (a, b)
    none = np.zeros(0, int)
    assert len(fuzzy.pair_wratios([], none, [], none)) == len(fuzzy.pair_partial_ratios(["a"], none, ["b"], none)) == 0


def test_searches_above_a_bound_find_what_is_above():
    rng = random.Random(6)
    a, b = (fuzzy.coded(["".join(rng.choice("abcde") for _ in range(rng.randrange(1, 50))) for _ in range(300)]) for _ in range(2))
    every = fuzzy.partial_ratios(a, b)
    for above in (0.0, 50.0, 70.0, 100.0):
        found = fuzzy.partial_ratios(a, b, above)
        assert (found[every > above] == every[every > above]).all() and (found[every <= above] <= above).all()
