"""Text features of a (flyer text, master text) pair, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The default weights of the four features.
WEIGHTS = {"devowel": 0.4, "upper": 0.4, "first": 0.2, "word": 0.5}
WORD = "[A-Za-z]+"
_NUMBER = r"[-+]?[0-9]*\.?[0-9]+"


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def clean_text_start(c: Column) -> Column:
    """Trimmed, without leading characters that are neither letters nor digits."""
    return F.regexp_replace(F.trim(_text(c)), r"^[^\p{L}\p{N}]+", "")


def ascii_words(c: Column) -> Column:
    return F.regexp_extract_all(clean_text_start(c), F.lit(f"({WORD})"), F.lit(1))


def _devowel_word(w: Column) -> Column:
    return F.concat(F.left(w, F.lit(1)), F.translate(F.substr(w, F.lit(2)), "aeiouAEIOU", ""))


def devowel(c: Column) -> Column:
    """ASCII words joined, each without its vowels after the first letter."""
    return F.array_join(F.transform(ascii_words(c), _devowel_word), "")


def devowel_prefix_match(a: Column, b: Column) -> Column:
    x, y = F.lower(devowel(a)), F.lower(clean_text_start(b))
    return ((x != "") & (y != "") & (F.left(x, F.lit(3)) == F.left(y, F.lit(3)))).cast("int")


def first_word_length(b: Column) -> Column:
    """The length of the first word between spaces; 0 for a blank text."""
    return F.length(F.regexp_extract(F.trim(_text(b)), r"^\S+", 0))


def upper_abbrev(c: Column, n: Column) -> Column:
    """The letters A-Z of a text, padded with `_` or cut to n characters; n of 0 leaves them as they are."""
    letters = F.regexp_replace(_text(c), "[^A-Z]", "")
    return F.when(F.trim(_text(c)) == "", "").when(n > 0, F.rpad(letters, n, F.lit("_"))).otherwise(letters)


def upper_abbrev_match(a: Column, b: Column) -> Column:
    n = first_word_length(b)
    return (upper_abbrev(a, n) == upper_abbrev(b, n)).cast("int")


def first_char(c: Column) -> Column:
    return F.lower(F.left(clean_text_start(c), F.lit(1)))


def first_char_match(a: Column, b: Column) -> Column:
    return ((first_char(a) != "") & (first_char(a) == first_char(b))).cast("int")


def word_variants(a: Column) -> Column:
    """The distinct lower-case words of a text as they are, devowelled, and devowelled but for the last letter."""
    words = ascii_words(a)
    keep_last = lambda w: F.when(F.length(w) <= 2, w).otherwise(F.concat(_devowel_word(F.substr(w, F.lit(1), F.length(w) - 1)), F.right(w, F.lit(1))))
    lower = lambda ws: F.transform(ws, F.lower)
    return F.array_union(F.array_union(lower(words), lower(F.transform(words, _devowel_word))), lower(F.transform(words, keep_last)))


def lower_words(b: Column) -> Column:
    return F.array_distinct(F.transform(ascii_words(b), F.lower))


def overlapping_words(a: Column, b: Column) -> Column:
    return F.array_intersect(lower_words(b), word_variants(a))


def word_variant_overlap(a: Column, b: Column) -> Column:
    """How many distinct words of b a has in some variant."""
    return F.size(overlapping_words(a, b))


def boost_parts(a: Column, b: Column) -> dict[str, Column]:
    return {"devowel": devowel_prefix_match(a, b), "upper": upper_abbrev_match(a, b), "first": first_char_match(a, b), "word": word_variant_overlap(a, b)}


def boost_score(a: Column, b: Column, weights: dict[str, float] | None = None) -> Column:
    """The weighted sum of the four features."""
    return weighted(boost_parts(a, b), weights)


def weighted(parts: dict[str, Column], weights: dict[str, float] | None) -> Column:
    """The weighted sum of the features' counts."""
    w = {**WEIGHTS, **(weights or {})}
    return sum((parts[k] * F.lit(w[k]) for k in ("upper", "first", "word")), parts["devowel"] * F.lit(w["devowel"]))


def flyer_features(a: Column) -> Column:
    """What the four features need of a flyer text; capitals are null for a blank one."""
    capitals = F.when(F.trim(_text(a)) != "", F.regexp_replace(_text(a), "[^A-Z]", ""))
    return F.struct(F.left(F.lower(devowel(a)), F.lit(3)).alias("prefix"), capitals.alias("capitals"), first_char(a).alias("first"), word_variants(a).alias("words"))


def master_features(b: Column) -> Column:
    """What the four features need of a master text."""
    n = first_word_length(b)
    return F.struct(F.left(F.lower(clean_text_start(b)), F.lit(3)).alias("prefix"), upper_abbrev(b, n).alias("abbreviation"), n.alias("n"), first_char(b).alias("first"), lower_words(b).alias("words"))


def featured_boost(f: Column, m: Column, weights: dict[str, float] | None = None) -> Column:
    """`boost_score` from the features of both sides, so that texts are taken apart once a row and not once a pair."""
    own = F.when(m["n"] > 0, F.rpad(f["capitals"], m["n"], F.lit("_"))).otherwise(f["capitals"])
    parts = {
        "devowel": ((f["prefix"] != "") & (f["prefix"] == m["prefix"])).cast("int"),
        "upper": (F.coalesce(own, F.lit("")) == m["abbreviation"]).cast("int"),
        "first": ((f["first"] != "") & (f["first"] == m["first"])).cast("int"),
        "word": F.size(F.array_intersect(m["words"], f["words"])),
    }
    return weighted(parts, weights)


def tokenize(c: Column) -> Column:
    """Lower-case Unicode words after all but word characters and spaces is removed."""
    plain = F.regexp_replace(F.lower(F.trim(_text(c))), r"(?U)[^\w\s]", "")
    return F.regexp_extract_all(plain, F.lit(r"(?U)(\w+)"), F.lit(1))


def match_text(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(_text(c))), r"[^a-z0-9\s]", "")


def contained(flyer: Column, field: Column) -> Column:
    """Whether the cleaned master text is part of the cleaned flyer text, both non-empty; a list is joined by spaces before."""
    a, b = match_text(flyer), match_text(field)
    return (a != "") & (b != "") & a.contains(b)


def match_score(flyer: Column, field: Column, fuzzy: Column, mode: str, threshold: float = 0.0) -> Column:
    """(score, mode, field, flyer): 1 with mode `full_string` where contained, else `fuzzy` / 100 if that reaches the threshold, else 0."""
    a, b = match_text(flyer), match_text(field)
    empty, whole = (a == "") | (b == ""), contained(flyer, field)
    score = F.when(empty, 0.0).when(whole, 1.0).when(fuzzy / 100 >= threshold, fuzzy / 100).otherwise(0.0)
    return F.struct(score.alias("score"), F.when(empty, None).when(whole, "full_string").otherwise(mode).alias("mode"), b.alias("field"), a.alias("flyer"))


def first_number(c: Column) -> Column:
    """The first number in a model's answer, else null."""
    return F.regexp_extract(_text(c), _NUMBER, 0).try_cast("double")


def word_jaccard(a: Column, b: Column) -> Column:
    """A stand-in model score: distinct lower-case words in common by distinct words in all."""
    x, y = F.array_distinct(tokenize(a)), F.array_distinct(tokenize(b))
    every = F.size(F.array_union(x, y))
    return F.when(every > 0, F.size(F.array_intersect(x, y)) / every).otherwise(0.0)
