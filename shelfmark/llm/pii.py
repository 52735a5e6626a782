"""Surrogates for personal data.

E-mail addresses, telephone numbers, IP addresses (v4 and v6), account (IBAN) and card numbers, and names after a form of address, with all further mentions of
these names in the same text, are replaced by keyed
surrogates of the same type: letters by letters of the same script and case, digits by digits in the same format, addresses that stay valid but are nobody's (e-mail
under reserved domains, IP in reserved blocks, private blocks in themselves), card
numbers that stay or don't become valid alike, names with the gender that the form of address gives.

An entity is what a mention means: an e-mail address in lower case, a number by its digits, a name by its part and lower-cased spelling. One entity has
one surrogate in all documents (coreference), written in the format of each mention. A surrogate that another entity has, or that is itself an
entity of the corpus, is a collision: the entity that comes later tries the next surrogate of its keyed series until none collide, so distinct
entities stay distinct. Collisions are found by grouping all entities by surrogate. Where a format is so full that `SPARE` attempts all hit entities of the corpus,
a surrogate may be such an entity, though never another's surrogate; where even `MOST` attempts don't set a kind's entities apart, the job fails and says so.

A given name after an open form of address (`Dr`) has the gender that the same full name has elsewhere in its text, else the one gender that the given
name has in the corpus, else its own kind.

Only entities are gathered and joined, and only documents that may hold one are shuffled for replacement; all others pass by.

Defined results: null texts stay null and have no entities. Rows that repeat a doc_id get the same surrogates. Texts of any length are searched whole. Names that no form
of address introduces anywhere in their text aren't found. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import hmac
import ipaddress
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import small_batches, store, table

#: For tests and comparison; a deployment passes a key of its own.
KEY = b"shelfmark"
SPARE, MOST, SMALL_BLOCK = 64, 128, 8

# Forms of address by gender, reserved domains, and the syllables and endings of surrogate names.
MALE, FEMALE, OPEN = ("Mr", "Herr", "Herrn", "Monsieur", "Sr", "Señor"), ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Sra", "Señora"), ("Dr", "Prof")
RESERVED = ("example.com", "example.net", "example.org")
SYLLABLES = "ba be bo da de do fa fe ga go ha he ka ke ko la le lo ma me mo na ne no pa pe ra re ro sa se so ta te to va ve wi".split()
ENDINGS = {"m": "n r s k d".split(), "f": "a ia ina elle ette".split(), "x": "l y n e r".split(), "s": "mann son ez ier ini ard".split()}

_NAME = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"
_FIND = re.compile(
    r"(?<![\w.+-])(?P<email>[\w.+-]+@[\w-]+(?:\.[\w-]+)+)"
    r"|(?<![\w.])(?P<ip>(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?![\w]|\.\d)"
    r"|(?<![\w:.])(?P<ipv6>(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}|(?:[0-9a-fA-F]{1,4}:){1,6}(?::[0-9a-fA-F]{1,4}){1,6}|::(?:[0-9a-fA-F]{1,4}:){0,5}[0-9a-fA-F]{1,4})(?![\w:])"
    r"|(?<!\w)(?P<iban>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?!\w)"
    r"|(?<![\w.+-])(?P<card>\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7})(?![\w]|-\d)"
    r"|(?<![\w.])(?P<phone>\+\d{7,15}|\d{10,12}|0\d(?:[ .-]\d{2}){4}|\+\d{1,3}[ .-]?(?:\(0\)[ .-]?)?\d{1,2}(?:[ .-]\d{2}){3,5}|(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]?\d{3,4})(?![\w]|[.-]\d)"
    r"|(?<![\w-])(?P<ssn>\d{3}-\d{2}-\d{4})(?![\w-])"
    rf"|\b(?P<title>{'|'.join((*MALE, *FEMALE, *OPEN))})\b\.? (?P<names>{_NAME}(?: {_NAME}){{0,2}})"
)
_COUNTRY = re.compile(r"\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})")
#: What a text with any entity has.
MAY_HOLD = rf"\p{{Nd}}|@|[0-9a-fA-F]:[0-9a-fA-F:]|\b({'|'.join((*MALE, *FEMALE, *OPEN))})\b"


def _gender(title: str) -> str:
    return "m" if title in MALE else "f" if title in FEMALE else "x"


def _is_ipv6(mention: str) -> bool:
    try:
        return bool(ipaddress.IPv6Address(mention))
    except ValueError:
        return False


def _entity(kind: str, mention: str) -> str:
    if kind == "ipv6":
        return str(ipaddress.IPv6Address(mention))
    if kind in ("email", "ip"):
        return mention.lower()
    if kind == "iban":
        return mention.replace(" ", "")
    # A number without separators has its country's code in front: of one digit, of two as listed, else of three.
    country = _COUNTRY.match(mention) if re.fullmatch(r"\+\d+", mention) else re.match(r"\+\d+", mention)
    return re.sub(r"\D", "", mention) if not country else f"{country[0]}:{re.sub(r'\D', '', mention[country.end():])}"


def mentions(text: str | None) -> Iterator[tuple[int, int, str, str]]:
    """(begin, end, kind, entity) of each mention, in text order. Kinds of names: given-m, given-f, given-x and surname."""
    text, found, people = text or "", [], []
    for m in _FIND.finditer(text):
        kind = m.lastgroup
        if kind == "ipv6" and not _is_ipv6(m[kind]):
            continue
        if kind != "names":
            found.append((m.start(kind), m.end(kind), kind, _entity(kind, m[kind])))
            continue
        parts = []
        for w in re.finditer(r"\S+", m["names"]):
            if not w[0][0].isupper():
                break
            name = re.sub(r"(?<=..)['’]s$", "", w[0])
            parts.append((m.start("names") + w.start(), m.start("names") + w.start() + len(name), name.lower()))
        if parts:
            people.append((_gender(m["title"]), parts))
    if people:
        found = sorted([*found, *_named(text, people, [x[:2] for x in found])])
    yield from found


def _named(text: str, people: list[tuple[str, list[tuple[int, int, str]]]], taken: list[tuple[int, int]]) -> list[tuple[int, int, str, str]]:
    """All mentions of the people that forms of address name in a text."""
    full = lambda parts: tuple(p[2] for p in parts)
    genders: dict[tuple[str, ...], set[str]] = {}
    for gender, parts in people:
        genders.setdefault(full(parts), set()).update({gender} - {"x"})
    found, kinds, persons = [], {}, {}
    for gender, parts in people:
        known = genders[full(parts)]
        kind = f"given-{next(iter(known)) if gender == 'x' and len(known) == 1 else gender}"
        for i, (begin, end, name) in enumerate(parts):
            own = kind if i < len(parts) - 1 else "surname"
            found.append((begin, end, own, name))
            kinds.setdefault(name, own)
            if own != "surname":
                persons.setdefault((name, parts[i + 1][2]), own)
    spans = sorted([*taken, *(x[:2] for x in found)])
    starts = [x[0] for x in spans]
    either = "|".join(map(re.escape, sorted(kinds, key=lambda n: (-len(n), n))))
    further = [m for m in re.finditer(rf"(?<![\w@])(?:{either})(?!\w)", text, re.I) if m[0][0].isupper() and m[0].lower() in kinds]
    for m, after in zip(further, [*further[1:], None], strict=True):
        at = bisect_right(starts, m.start()) - 1
        if at >= 0 and spans[at][1] > m.start() or at + 1 < len(spans) and spans[at + 1][0] < m.end():
            continue
        name = m[0].lower()
        pair = (name, after[0].lower()) if after and text[m.end() : after.start()] == " " else None
        found.append((m.start(), m.end(), persons.get(pair, kinds[name]), name))
    return found


class Draws:
    """A keyed endless series of numbers for one entity and attempt."""

    def __init__(self, key: bytes, kind: str, entity: str, attempt: int) -> None:
        self.seed, self.block, self.at = f"{kind}\0{entity}\0{attempt}".encode("utf-8", "surrogatepass"), 0, 0
        self.key, self.bytes = key, b""

    def below(self, n: int) -> int:
        if self.at + 4 > len(self.bytes):
            self.bytes, self.at, self.block = hmac.new(self.key, self.seed + self.block.to_bytes(4, "big"), hashlib.sha256).digest(), 0, self.block + 1
        self.at += 4
        return int.from_bytes(self.bytes[self.at - 4 : self.at], "big") % n


def _luhn(digits: str) -> int:
    return sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10


def _script(letter: str) -> str:
    return unicodedata.name(letter, "LATIN").split()[0]


def _letter(draws: Draws, letter: str) -> str:
    """A letter of the same script: from the basic range of its alphabet."""
    first, count = {"GREEK": (0x3B1, 17), "CYRILLIC": (0x430, 32), "HEBREW": (0x5D0, 22), "ARABIC": (0x628, 19), "HIRAGANA": (0x3042, 80), "KATAKANA": (0x30A2, 80), "CJK": (0x4E00, 5000), "HANGUL": (0xAC00, 5000), "DEVANAGARI": (0x915, 36)}.get(_script(letter), (0x61, 26))
    return chr(first + draws.below(count))


def _spelled(draws: Draws, text: str) -> str:
    return "".join(str(draws.below(10)) if c.isdigit() else _letter(draws, c) if c.isalpha() else c for c in text)


def _ip(draws: Draws, entity: str, attempt: int) -> str:
    """An address of the same private block, or of the block that is reserved for the future. A small block may be full: later attempts of its addresses are from the largest private one."""
    parts = [int(p) for p in entity.split(".")]
    some = [1 + draws.below(254) for _ in range(3)]
    if parts[:2] == [192, 168] and attempt < SMALL_BLOCK:
        return f"192.168.{some[0]}.{some[1]}"
    if parts[0] == 172 and 16 <= parts[1] < 32 and attempt < SMALL_BLOCK:
        return f"172.{16 + draws.below(16)}.{some[0]}.{some[1]}"
    private = parts[0] == 10 or parts[:2] == [192, 168] or parts[0] == 172 and 16 <= parts[1] < 32
    first = 10 if private else 127 if parts[0] == 127 else 240 + draws.below(15)
    return ".".join(map(str, (first, *some)))


def surrogate(key: bytes, kind: str, entity: str, attempt: int) -> str:
    """The surrogate entity of an attempt, in the spelling of entities."""
    draws = Draws(key, kind, entity, attempt)
    if kind == "email":
        local, _, domain = entity.partition("@")
        kept = next((r for r in RESERVED if domain == r or domain.endswith(f".{r}")), "")
        rest, end = (domain[: len(domain) - len(kept)], kept) if kept else (domain[: domain.rindex(".") + 1], "example")
        # A short address has few of its kind: later attempts are longer.
        return _spelled(draws, local + "x" * min(attempt, 40)) + "@" + _spelled(draws, rest) + end
    if kind == "ip":
        return _ip(draws, entity, attempt)
    if kind == "ipv6":
        # An address of the range for documentation.
        return str(ipaddress.IPv6Address((0x20010DB8 << 96) + sum(draws.below(1 << 16) << 16 * i for i in range(6))))
    if kind == "card":
        body = str(1 + draws.below(9)) + "".join(str(draws.below(10)) for _ in entity[2:])
        check = (10 - _luhn(body + "0")) % 10
        return body + str(check if _luhn(entity) == 0 else (check + 1 + draws.below(9)) % 10)
    if kind == "iban":
        body = "".join(str(draws.below(10)) if c.isdigit() else chr(65 + draws.below(26)) for c in entity[4:])
        left = lambda iban: int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97
        check = 98 - left(f"{entity[:2]}00{body}")
        return f"{entity[:2]}{check if left(entity) == 1 else (check + 1 + draws.below(95)) % 97:02d}{body}"
    if kind in ("phone", "ssn"):
        country, colon, number = entity.rpartition(":")
        return country + colon + "".join(str(draws.below(10)) for _ in number)
    if entity and _script(entity[0]) != "LATIN":
        return _spelled(draws, entity + entity[-1] * min(attempt, 40))
    size = 2 + draws.below(2) + attempt // 2
    return "".join(SYLLABLES[draws.below(len(SYLLABLES))] for _ in range(size)) + ENDINGS[kind[-1] if kind != "surname" else "s"][draws.below(5)]


def dressed(kind: str, new: str, mention: str) -> str:
    """A surrogate in the format of a mention: separators of numbers, case of letters."""
    if kind in ("card", "phone", "ssn"):
        digits = iter(new.replace("+", "").replace(":", ""))
        return "".join(next(digits) if c.isdigit() else c for c in mention)
    if kind == "iban":
        signs = iter(new)
        return "".join(c if c == " " else next(signs) for c in mention)
    if kind in ("ip", "ipv6"):
        return new
    if kind == "email":
        return new.upper() if mention.isupper() else new
    return new.upper() if mention.isupper() and len(mention) > 1 else new[:1].upper() + new[1:]


def _found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = [(row, kind, entity) for row, text in zip(batch["row"], batch["text"], strict=True) for kind, entity in sorted({m[2:] for m in mentions(text)})]
        yield pd.DataFrame(rows, columns=["row", "kind", "entity"])


def surrogates(entities: DataFrame, key: bytes = KEY, spare: int = SPARE, most: int = MOST) -> DataFrame:
    """kind, entity -> kind, entity, surrogate, one to one within a kind; within `spare` attempts never an entity of the same kind."""

    @F.pandas_udf("string")
    def draw(kind: pd.Series, entity: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(key, *x) for x in zip(kind, entity, attempt, strict=True)])

    real = entities.select("kind", F.col("entity").alias("surrogate"), F.lit(True).alias("real"))
    rows, settled, tries = entities, None, 0
    while True:
        # What is settled stays; only entities that clash are drawn and written again.
        drawn = store(rows.withColumn("surrogate", draw("kind", "entity", F.lit(tries))), "drawn")
        turn = F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("entity"))
        checked = drawn.withColumn("clash", turn > 1)
        if tries < spare:
            checked = checked.join(real, ["kind", "surrogate"], "left").withColumn("clash", F.col("clash") | F.col("real").isNotNull()).drop("real")
        if settled is not None:
            held = settled.select("kind", "surrogate", F.lit(True).alias("held"))
            checked = checked.join(held, ["kind", "surrogate"], "left").withColumn("clash", F.col("clash") | F.col("held").isNotNull()).drop("held")
        checked = store(checked.select("kind", "entity", "surrogate", "clash"), "surrogates")
        good, rows = checked.filter("NOT clash").drop("clash"), checked.filter("clash").select("kind", "entity")
        settled = good if settled is None else settled.unionByName(good)
        if rows.isEmpty():
            return settled.select("kind", "entity", "surrogate")
        if tries >= most:
            full = [r[0] for r in rows.select("kind").distinct().orderBy("kind").limit(9).collect()]
            raise ValueError(f"no distinct surrogates after {tries} attempts for {', '.join(full)}: the format has too few values")
        tries += 1


def _replace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts, counts = [], []
        for text, pairs in zip(batch["text"], batch["pairs"], strict=True):
            new = {(p["kind"], p["entity"]): p["surrogate"] for p in ([] if pairs is None else pairs)}
            out, at, n = [], 0, 0
            for begin, end, kind, entity in mentions(text):
                out += [text[at:begin], dressed(kind, new[kind, entity], text[begin:end])]
                at, n = end, n + 1
            texts.append("".join(out) + text[at:])
            counts.append(n)
        yield pd.DataFrame({"doc_id": batch["doc_id"], "text": texts, "n_mentions": counts})


def pseudonymised(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """One row per row of `docs` (doc_id, text): doc_id, text with surrogates, n_mentions."""
    small_batches(docs.sparkSession, 500)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    may = F.coalesce(F.col("text").rlike(MAY_HOLD), F.lit(False))
    # A row goes by its whole text: what repeats has the same entities.
    held = rows.filter(may).withColumn("row", F.md5(F.encode("text", "UTF-8")))
    found = store(held.select("row", "text").mapInPandas(_found, "row string, kind string, entity string").distinct(), "entities")
    # Given names of open gender go by the one gender that the corpus knows them with.
    known = found.filter("kind IN ('given-m', 'given-f')").groupBy("entity").agg(F.min("kind").alias("known"), F.max("kind").alias("other")).filter("known = other")
    of = found.select("kind", "entity").distinct().join(known.drop("other"), "entity", "left")
    of = store(of.withColumn("as", F.when(F.col("kind") == "given-x", F.coalesce("known", "kind")).otherwise(F.col("kind"))).select("kind", "entity", "as"), "kinds")
    new = surrogates(of.select(F.col("as").alias("kind"), "entity").distinct(), key).withColumnRenamed("kind", "as")
    new = of.join(new, ["as", "entity"]).drop("as")
    pairs = found.join(new, ["kind", "entity"]).groupBy("row").agg(F.collect_list(F.struct("kind", "entity", "surrogate")).alias("pairs"))
    changed = held.join(pairs, "row", "left").select("doc_id", "text", "pairs").mapInPandas(_replace, "doc_id long, text string, n_mentions long")
    return changed.union(rows.filter(~may).select("doc_id", "text", F.lit(0).cast("long")))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymised(table(spark, sf_dir, "documents"))
