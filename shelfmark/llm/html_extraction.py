"""HTML extraction by equivalence-class template deduction.

Tokens are the begins and ends of a page's elements, told apart by their path, and its text blocks, told apart by path and wording. Over the pages of one
host each token has an occurrence vector: how often each page has it. Tokens with equal vectors form an equivalence class, if it has
tags and covers at least `LEAST_PAGES` pages and half of the host. On each page a class is tried for two properties: it is ordered if its tokens
come as repetitions of one sequence, and it is nested if each repetition lies within one gap of the class around it or in none, as brackets do.
A class is valid if more than half of its pages agree on its sequence and on the class and gap it lies in, and the class around it is valid; valid classes, each in its
parent's gap, are the host's template. Text blocks in them are template text, such as the same notice on each page; what they leave are slots.
The text of the page is that of the slots under its articles, or of all slots where a page marks none, less elements
whose tag or role says that they are menus, headers, footers, sidebars, notices, adverts, forms or comments. A class or id that says so must
say it as a whole name (`sidebar`, `cookie-notice`, not `has-sidebar`), and drops its element, of any length, unless that holds all of the page's articles, or all its first headings where no article
is marked; the id of a heading or paragraph says nothing. Inside `<article>` only names of these kinds count: `related`, `search` or `share` drop nothing
there (in `<main>` they do), controls outside a form keep their text, and text that pages share is kept.

Vectors are never gathered: a page adds the hash of (page, count) to a token's running exclusive-or, so a host with a third of all pages costs what
its pages cost, pre-aggregated before each shuffle. Pages of a host with the same text count once. A token that half of a host's pages have is one of
at most twice as many as an average page has, so a host's classes and template are of a page's size; they are broadcast up to `BROADCAST_ROWS` tokens (16 bytes each) and
joined by host beyond.

Defined results: a null html is empty, and a page without text gives an empty string. Null urls are one host. Repeated rows give repeated
results. Hosts of fewer than `LEAST_PAGES` pages have no template. Pages of any length are read whole, one at a time. Other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, store, table

LEAST_PAGES, BROADCAST_ROWS = 4, 200_000
MAIN, ARTICLE = 1, 2

# Element names and words in class and id names, by what they are for.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
BLOCK = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
CLOSES_P = BLOCK - {"html", "body", "tbody", "tfoot", "thead", "tr"}
UNWANTED = set("head nav footer aside form dialog menu script style noscript template iframe object svg canvas audio video".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
NAMES = set("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login sidebar aside menu nav navbar navigation breadcrumb breadcrumbs footer masthead share sharing social related recommended comment comments disqus replies reply respond toolbar pagination pager search copyright".split())
#: Those that count inside an article too.
STRICT = set("breadcrumb breadcrumbs pagination pager ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices popup modal overlay sidebar aside menu nav navbar navigation footer masthead comment comments disqus replies".split())
#: What may stand beside them in one name, as in `site-footer`.
BESIDE = set("site page main top bottom left right box bar block area wrapper wrap container content list section widget links link item items form inner body button buttons icons unit slot thread".split())
SLUGS = set("h1 h2 h3 h4 h5 h6 p".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|noscript|template|iframe|textarea|title|svg)\b[^>]*>(?:.*?</(?P=raw)\s*>|.*\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][\w:-]*)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>"
    r"|<[!?/a-zA-Z][^>]*(?:>|\Z)"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_ATTR = re.compile(r"([a-zA-Z_:][\w:.-]*)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_PARTS = re.compile(r"[^a-z]+")


@dataclass
class Page:
    """Blocks (path, text, whether in nothing that marks the article, in MAIN or in ARTICLE) and tokens (hashes of element begins, ends and blocks), both in page order."""

    blocks: list[tuple[str, str, int]] = field(default_factory=list)
    tokens: list[int] = field(default_factory=list)


def _names(said: str, names: set[str]) -> bool:
    """Whether one of the names, between spaces, consists of `names` and at most words beside them."""
    parts = [set(filter(None, _PARTS.split(token))) for token in said.split()]
    return any(p & names and p <= names | BESIDE for p in parts)


def _unwanted(name: str, attrs: str, within: int) -> tuple[bool, bool]:
    """Whether an element is unwanted, and whether it is so by its name alone, unless it holds the article."""
    if name in UNWANTED or (name == "header" and not within):
        return True, False
    if not attrs.strip():
        return False, False
    own = {k.lower(): v.strip("\"'").lower() for k, v in _ATTR.findall(attrs)}
    if "hidden" in own or own.get("aria-hidden") == "true" or "display:none" in own.get("style", "").replace(" ", "") or own.get("role") in ROLES:
        return True, False
    if name == "article":
        return _names(own.get("class", ""), {"comment", "comments"}), False
    said = own.get("class", "") + ("" if name in SLUGS else f" {own.get('id', '')}")
    return False, name not in ("html", "body", "main") and own.get("role") != "main" and _names(said, STRICT if within == ARTICLE else NAMES)


def parse(html: str | None) -> Page:
    page, stack, words = Page(), [], []
    # Open elements as (name, path, unwanted, in MAIN or ARTICLE, named); all but the name hold below an element as well. `named` are the numbers of elements named as unwanted.
    top = ("", "", False, 0, ())
    n_named = 0
    #: Begins and ends of elements as (kind, path), blocks as their number.
    events: list[tuple[str, str] | int] = []
    found: list[tuple[tuple[str, str, int], tuple[int, ...]]] = []
    # The named elements around each article or main, and around each heading of the page.
    holding: list[tuple[int, ...]] = []
    headed: list[tuple[int, ...]] = []

    def flush() -> None:
        if words:
            text = " ".join(entities.unescape("".join(words)).split())
            words.clear()
            at = stack[-1] if stack else top
            if text and not at[2]:
                events.append(len(found))
                found.append(((at[1], text, at[3]), at[4]))

    def close(first: int) -> None:
        while len(stack) > first:
            events.append(("/", stack.pop()[1]))

    for token in _TOKEN.finditer(html or ""):
        if token["text"] is not None:
            words.append(token["text"])
            continue
        name = (token["name"] or "").lower()
        if not name:
            continue
        if name == "br" or name in ("td", "th", "img"):
            words.append(" ")
        if token["end"]:
            if any(e[0] == name for e in stack):
                first = max(i for i, e in enumerate(stack) if e[0] == name)
                if name in BLOCK or stack[-1][2] or stack[-1][4] != (stack[first - 1] if first else top)[4]:
                    flush()
                while len(stack) > first:
                    closed = stack[-1][0]
                    close(len(stack) - 1)
                    if closed != name and closed in BLOCK:
                        flush()
            continue
        if name in CLOSES_P or name == "body":
            flush()
            if name in CLOSES_P and (inner := next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] in BLOCK), -1)) >= 0 and stack[inner][0] in ({"p", "li"} if name == "li" else {"p"}):
                close(inner)
        elif name in BLOCK:
            flush()
        if name == "body":
            close(next((i for i, e in enumerate(stack) if e[0] != "html"), len(stack)))
        above = stack[-1] if stack else top
        path = f"{above[1]}/{name}"
        events.append(("<", path))
        if name in VOID:
            continue
        unwanted, by_name = (True, False) if above[2] else _unwanted(name, token["attrs"] or "", above[3])
        if unwanted and not above[2] or by_name:
            flush()
        named = above[4]
        if by_name:
            named, n_named = (*named, n_named), n_named + 1
        within = above[3]
        if not unwanted and within != ARTICLE and (name == "article" or not within and (name == "main" or 'role="main"' in (token["attrs"] or ""))):
            if not within:
                holding.append(named)
            within = ARTICLE if name == "article" else MAIN
        if name == "h1" and not unwanted:
            headed.append(named)
        stack.append((name, path, unwanted, within, named))
    flush()
    close(0)
    # An element that holds the page's only articles, or the only headings of a page without, is the page's frame, whatever its name.
    frames = holding or headed
    only = set() if () in frames else {n for named in frames for n in named}
    gone = set(range(n_named)) - only
    stays = [gone.isdisjoint(named) for _, named in found]
    page.blocks = [b for (b, _), s in zip(found, stays, strict=True) if s]
    page.tokens = [token_hash("text", *found[e][0][:2]) if isinstance(e, int) else token_hash(*e) for e in events if not isinstance(e, int) or stays[e]]
    return page


def token_hash(kind: str, path: str, text: str = "") -> int:
    """Hashes of texts are odd, those of tags even."""
    return (xxhash.xxh64_intdigest(f"{kind}\0{path}\0{text}".encode("utf-8", "surrogatepass")) & ~1 | (kind == "text")) - 2**63


def main_text(page: Page, template: set[int]) -> str:
    """The text of the slots: blocks that are in an article or no template text, of the articles and mains if any has text."""
    slots = [b for b in page.blocks if b[2] == ARTICLE or not template or token_hash("text", b[0], b[1]) not in template]
    marked = any(within for _, _, within in slots)
    return "\n\n".join(text for _, text, within in slots if within or not marked)


def nesting(tokens: list[int], classes: dict[int, int]) -> list[tuple[int, int, int, int]]:
    """(class, its sequence's hash, the class around it, which gap) for each class that is ordered and nested on a page. 0, 0: no class is around it."""
    places: dict[int, list[int]] = {}
    for t in tokens:
        if t in classes:
            places.setdefault(classes[t], []).append(t)
    order = {}
    for c, seq in places.items():
        period = seq[: len(set(seq))]
        if period * (len(seq) // len(period)) == seq:
            order[c] = {t: i for i, t in enumerate(period)}
    around: dict[int, tuple[int, int]] = {}
    bad, open_at = set(), []
    for t in tokens:
        c = classes.get(t)
        if c not in order or c in bad:
            continue
        i = order[c][t]
        if i == 0:
            outer = tuple(open_at[-1]) if open_at else (0, 0)
            if around.setdefault(c, outer) != outer:
                bad.add(c)
                continue
            open_at.append([c, 0])
        else:
            # Classes that began within a repetition of this one and haven't ended are crossed by it, so not nested.
            while open_at and open_at[-1][0] != c:
                bad.add(open_at.pop()[0])
            if not open_at:
                bad.add(c)
                continue
            open_at[-1][1] = i
        if i == len(order[c]) - 1:
            open_at.pop()
    return [(c, _digest(order[c]), *around[c]) for c in order if c in around and c not in bad]


def _digest(order: dict[int, int]) -> int:
    return xxhash.xxh64_intdigest(",".join(map(str, order)).encode()) - 2**63


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for host, html in zip(batch["host"], batch["html"], strict=True):
            page = parse(html)
            rows.append((host, xxhash.xxh64_intdigest("\0".join(t for _, t, _ in page.blocks).encode("utf-8", "surrogatepass")) - 2**63, page.tokens))
        yield pd.DataFrame(rows, columns=["host", "content", "tokens"])


def _nestings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows, host_classes = [], {}
        for host, tokens, classes in zip(batch["host"], batch["tokens"], batch["classes"], strict=True):
            if host not in host_classes:
                host_classes = {host: {x["token"]: x["class"] for x in classes}}
            rows += [(host, *x) for x in nesting(list(tokens), host_classes[host])]
        yield pd.DataFrame(rows, columns=["host", "class", "sequence", "parent", "gap"])


def _extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = [main_text(parse(h), set() if t is None else set(t)) for h, t in zip(batch["html"], batch["template"], strict=True)]
        yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts, "n_chars": [len(t) for t in texts]})


def _by_host(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """One row for each host with its values in an array, broadcast if the rows are few."""
    out = rows.groupBy("host").agg(F.collect_list(value).alias(name))
    return F.broadcast(out) if rows.count() <= BROADCAST_ROWS else out


def templates(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """host, class, parent, gap, token: the template of each host, as valid classes in the gaps of their parents (0: the page)."""
    tokens = pages.mapInPandas(_tokens, "host string, content long, tokens array<long>")
    # Copies of a page count once: of pages with the same text and different tags, the one with the least tokens.
    tokens = store(tokens.groupBy("host", "content").agg(F.min("tokens").alias("tokens")), "page-tokens")
    counts = tokens.select("host", "content", F.explode("tokens").alias("token")).groupBy("host", "content", "token").agg(F.count(F.lit(1)).alias("n"))
    vectors = counts.groupBy("host", "token").agg(F.bit_xor(F.xxhash64("content", "n")).alias("vector"), F.count(F.lit(1)).alias("pages"))
    host_pages = tokens.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    vectors = vectors.filter(F.col("pages") >= least_pages).join(host_pages, "host").filter("2 * pages >= host_pages")
    vectors = store(vectors.select("host", "token", "pages", F.xxhash64("vector", "pages").alias("class")), "occurrence-vectors")
    tagged = vectors.filter("token % 2 = 0").select("host", "class").distinct()
    classes = store(vectors.join(tagged, ["host", "class"], "left_semi"), "classes")

    found = tokens.join(_by_host(classes, "classes", F.struct("token", "class")), "host").select("host", "tokens", "classes")
    found = found.mapInPandas(_nestings, "host string, `class` long, sequence long, parent long, gap int")
    agreed = found.groupBy("host", "class", "sequence", "parent", "gap").agg(F.count(F.lit(1)).alias("agree"))
    size = classes.groupBy("host", "class").agg(F.max("pages").alias("pages"))
    nested = store(agreed.join(size, ["host", "class"]).filter("2 * agree > pages").select("host", "class", "parent", "gap"), "nested-classes")
    # A class counts if all classes around it do, from the page inwards; nesting is as deep as a page at most.
    level = nested.filter("parent = 0")
    valid, deeper = level, nested.filter("parent != 0")
    while True:
        inner = deeper.join(level.select("host", F.col("class").alias("parent")), ["host", "parent"], "left_semi").select(*nested.columns)
        level = store(inner, "inner-classes")
        if level.isEmpty():
            break
        valid = valid.union(level)
    return classes.select("host", "token", "class").join(valid, ["host", "class"]).select("host", "class", "parent", "gap", "token")


def extracted(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """One row per row of `pages` (page_id, url, html): page_id, url, text, n_chars."""
    small_batches(pages.sparkSession, 200)
    host = F.coalesce(F.lower(F.regexp_extract(F.col("url").cast("string"), "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), host.alias("host"))
    found = store(templates(rows.select("host", "html"), least_pages).filter("token % 2 != 0").select("host", "token"), "templates")
    by_host = _by_host(found, "template", F.col("token"))
    return rows.join(by_host, "host", "left").select("page_id", "url", "html", "template").mapInPandas(_extract, "page_id long, url string, text string, n_chars long")


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(table(spark, sf_dir, "pages"))
