"""URL filters, importance resampling and conversation repair against brute force on small fixtures."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import conversation_repair as cr
from shelfmark.llm import importance_resampling as ir
from shelfmark.llm import url_filter as uf

# URL filters.


def brute_host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute_verdict(url, rules, default="allow"):
    host, path = brute_host_path(url)
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *((lambda b: (b[3], b[2]))(max(fits)) if fits else (None, default)))


def judged(spark, urls, rules):
    df = spark.createDataFrame([(i, u, 1, "x", "y") for i, u in urls], "page_id long, url string, id int, host string, `part` string").repartition(3)
    out = uf.judged(df, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"]
    return out.collect()


def test_url_rules_against_every_rule(spark):
    rng = random.Random(11)
    label = lambda: rng.choice(["a", "b", "org", "com", "xn", "ä", "a-b"])
    host = lambda n: ".".join(label() for _ in range(n))
    path = lambda: "".join(rng.choice(["/", "a", "b", "é", "/a", "/b/"]) for _ in range(rng.randrange(5)))
    rules = {(host(rng.randrange(1, 4)), ("/" + path()) if rng.random() < 0.9 else ""): rng.choice(["allow", "block"]) for _ in range(60)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [(i, f"http{rng.choice(['', 's'])}://{host(rng.randrange(1, 5))}{rng.choice(['', '/'])}{path()}{rng.choice(['', '?q=://x/a', '#f'])}") for i in range(1500)]
    urls += [(None, None), (2, ""), (2, "no scheme/a"), (3, "x://"), (3, "x://ORG/A"), (4, "://org/a/\U0010ffff\U0010ffff"), (5, "a://b.org./a"), (6, "u://h" + "/a" * 100_000), (7, "u://" + "a." * 3000 + "org/a")]
    urls += urls[:50]
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in judged(spark, urls, rules))
    assert got == Counter((i, *brute_verdict(u, rules)) for i, u in urls)


def test_url_rules_of_the_contract(spark):
    for url, rule, verdict in [
        ("http://example.org/es/1", "example.org/es/", "block"), ("http://m.EXAMPLE.org/en/12?x", "example.org/en/1", "block"), ("http://example.org/en/2", "org/", "allow"), ("http://x.com/de/", "com/de/", "block"),
        ("http://x.com/fr/a#b", "com/fr/", "allow"), ("http://x.com/es/", None, "allow"), ("http://org", None, "allow"), ("http://notexample.org/es/", "org/", "allow"), (None, None, "allow"),
    ]:
        assert brute_verdict(url, uf.RULES)[2:] == (rule, verdict)
    urls = [(i, f"http://{h}.example.{t}{p}") for i, (h, t, p) in enumerate(itertools.product("ab", ("org", "com", "net"), ("", "/", "/es/", "/en/1", "/fr/x", "/de/x")))] * 30
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in judged(spark, urls, list(uf.RULES)))
    assert got == Counter((i, *brute_verdict(u, uf.RULES)) for i, u in urls)


def test_urls_without_rules_or_rows_and_equal_rules(spark):
    assert judged(spark, [], list(uf.RULES)) == []
    assert [r.verdict for r in judged(spark, [(1, "http://a/b")], [])] == ["allow"]
    both = [("a", "/", "allow"), ("A", "/", "block"), ("a", "/", "allow")]
    assert [(r.rule, r.verdict) for r in judged(spark, [(1, "http://a/b")] * 2, both)] == [("a/", "block")] * 2
    pages = spark.createDataFrame([(1, "http://a/b", "h"), (2, None, "h"), (3, "http://c/b", "h"), (1, "http://a/b", "g")], "page_id long, url string, blocked_url string")
    kept = uf.drop_blocked(pages, spark.createDataFrame(both, "host string, path string, verdict string"))
    assert kept.columns == pages.columns and sorted(r.page_id for r in kept.collect()) == [2, 3]


# Importance resampling.


def brute_resampled(docs, target, buckets, longest, least, percent, seed):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    runs = lambda w: [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    s, t = (Counter(bucket(f) for x in texts for f in runs(words(x))) for texts in ([x for _, x in docs], target))
    gain = lambda b: math.floor(1000 * math.log(float((t[b] + 1) * (s.total() + buckets)) / float((s[b] + 1) * (t.total() + buckets))))
    out = []
    for i, (doc_id, text) in enumerate(docs):
        fs = runs(words(text))
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(fs), weight, score, None, len(words(text)), i])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], 2**63 if r[0] is None else r[0], r[6]))
    for k, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("longest,buckets,percent", [(1, 10_000, 10), (2, 97, 37), (3, 7, 100), (1, 5, 0)])
def test_resampling_against_brute_force(spark, longest, buckets, percent):
    rng = random.Random(12)
    text = lambda n: rng.choice([" ", "\n", "-", ". "]).join(rng.choice(["The", "the", "ZEBRA", "año", "x9", "9", "straße", "word"]) for _ in range(n))
    docs = [(rng.randrange(10**9), text(rng.randrange(60))) for _ in range(300)]
    same = text(30)
    # One doc_id with a third of all rows: equal scores, only row numbers tell them apart.
    docs += [(7, same)] * 150 + [(None, same)] * 5 + [(8, None), (9, ""), (10, "..."), (11, "long " * 200_000)]
    target = [text(40), None, "", "zebra " * 10]
    df = spark.createDataFrame([(i, t, "a", 1, 2, 3) for i, t in docs], "doc_id long, text string, id string, n_words int, score int, `order` int").repartition(3)
    got = ir.resampled(df, spark.createDataFrame([(t,) for t in target], "text string"), buckets, longest, 20, percent, 2024)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == brute_resampled(docs, target, buckets, longest, 20, percent, 2024)


def test_resampling_of_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert ir.resampled(none, none).collect() == []
    rows = ir.resampled(spark.createDataFrame([(1, "a " * 30), (2, "b")], "doc_id long, text string"), none, percent=100).collect()
    assert {r.doc_id: r["rank"] for r in rows} == {1: 1, 2: None}


def test_bisection_finds_the_kth_value(spark):
    values = [-300, -3, -3, -3, 0, 5, 5, 300]
    df = spark.createDataFrame([(v,) for v in values], "v long").cache()
    for k in (1, 3, 5, 8):
        v, below = ir.least_reaching(df, "v", k)
        assert v == sorted(values)[k - 1] and below == sum(x < v for x in values)


# Conversation repair.


def faults(rows):
    """(role, text, fault) of ordered rows."""
    seen, out = set(), []
    for role, text in rows:
        end = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role, text, fault))
    return out


def dynamic_repair(rows):
    """(cost, audit, lines) by a dynamic program over every last role, which the search isn't."""
    far = (10**9, "", [])
    ways = {"": (0, "", []), "s": far, "u": far, "a": far}

    def inserted(w):
        w = dict(w)
        for _ in range(3):
            for a, b, role in (("", "u", "user"), ("s", "u", "user"), ("a", "u", "user"), ("u", "a", "assistant")):
                w[b] = min(w[b], (w[a][0] + 5, w[a][1] + "I", w[a][2] + [f"{role}:"]))
        return w

    for role, text, fault in rows:
        ways, after = inserted(ways), {}
        put = lambda state, way: after.__setitem__(state, min(after.get(state, far), way))
        for state, (cost, audit, lines) in ways.items():
            put(state, (cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more, to = 5 * (fault == "truncated"), "a" if state == "u" else "u"
            if role[:1] == to or role[:1] == "s" and state == "":
                put(role[:1], (cost + more, audit + "K", lines + [f"{role}:{text}"]))
            if role[:1] != to:
                new = "user" if to == "u" else "assistant"
                put(to, (cost + more + 1, audit + "R", lines + [f"{new}:{text}"]))
        ways = {**dict.fromkeys(ways, far), **after}
    ways = inserted(ways)
    return min(ways[""], ways["a"])


def exhaustive_repair(turns):
    """(cost, audit) over all edits of a few turns, with up to three Inserts anywhere."""
    best = None
    for n in range(4):
        for edits in itertools.product("DIKR", repeat=len(turns) + n):
            if edits.count("I") != n:
                continue
            cost, roles, rest = 0, [], iter(turns)
            for e in edits:
                if e == "I":
                    cost, roles = cost + 5, [*roles, "ua"]
                    continue
                initial, bad, truncated = next(rest)
                if bad and e != "D":
                    break
                cost += {"D": 2, "K": 0, "R": 1}[e] + 5 * (truncated and e != "D")
                if e != "D":
                    roles.append(initial if e == "K" else "ua")
            else:
                # Letters that may be user or assistant take what the order wants.
                body = roles[1:] if roles and roles[0] == "s" else roles
                ok = len(body) % 2 == 0 and all(("u", "a")[i % 2] in r for i, r in enumerate(body)) and (body or not roles)
                if ok and (best is None or (cost, "".join(edits)) < best):
                    best = cost, "".join(edits)
    return best


def test_search_against_all_edits():
    rng = random.Random(13)
    kinds = [(i, b, t) for i in ("s", "u", "a", "t", "") for b, t in ((False, False), (True, False), (False, True))]
    for _ in range(120):
        turns = [rng.choice(kinds) for _ in range(rng.randrange(5))]
        assert cr.cheapest_repair(turns) == exhaustive_repair(turns)


def test_search_against_dynamic_program():
    rng = random.Random(14)
    for n in [*range(0, 30), 24, 25, 48, 49, 300, 2000]:
        for _ in range(20 if n < 100 else 2):
            rows = [(rng.choice(["system", "user", "assistant", "user", "assistant", "tool"]), "t", rng.choice(["", "", "", "blank", "truncated"])) for _ in range(n)]
            turns = [(r[:1], f == "blank", f == "truncated") for r, _, f in rows]
            assert cr.cheapest_repair(turns) == dynamic_repair(rows)[:2]


def brute_conversations(rows, copies):
    """Per conv_id: what `repairs` returns."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [r for r, n in zip(rows, copies, strict=True) if r[0] == conv for _ in range(n)]
        space = lambda x: " " if x is None else x
        own = sorted(own, key=lambda r: (r[1] is not None, r[1] or 0, space(r[2]).encode(), hashlib.sha256(space(r[3]).encode()).digest()))
        turns = [r[1] for r in own if r[1] is not None]
        marked = faults([(space(r[2]), space(r[3])) for r in own])
        count = Counter(f for _, _, f in marked)
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(marked))
        cost, audit, lines = dynamic_repair(marked)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()), lines
    return out


def odd_conversations():
    rng = random.Random(15)
    text = lambda: rng.choice(["Yes.", "No", "  ", "", "Why?\n", "Ünd!", "a. b", None, f"T{rng.randrange(1000)}."])
    rows = [(c, rng.choice([None, *range(-2, 9)]), rng.choice(["user", "assistant", "system", "tool", "", None]), text()) for c in range(40) for _ in range(rng.randrange(1, 12))]
    # A conversation of a third of all rows, equal rows among them, and one without an id; both are cut by ranges.
    rows += [(7, t, rng.choice(["user", "assistant"]), f"Turn {t}." if t % 7 else "Again.") for t in range(400)] + [(7, 9, "user", "Same.")] * 60
    rows += [(None, t % 50, "user", text()) for t in range(120)] + [(50, 1, "user", "long " * 200_000 + "."), (50, 2, "assistant", "Yes."), (51, 0, "user", "Hm?"), (51, 1, "assistant", "Ok.")]
    return rows


@pytest.mark.parametrize("dropped", [False, True])
def test_repairs_against_brute_force(spark, dropped):
    rows = odd_conversations()
    copies = [i % 3 if dropped else 1 for i in range(len(rows))]
    schema = "conv_id long, turn long, role string, text string, copies int, digest string, cost int, `marker` int"
    df = spark.createDataFrame([(*r, n, "d", 1, 2) for r, n in zip(rows, copies, strict=True)], schema).repartition(5)
    want = brute_conversations(rows, copies)
    got = cr.repairs(df)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = got.collect()
    assert len(got) == len(want)
    for r in got:
        assert tuple(r)[1:] == want[r.conv_id][0], r.conv_id
    said = {}
    for r in cr.repaired(df).orderBy("conv_id", "turn").collect():
        assert r.turn == len(said.setdefault(r.conv_id, []))
        said[r.conv_id].append(f"{r.role}:{r.text}")
    assert said == {c: lines for c, (_, lines) in want.items() if lines}


def test_damage_and_conversations_that_vanish(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(30) for t in range(3)] + [(None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    key = lambda c, t: zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
    fates = {0: ("assistant", "One. Two!", 0), 1: ("assistant", "", 1), 2: ("assistant", "One Two", 1), 3: ("assistant", "One. Two!", 2), 4: ("user", "One. Two!", 1)}
    for r in cr.damaged(df).collect():
        if r.conv_id is not None:
            assert (r.role, r.text, r.copies) == fates.get(key(r.conv_id, r.turn), ("assistant", "One. Two!", 1))
    gone = cr.repairs(df.withColumn("copies", F.lit(0))).collect()
    empty = hashlib.sha256(b"").hexdigest()
    assert len(gone) == 31 and {tuple(r)[1:] for r in gone} == {(0, 0, 0, 0, 0, 0, "", empty)}
    assert cr.repairs(df.limit(0)).collect() == [] and cr.repaired(df.limit(0)).collect() == []
