"""The pipeline's rows against plain Python versions of its stages, on the smallest tables and some planted documents."""

import math
import random
from collections import Counter

import corpus_pipeline
from shelfmark.llm import toxicity

from .test_dedup import brute_classes
from .test_text_operators import filled

SF = "/root/testdata/sf0.001"


def plain_toxicity(docs, model):
    score = lambda t: sum(model.words.get(f, 0.0) for f in toxicity.terms(t))
    return [d for d in docs if 1 / (1 + math.exp(-(score(d["text"]) - model.thresholds[0]))) < 0.5]


def plain_exact(docs):
    last = {}
    for d in docs:
        key = "".join(c.lower() if "A" <= c <= "Z" else c for c in d["text"] or "")
        if key not in last or last[key]["doc_id"] < d["doc_id"]:
            last[key] = d
    return list(last.values())


def plain_near(docs):
    classes = brute_classes([(d["doc_id"], d["text"]) for d in docs])
    return [d for d in docs if classes[d["doc_id"]] == d["doc_id"]]


def plain_decontamination(docs, items):
    grams = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    split = [((t or "").lower().split()) for t in items]
    split = [(len(w), grams(w)) for w in split if len(w) >= 5]

    def leaks(words):
        own = grams(words)
        for size, item in split:
            have, want = set(item), Counter(item)
            if 9 * sum(g in have for g in own) < 8 * min(len(own), len(item)):
                continue
            n = min(size - 4, len(own))
            for s in range(len(own) - n + 1):
                w = Counter(own[s : s + n])
                if sum((w & want).values()) >= 0.8 * sum((w | want).values()):
                    return True
        return False

    return [d for d in docs if not leaks((d["text"] or "").lower().split())]


def test_run_against_plain_python(spark, tmp_path):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rng = random.Random(6)
    long = " ".join(f"w{rng.randrange(9999)}" for _ in range(200))
    more = [long, long + " more", long.upper(), "", None, f"{long[:300]} {items[0]} {long[300:600]}", "other " + long[700:1100]]
    first = max(d["doc_id"] for d in docs) + 1
    docs += [{**docs[0], "doc_id": first + i, "text": t, "source": None if i % 2 else "planted"} for i, t in enumerate(more)]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    spark.createDataFrame([tuple(d[c] for c in schema.names) for d in docs], schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")

    model = toxicity.train(spark.read.parquet(f"{tmp_path}/documents.parquet"), toxicity.graded(spark.read.parquet(f"{SF}/labels.parquet")))
    plain = [lambda d: plain_toxicity(d, model), plain_exact, plain_near, lambda d: plain_decontamination(d, items)]
    table, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), docs
    for (name, stage), want in zip(corpus_pipeline.STAGES, plain, strict=False):
        kept, table = want(kept), corpus_pipeline.store(stage(spark, table, str(tmp_path)), f"test-{name}")
        assert table.columns == schema.names and sorted(r.doc_id for r in table.collect()) == sorted(d["doc_id"] for d in kept), name
    # Of the equal texts the last stays, of the near copies the first; the one with an item goes.
    assert {d["doc_id"] for d in kept if d["doc_id"] >= first} == {first + 1, first + 4, first + 6}

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    size = {d["doc_id"]: len((d["text"] or "").split()) for d in kept}
    assert {r.doc_id: r["size"] for r in out} == size
    sources = sorted({d["source"] for d in kept if d["source"] is not None}, key=lambda s: s.encode()) + [None]
    sums = [sum(size[d["doc_id"]] for d in kept if d["source"] == s) for s in sources]
    for s, target in zip(sources, filled(sums, [1 + i % 3 for i in range(len(sources))]), strict=True):
        mine = [r for r in out if r.source == s]
        assert all(abs(r.target - target) < 1e-6 * max(1, target) for r in mine)
        assert abs(sum(r.taken for r in mine) - target) <= 32 * 8 + 0.02 * target
    assert all(0 <= r.taken <= 3 * r["size"] for r in out)
