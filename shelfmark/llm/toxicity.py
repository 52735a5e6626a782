"""Toxicity by cumulative-link ordinal regression.

Severity grades are ordered: 0 clean, 1 toxic, 2 toxic and of low quality (`labels`: toxic, quality). The labels have no severity of their own; that low quality makes
a toxic text worse is our choice, and `train` takes any other grades. The model is
P(grade > k) = logistic(x.w - threshold_k), with one weight vector for all thresholds; x marks the words and word stems that a document has (once, twice, four times), of a vocabulary
that sets the grades apart. The score is the expected severity, and a document is rejected where P(grade > 0) is 0.5 or more.

The model is fitted on at most `SAMPLE` labelled documents, those with the least hashes of doc_id, and at most `FEATURES` features; both are
parameters. Every document is scored, over its whole text.

Defined results: null and empty texts have no words. Labels with a null doc_id or null toxic are not used; of rows that repeat a doc_id the
worst grade counts, and of their texts the least is the one learned from. Texts of any length are scored whole. Without labels, or with one grade only, every score is that grade (0 without). Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import small_batches, store, table

SAMPLE, FEATURES, LEAST_DOCS, LEAST_Z, PENALTY, REJECT = 10_000, 400, 5, 4.5, 0.1, 0.5
_WORD = re.compile(r"[^\W\d_]+")
#: Stems stand for inflected forms; counts are coded as "at least so many".
STEMS, COUNTS = (4, 5, 6), (1, 2, 4)


def terms(text: str | None) -> set[str]:
    """The sparse features of a text: its lower-cased words and the stems of longer ones, each by how often it occurs at least."""
    counts: Counter[str] = Counter()
    for word, n in Counter(_WORD.findall((text or "").lower())).items():
        counts[word] += n
        for k in STEMS:
            if len(word) > k:
                counts[f"{word[:k]}-"] += n
    return {f"{term}:{least}" for term, n in counts.items() for least in COUNTS if n >= least}


def known_terms(text: str | None, weights: dict[str, float], stems: set[str]) -> list[str]:
    """Those of `terms` that have a weight, in order. Words that lead to none are passed over."""
    words = Counter(_WORD.findall((text or "").lower()))
    near = {w: n for w, n in words.items() if w in stems or w[:4] in stems}
    counts: Counter[str] = Counter()
    for word, n in near.items():
        counts[word] += n
        for k in STEMS:
            if len(word) > k:
                counts[f"{word[:k]}-"] += n
    return sorted(f for term, n in counts.items() for least in COUNTS if n >= least and (f := f"{term}:{least}") in weights)


@dataclass
class OrdinalModel:
    """Weights by word, shared by all thresholds; `levels` are the grades, `thresholds` lie between them."""

    words: dict[str, float] = field(default_factory=dict)
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(0))
    levels: np.ndarray = field(default_factory=lambda: np.zeros(1))

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > levels[k]) by row and k."""
        return _logistic(np.asarray(score, float)[:, None] - self.thresholds[None, :])

    def severity(self, above: np.ndarray) -> np.ndarray:
        return self.levels[0] + above @ np.diff(self.levels)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * np.clip(x, -500, 500)))


def fit(x: np.ndarray, grades: np.ndarray, penalty: float = PENALTY, rounds: int = 60) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weights, thresholds and levels by damped Newton steps on the penalised log-likelihood, which is concave."""
    levels = np.unique(grades)
    n, v, k = len(grades), x.shape[1], len(levels) - 1
    if k < 1:
        return np.zeros(v), np.zeros(0), levels if len(levels) else np.zeros(1)
    y = np.searchsorted(levels, grades)
    tail = np.array([(y > j).mean() for j in range(k)])
    params = np.concatenate([np.zeros(v), -np.log(tail / (1 - tail))])
    # What each row's upper and lower bounds, x.w - threshold, have to do with the thresholds.
    up, low = np.zeros((n, k)), np.zeros((n, k))
    up[y > 0, y[y > 0] - 1] = -1
    low[y < k, y[y < k]] = -1

    def parts(p: np.ndarray):
        s, t = x @ p[:v], p[v:]
        a = _logistic(np.where(y > 0, s + up @ t, np.inf))
        b = _logistic(np.where(y < k, s + low @ t, -np.inf))
        return a, b, a - b

    def loss(p: np.ndarray) -> float:
        gap = parts(p)[2]
        return np.inf if (np.diff(p[v:]) <= 0).any() or (gap <= 0).any() else -np.log(gap).sum() + penalty / 2 * (p[:v] ** 2).sum()

    at = loss(params)
    for _ in range(rounds):
        a, b, gap = parts(params)
        da, db = a * (1 - a), b * (1 - b)
        ga, gb = da / gap, -db / gap
        haa, hbb, hab = da * (1 - 2 * a) / gap - ga**2, -db * (1 - 2 * b) / gap - gb**2, -ga * gb
        zu, zl = np.hstack([x, up]), np.hstack([x, low])
        grad = zu.T @ ga + zl.T @ gb - penalty * np.concatenate([params[:v], np.zeros(k)])
        hess = (zu * haa[:, None]).T @ zu + (zl * hbb[:, None]).T @ zl + (zu * hab[:, None]).T @ zl + (zl * hab[:, None]).T @ zu
        hess -= np.diag(np.concatenate([np.full(v, penalty), np.full(k, 1e-9)]))
        step, scale = np.linalg.solve(-hess, grad), 1.0
        while scale > 1e-8 and loss(params + scale * step) > at:
            scale /= 2
        params = params + scale * step
        before, at = at, loss(params)
        if before - at < 1e-9 * (1 + abs(at)):
            break
    return params[:v], params[v:], levels


def graded(labels: DataFrame) -> DataFrame:
    """doc_id, grade from labels (doc_id, quality, toxic)."""
    grade = F.when(F.col("toxic") == 0, 0).when(F.col("quality") == 0, 2).otherwise(1)
    rows = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    return rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(grade).alias("grade"))


def _terms_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"], "grade": batch["grade"], "terms": [sorted(terms(t)) for t in batch["text"]]})


def train(docs: DataFrame, grades: DataFrame, sample: int = SAMPLE, features: int = FEATURES, least_z: float = LEAST_Z) -> OrdinalModel:
    """A model from `docs` (doc_id, text) and `grades` (doc_id, grade)."""
    small_batches(docs.sparkSession)
    chosen = grades.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")
    # One text for each label, so that `sample` bounds them however often a doc_id repeats.
    texts = texts.groupBy("doc_id", "grade").agg(F.min("text").alias("text"))
    # Copies of a text are one observation.
    texts = texts.groupBy("text").agg(F.max("grade").alias("grade"), F.min("doc_id").alias("doc_id"))
    seen = store(texts.mapInPandas(_terms_of, "doc_id long, grade int, terms array<string>"), "labelled-terms")
    n, n_toxic = seen.agg(F.count(F.lit(1)), F.coalesce(F.sum((F.col("grade") > 0).cast("long")), F.lit(0))).first()
    if not n:
        return OrdinalModel()
    share = n_toxic / n
    counts = seen.select(F.explode("terms").alias("term"), (F.col("grade") > 0).cast("long").alias("toxic")).groupBy("term").agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic"))
    z = (F.col("toxic") - F.col("n") * F.lit(share)) / F.sqrt(F.col("n") * F.lit(max(share * (1 - share), 1e-12)))
    picked = counts.filter(F.col("n") >= LEAST_DOCS).withColumn("z", z).filter(F.abs("z") >= least_z).orderBy(F.abs("z").desc(), "term").limit(features)
    words = {w: i for i, w in enumerate(r[0] for r in picked.select("term").collect())}
    known = F.array(*[F.lit(w) for w in words]) if words else F.array().cast("array<string>")
    rows = seen.select("doc_id", "grade", F.array_intersect("terms", known).alias("terms")).orderBy("doc_id", "grade").collect()
    x = np.zeros((len(rows), len(words)))
    for i, row in enumerate(rows):
        for w in row["terms"]:
            x[i, words[w]] = 1
    weights, thresholds, levels = fit(x, np.array([r["grade"] for r in rows]))
    return OrdinalModel(dict(zip(words, weights.tolist(), strict=True)), thresholds, levels.astype(float))


def _summed(model: OrdinalModel, texts: pd.Series) -> np.ndarray:
    """P(grade > levels[k]) of each text. Weights are added in the order of the features, so that reruns agree to the last bit."""
    stems = {w for f in model.words for w in (f.split(":")[0].rstrip("-"), f[:4])}
    return model.above(np.array([sum(model.words[f] for f in known_terms(t, model.words, stems)) for t in texts], float))


def _toxic(model: OrdinalModel, above: np.ndarray) -> np.ndarray:
    return above[:, 0] if above.shape[1] and model.levels[0] == 0 else np.full(len(above), float(model.levels[0] > 0))


def _score(model: OrdinalModel):
    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            above = _summed(model, batch["text"])
            toxic = _toxic(model, above)
            grades = np.hstack([np.ones((len(above), 1)), above]) - np.hstack([above, np.zeros((len(above), 1))])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "severity": model.severity(above).round(6), "p_toxic": toxic.round(6), "grade": model.levels[grades.argmax(axis=1)].astype(int), "rejected": toxic >= REJECT})

    return score


def scored(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """One row per row of `docs`: doc_id, severity (expected grade), p_toxic, grade (likeliest), rejected."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInPandas(_score(model), "doc_id long, severity double, p_toxic double, grade int, rejected boolean")


def drop_toxic(docs: DataFrame, model: OrdinalModel) -> DataFrame:
    """The rows of `docs` that the model doesn't reject, with all their columns."""

    @F.pandas_udf("boolean")
    def rejected(texts: pd.Series) -> pd.Series:
        return pd.Series(_toxic(model, _summed(model, texts)) >= REJECT)

    small_batches(docs.sparkSession)
    return docs.filter(~rejected(F.col("text").cast("string")))


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return scored(docs, train(docs, graded(table(spark, sf_dir, "labels"))))
