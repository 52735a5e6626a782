"""Texts as vectors: encode each distinct text once, look vectors up, compare."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH = 512


def distinct_texts(df: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct texts of the columns, as `text`."""
    return df.select(F.explode(F.array(*[F.col(c).cast("string") for c in columns])).alias("text")).filter("text IS NOT NULL").distinct()


def char_trigrams(texts: list[str], width: int = 256) -> np.ndarray:
    """A stand-in encoder: counts of hashed character trigrams."""
    out = np.zeros((len(texts), width))
    for i, t in enumerate(texts):
        padded = f"  {t.lower()} "
        for j in range(len(padded) - 2):
            h = 0
            for c in padded[j : j + 3]:
                h = (h * 1000003 + ord(c)) % 4294967291
            out[i, h % width] += 1
    return out


#: What loaders gave in this worker, by the loader's content.
_loaded: dict[str, Callable[[list[str]], np.ndarray]] = {}


def loaded(key: str, load: Callable[[], Callable[[list[str]], np.ndarray]]) -> Callable[[list[str]], np.ndarray]:
    """What `load` gives, once in the life of a worker."""
    if key not in _loaded:
        _loaded[key] = load()
    return _loaded[key]


def encode_texts(texts: DataFrame, encode: Callable[[list[str]], np.ndarray] = char_trigrams, batch: int = BATCH, load: Callable[[], Callable[[list[str]], np.ndarray]] | None = None) -> DataFrame:
    """text -> text, vector (L2-normalised); `encode` is called on batches inside tasks.

    A model that is large or can't be pickled comes from `load` instead, which is called in the worker, once for all batches and tasks that it runs.
    """
    key = hashlib.sha256(cloudpickle.dumps(load)).hexdigest()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = encode if load is None else loaded(key, load)
        for frame in batches:
            for at in range(0, len(frame), batch):
                part = list(frame["text"].iloc[at : at + batch])
                v = np.asarray(model(part), float)
                norm = np.linalg.norm(v, axis=1, keepdims=True)
                yield pd.DataFrame({"text": part, "vector": list((v / np.where(norm > 0, norm, 1)).astype(np.float32))})

    return texts.mapInPandas(run, "text string, vector array<float>")


def normalized(v: Column) -> Column:
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.transform(v, lambda x: F.when(norm > 0, x / norm).otherwise(0.0))


def dot(a: Column, b: Column) -> Column:
    """The dot product in double; 0 where a vector is missing."""
    return F.coalesce(F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x), F.lit(0.0))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 where a vector is missing or has no length."""
    return dot(normalized(a), normalized(b))


def lookup_embeddings(pairs: DataFrame, vectors: DataFrame, a: str, b: str, to: str) -> DataFrame:
    """`pairs` with the similarity of two text columns in `to`: computed once for each distinct pair of texts from their vectors (text, vector)."""
    pick = lambda c, v: vectors.select(F.col("text").alias(c), F.col("vector").alias(v))
    each = pairs.select(a, b).distinct().join(pick(a, "__va"), a, "left").join(pick(b, "__vb"), b, "left")
    each = each.select(a, b, dot(F.col("__va"), F.col("__vb")).alias(to))
    return pairs.join(each, [a, b], "left").withColumn(to, F.coalesce(to, F.lit(0.0)))
