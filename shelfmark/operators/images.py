"""Detection boxes, entropy filter and run summaries."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.sources import tables

ENTROPY = 1.7
#: Bytes up to which a file is read whole.
SMALL_FILE = 4 << 20


def clean_boxes(df: DataFrame) -> DataFrame:
    """Boxes (image_name, box_idx, x1, y1, x2, y2, img_w, img_h) clamped to the image, with the reason that they are skipped or their crop's name.

    The first corner is clamped from below, the second from above, so a box outside the image stays recognisable.
    """
    first = lambda c: F.greatest(F.lit(0.0), F.col(c).cast("double"))
    second = lambda c, top: F.least(F.col(c).cast("double"), F.col(top).cast("double"))
    df = df.withColumns({"x1": first("x1"), "y1": first("y1"), "x2": second("x2", "img_w"), "y2": second("y2", "img_h")})
    bad = (F.col("x2") - F.col("x1") < 3) | (F.col("y2") - F.col("y1") < 3)
    stem = F.regexp_replace("image_name", r"\.[^.]*$", "")
    return df.withColumn("reason", F.when(bad, "Tiny or invalid box")).withColumn("crop_name", F.when(~bad, F.concat(stem, F.lit("_crop_"), F.col("box_idx").cast("string"), F.lit(".jpg"))))


def valid_crops(boxes: DataFrame) -> DataFrame:
    """Crops with whole-number corners."""
    return boxes.filter("reason IS NULL").select("image_name", "box_idx", "crop_name", *[F.col(c).cast("int").alias(c) for c in ("x1", "y1", "x2", "y2")])


def skipped_boxes(boxes: DataFrame) -> DataFrame:
    """The log of skipped boxes, coordinates with two decimals."""
    return boxes.filter("reason IS NOT NULL").select("image_name", "box_idx", *[F.format_string("%.2f", c).alias(c) for c in ("x1", "y1", "x2", "y2")], "reason")


def entropy(df: DataFrame, key: str, value: str) -> DataFrame:
    """Shannon entropy (nats) of the values of each key, from one row per value; counts are summed before the shuffle."""
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    # H = ln N - sum(n ln n) / N needs the counts once.
    sums = counts.groupBy(key).agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.ln("n")).alias("n_ln_n"))
    return sums.select(key, (F.ln("total") - F.col("n_ln_n") / F.col("total")).alias("entropy"))


def _entropy(counts: np.ndarray) -> float:
    n = counts[counts > 0].astype(float)
    return float(np.log(n.sum()) - (n * np.log(n)).sum() / n.sum())


def char_counts(text: str, piece: int = 1 << 20) -> np.ndarray:
    """How often each code point is in a text, read once, piece by piece."""
    counts = np.zeros(128, np.int64)
    for at in range(0, len(text), piece):
        own = np.bincount(np.frombuffer(text[at : at + piece].encode("utf-32-le", "surrogatepass"), np.uint32))
        if len(own) > len(counts):
            counts = np.pad(counts, (0, len(own) - len(counts)))
        counts[: len(own)] += own
    return counts


def char_entropies(texts: pa.Array) -> pa.Array:
    """Entropy of each text's characters; null for a null or empty one. Only one text at a time is a Python string."""
    return pa.array((_entropy(char_counts(t.as_py())) if t.is_valid and len(t.as_buffer()) else None for t in texts), pa.float64())


def char_entropy(text: Column) -> Column:
    """Shannon entropy (nats) of a text's characters within the row; null for an empty text. Each text is read once."""

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return char_entropies(texts)

    return run(text)


def _octet_entropy(value: pa.Scalar, piece: int = 1 << 20) -> float | None:
    """Entropy of a binary value's octets, counted piece by piece where they lie; None for a null or empty one."""
    raw = np.frombuffer(value.as_buffer(), np.uint8) if value.is_valid else ()
    return _entropy(sum(np.bincount(raw[at : at + piece], minlength=256) for at in range(0, len(raw), piece))) if len(raw) else None


def byte_entropy(content: Column) -> Column:
    """Shannon entropy (nats) of the grey values in a binary column: a histogram of 256 places; null for an empty one."""

    @F.arrow_udf("double")
    def run(values: pa.Array) -> pa.Array:
        return pa.array((_octet_entropy(v) for v in values), pa.float64())

    return run(content)


def _octets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's lines (file, content) as one row a file: how often each octet is in them, how many octets and how many lines they are."""
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        files, content = batch.column("file").dictionary_encode(), batch.column("content")
        ends, raw = np.frombuffer(content.buffers()[1], np.int32)[content.offset : content.offset + len(content) + 1], np.frombuffer(content.buffers()[2] or b"", np.uint8)
        owner = files.indices.to_numpy()
        # Lines of a file follow each other.
        cuts = [0, *(np.flatnonzero(np.diff(owner)) + 1).tolist(), len(owner)]
        for first, last in zip(cuts[:-1], cuts[1:], strict=True):
            if first < last:
                own = sums.setdefault(files.dictionary[int(owner[first])].as_py(), np.zeros(258, np.int64))
                for at in range(ends[first], ends[last], 1 << 20):
                    own[:256] += np.bincount(raw[at : min(at + (1 << 20), ends[last])], minlength=256)
                own[256:] += ends[last] - ends[first], last - first
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64()))], names=["file", "sums"])


def _whole_entropy(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
    """The entropy of a file from what its tasks have counted. Lines are without their ends, and a mark of UTF-8 that begins a file isn't read: both follow from its length."""
    path, length = key
    sums = np.sum(np.stack(parts["sums"].to_list()), axis=0)
    counts, (octets, lines) = sums[:256], sums[256:]
    # The last line may have no end.
    missing = length - octets - lines
    if missing in (2, 3):
        counts[[0xEF, 0xBB, 0xBF]] += 1
        missing -= 3
    if missing not in (0, -1):
        raise ValueError(f"{path}: {octets} octets in {lines} lines were read of {length}; it changed while it was read, or its name is one of a compressed text")
    counts[0x0A] += lines + missing
    return pd.DataFrame({"path": [path], "length": [length], "entropy": [_entropy(counts)]})


def file_entropy(spark: SparkSession, path: str, extensions: Iterable[str], small: int = SMALL_FILE) -> DataFrame:
    """path, length and entropy of the contents of the files with one of the extensions, each read once.

    Files up to `small` bytes are read whole. Larger ones are read as Spark reads text, in splits and line by line with contents as they are, and their splits' histograms are summed; what has to fit a task's
    memory is then the longest run without the octet 0x0A.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array((_octet_entropy(v) for v in batch.column("content")), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("length"), found], names=["path", "length", "entropy"])

    # A mark alone, of three bytes, is no line.
    small = max(small, 3)
    files = tables.files_like(spark, path, extensions)
    whole = files.filter(F.col("length") <= small).select("path", "length", "content").mapInArrow(run, "path string, length long, entropy double")
    large = files.filter(F.col("length") > small).select("path", "length", F.col("_metadata.file_path").alias("file"))
    lines = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    lines = lines.filter((F.col("_metadata.file_size") > small) & tables.named_like(F.col("_metadata.file_path"), extensions))
    parts = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("content")).mapInArrow(_octets, "file string, sums array<long>")
    return whole.union(large.join(parts, "file").groupBy("path", "length").applyInPandas(_whole_entropy, "path string, length long, entropy double"))


def entropy_filter(scored: DataFrame, threshold: float = ENTROPY) -> DataFrame:
    """`noisy` where the entropy is below the threshold."""
    return scored.withColumn("noisy", F.col("entropy") < threshold)


def noise_summary(filtered: DataFrame) -> DataFrame:
    """How many images the entropy filter took for noise, and how many it let through."""
    return filtered.agg(F.count_if("noisy").alias("noisy"), F.count_if(~F.col("noisy")).alias("clean"))


def box_summary(boxes: DataFrame) -> DataFrame:
    """Detections, crops and skipped boxes of each image, and in all (image_name null)."""
    return boxes.rollup("image_name").agg(F.count(F.lit(1)).alias("detections"), F.count_if(F.col("reason").isNull()).alias("crops"), F.count_if(F.col("reason").isNotNull()).alias("skipped"))
