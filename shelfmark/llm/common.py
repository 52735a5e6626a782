"""What the corpus operators share: tables, batch sizes and word splitting. `store` writes a table to the shared work folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.sources.work import range_parts, store, work_folder

__all__ = ["LOWER", "SPACES", "UPPER", "by_part", "duck_crc32", "free_name", "n_words_of", "range_parts", "small_batches", "store", "table", "text_of", "without", "words_of", "work_folder"]

#: Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
SPACES = "[\\x20\\x09-\\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows of an Arrow batch, since texts may be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for an empty text."""
    return F.filter(F.split(text, SPACES), lambda w: w != "")


def n_words_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that `df` doesn't have, case aside."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of `docs` whose doc_id and text aren't in `gone` (doc_id, row: the text's hash), with all their columns."""
    doc, row = free_name(docs, "gone_id"), free_name(docs, "gone_row")
    gone = gone.select(F.col("doc_id").alias(doc), F.col("row").alias(row))
    same = F.xxhash64(docs["text"].cast("string")) == gone[row]
    return docs.join(gone, docs["doc_id"].cast("long").eqNullSafe(gone[doc]) & same, "left_anti")


def by_part(df: DataFrame, n: int) -> DataFrame:
    """`df` with each range of `range_parts` in a task of its own, so that windows over `part` need no further shuffle."""
    return df.repartitionById(n, F.col("part"))


def duck_crc32(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of a text's UTF-8 bytes, where the one row of `crc`, made by CRC_TABLE, is joined."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    return f"xor(list_reduce({octets}, lambda c, b: xor(crc.t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295)"


#: The 256 remainders of a byte by the reflected polynomial, as a list.
CRC_TABLE = "crc AS (SELECT list(list_reduce([1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) ORDER BY i) AS t FROM generate_series(0, 255) AS s(i))"
