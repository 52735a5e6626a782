"""Cleaning and filtering of flyer, master and extracted item tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Strings that mean null, in the first and in the final stage, and the string that stands for them.
NULL_TOKENS = ("", "nan", "NaT", "null", "NULL", "None")
FINAL_NULL_TOKENS = ("", "nan", "NaT", "None", "NoneType")
NULL_TOKEN = "Null"
RENAMED = {"RetailAmount": "Retail_Amt", "RetailFactor": "Retail_Factor"}
#: The fields of an extracted item.
PRODUCT_FIELDS = ("Size", "Pack", "RetailAmount", "RetailFactor", "Description")
ITEM_FIELDS = (*PRODUCT_FIELDS, "Ad")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Column names trimmed, with spaces as underscores and without other punctuation."""
    return df.toDF(*[re.sub(r"[^\w_]", "", c.strip().replace(" ", "_")) for c in df.columns])


def prefix_columns(df: DataFrame, prefix: str, keep: Iterable[str] = ()) -> DataFrame:
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in set(keep)})


def unprefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.withColumnsRenamed({c: c.removeprefix(prefix) for c in df.columns if c.startswith(prefix)})


def rename_retail(df: DataFrame, names: Mapping[str, str] = RENAMED) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def select_existing(df: DataFrame, order: Iterable[str]) -> DataFrame:
    """The named columns in that order, absent ones left out."""
    return df.select(*[F.col(f"`{c}`") for c in order if c in df.columns])


def dedup_first(df: DataFrame, keys: Iterable[str], order: Iterable[str | Column]) -> DataFrame:
    """The first row of each key set; `order` has to end in a row id for a defined result.

    Where a row is its keys and the one column of the order, it is the least of each key set: summed up where rows are read, so that they are neither sorted nor all shuffled.
    """
    keys, order = list(keys), list(order)
    kinds = dict(df.dtypes)
    if len(order) == 1 and isinstance(order[0], str) and order[0] not in keys and set(df.columns) == {*keys, order[0]} and not any(k in kinds[c] for c in keys for k in ("float", "double")):
        # Nulls come first in the order.
        first = F.when(F.count(order[0]) == F.count(F.lit(1)), F.min(order[0]))
        return df.groupBy(*keys).agg(first.alias(order[0])).select(*df.columns)
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__place", place).filter("__place = 1").drop("__place")


def _strings(df: DataFrame) -> list[str]:
    return [c for c, kind in df.dtypes if kind == "string"]


def null_token(c: Column, tokens: Iterable[str] = NULL_TOKENS, to: str = NULL_TOKEN) -> Column:
    return F.when(c.isNull() | c.isin(*tokens), to).otherwise(c)


def clean_table(df: DataFrame, required: list[str], row_id: str) -> DataFrame:
    """Strings trimmed, duplicates on the required columns dropped (first kept), null tokens unified, and rows without any required value dropped."""
    df = df.withColumns({c: F.trim(c) for c in _strings(df)})
    df = dedup_first(df, required, [row_id])
    df = df.withColumns({c: null_token(F.col(c)) for c in _strings(df)})
    nothing = F.lit(True)
    for c in required:
        nothing &= F.upper(F.col(c).cast("string")).isin("NULL", "NAN", "NONE", "")
    return df.filter(~nothing)


def clean_distinct(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """All columns as trimmed strings with null tokens unified, distinct rows. Columns in `keep` (row ids) stay as they are."""
    kept = set(keep)
    return df.select(*[F.col(c) if c in kept else null_token(F.trim(F.col(c).cast("string")), FINAL_NULL_TOKENS).alias(c) for c in df.columns]).distinct()


def filter_valid_description(df: DataFrame, column: str = "Description") -> DataFrame:
    return df.filter(F.col(column).isNotNull() & ~F.lower(F.trim(column)).isin("", "null"))


def upper_descriptions(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.upper(F.trim(c)) for c in columns if c in df.columns})


def page_number(c: Column) -> Column:
    """The number after `_page_` in a file name, else null."""
    return F.regexp_extract(c, r"_page_(\d+)", 1).try_cast("int")


def clean_items(df: DataFrame, name: str = "image_name") -> DataFrame:
    """Item fields with runs of white space as one space, and the page number from the image's name."""
    fields = {c: F.trim(F.regexp_replace(c, r"\s+", " ")) for c in ITEM_FIELDS if c in df.columns}
    return df.withColumns(fields).withColumn("Page_Number", page_number(F.col(name)))


def _empty(c: Column) -> Column:
    """Null, nothing but white space, or NULL in any case (white space around it counts)."""
    return c.isNull() | c.rlike("^\\s*$") | (F.upper(c) == "NULL")


def valid_items(items: str = "items") -> Column:
    """Whether there are items and none has all six fields empty. `items` is an array of structs."""
    blank = F.exists(items, lambda x: F.array_size(F.filter(F.array(*[x[f] for f in ITEM_FIELDS]), lambda v: ~_empty(v))) == 0)
    return F.coalesce(F.size(items) > 0, F.lit(False)) & ~F.coalesce(blank, F.lit(True))


def reject_empty_items(df: DataFrame, items: str = "items") -> DataFrame:
    """Images without items, or with any item whose six fields are all empty, go as a whole."""
    return df.filter(valid_items(items))


def drop_blank_products(df: DataFrame) -> DataFrame:
    """Rows with all five product fields empty or NULL go, so banner-only rows do."""
    blank = F.lit(True)
    for c in PRODUCT_FIELDS:
        blank &= _empty(F.trim(c))
    return df.filter(~blank)
