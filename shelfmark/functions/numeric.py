"""Similarity of sizes, packs, factors and unit prices from 0 to 100, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DECIMAL = r"^\s*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?\s*$"


def to_double(c: Column) -> Column:
    """A plain number, else null."""
    text = c.cast("string")
    return F.when(text.rlike(_DECIMAL), F.trim(text).try_cast("double"))


def round2(c: Column) -> Column:
    return F.floor(c * 100 + 0.5) / 100


def parse_numbers(c: Column) -> Column:
    """(lo, hi, is_range): null without a number; a range of exactly two; else the first number as both ends."""
    found = F.transform(F.regexp_extract_all(c.cast("string"), F.lit(r"([0-9]+\.?[0-9]*)"), F.lit(1)), lambda x: x.cast("double"))
    two = F.size(found) == 2
    return F.when(F.size(found) > 0, F.struct(F.get(found, F.lit(0)).alias("lo"), F.when(two, F.get(found, F.lit(1))).otherwise(F.get(found, F.lit(0))).alias("hi"), two.alias("is_range")))


def number_similarity(flyer: Column, master: Column) -> Column:
    """100 where equal or within the flyer's range, less by relative distance, 0 where a side has no number. A master range counts as its midpoint."""
    a, b = parse_numbers(flyer), parse_numbers(master)
    lo, hi, v = a["lo"], a["hi"], (b["lo"] + b["hi"]) / 2
    distance = F.when(a["is_range"], F.least(F.abs(lo - v), F.abs(hi - v))).otherwise(F.abs(lo - v))
    near = round2(F.greatest(F.lit(0.0), (1 - distance / F.nullif(F.greatest(lo, v), F.lit(0.0))) * 100))
    return F.when(a.isNull() | b.isNull(), 0.0).when(a["is_range"] & (v >= lo) & (v <= hi), 100.0).when(lo == 0, 0.0).otherwise(near)


def _money(c: Column) -> Column:
    return to_double(F.regexp_replace(c.cast("string"), "[$,]", ""))


def unit_price_similarity(amount1: Column, amount2: Column, factor1: Column, factor2: Column) -> Column:
    """Similarity of amount / factor; 0 where any is no number or a factor is 0."""
    f1, f2 = _money(factor1), _money(factor2)
    v1, v2 = _money(amount1) / F.nullif(f1, F.lit(0.0)), _money(amount2) / F.nullif(f2, F.lit(0.0))
    near = round2(F.greatest(F.lit(0.0), (1 - F.abs(v1 - v2) / F.greatest(F.abs(v1), F.abs(v2), F.lit(1e-9))) * 100))
    return F.when(v1.isNull() | v2.isNull(), 0.0).when(v1 == v2, 100.0).otherwise(near)


def coerce_scores(df: DataFrame, cols: list[str], rounded: bool = True) -> DataFrame:
    """Score columns as numbers, what is none as 0, rounded to two decimals."""
    as_number = {c: F.coalesce(to_double(F.col(c)), F.lit(0.0)) for c in cols if c in df.columns}
    return df.withColumns({c: round2(v) if rounded else v for c, v in as_number.items()})


def score_to_unit(c: Column) -> Column:
    v = F.coalesce(to_double(c), F.lit(0.0))
    return F.when(v > 1, v / 100).otherwise(v)
