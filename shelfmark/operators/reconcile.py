"""Exact, partial and unmatched results from scored pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.numeric import coerce_scores, number_similarity, unit_price_similarity

#: Column names of the result tables.
SIMILARITIES = [
    "Boost_Score", "Description_Similarity", "Ncat_Description_Similarity", "Brand_Description_Similarity", "Combined_Score", "LLM_Similarity",
    "Pack_Similarity", "Retail_Amt_Similarity", "Size_Similarity", "Brand_Word_Score", "Retail_Factor_Similarity",
]
RETAIL = ["PDF_Retail_Amt", "PDF_Retail_Factor", "Excel_Retail_Amt", "Excel_Retail_Factor"]
KEY, FLYER_KEY = "Excel_Description", "PDF_Description"
FLYER_COLUMNS = ["PDF_Description", "PDF_Size", "PDF_Pack", "PDF_Retail_Factor", "PDF_Retail_Amt", "PDF_Page_Number"]


def numeric_similarities(df: DataFrame) -> DataFrame:
    """Size, pack, factor and unit price similarities of the PDF_ and Excel_ columns."""
    c = F.col
    return df.withColumns(
        {
            "Size_Similarity": number_similarity(c("PDF_Size"), c("Excel_Size")),
            "Pack_Similarity": number_similarity(c("PDF_Pack"), c("Excel_Pack")),
            "Retail_Factor_Similarity": number_similarity(c("PDF_Retail_Factor"), c("Excel_Retail_Factor")),
            "Retail_Amt_Similarity": unit_price_similarity(c("PDF_Retail_Amt"), c("Excel_Retail_Amt"), c("PDF_Retail_Factor"), c("Excel_Retail_Factor")),
        }
    )


def classify_pairs(df: DataFrame) -> DataFrame:
    """`match_class`: exact, partial or other."""
    v = lambda name: F.coalesce(F.col(name), F.lit(0.0))
    candidate = (v("LLM_Similarity") >= 0.7) | ((v("Brand_Word_Score") >= 0.85) & (v("ncat_word_score") >= 0.2))
    exact = (v("LLM_Similarity") >= 0.7) & (v("Retail_Amt_Similarity") == 100) & (v("Size_Similarity") >= 80)
    return df.withColumn("match_class", F.when(candidate & exact, "exact").when(candidate, "partial").otherwise("other"))


def _has_retail(df: DataFrame, real_nulls: bool) -> Column:
    if not all(c in df.columns for c in RETAIL):
        return F.lit(False)
    there = F.lit(True)
    for c in RETAIL:
        there &= F.col(c).isNotNull() & (F.lit(not real_nulls) | (F.col(c) != "Null"))
    return there


def _ranked(df: DataFrame, real_nulls: bool) -> DataFrame:
    """Rows with price data first, then close prices, model score and combined score, all rounded; ties keep the pairs' order."""
    df = coerce_scores(df, SIMILARITIES)
    retail = _has_retail(df, real_nulls)
    close = F.when(retail & (F.col("Retail_Amt_Similarity") >= 99), 1).otherwise(0)
    last = [F.col(c) for c in ("pair_order_description", FLYER_KEY) if c in df.columns][:1]
    total = [F.col("total_Combined_Score").desc()] if "total_Combined_Score" in df.columns else []
    order = [retail.cast("int").desc(), close.desc(), F.col("LLM_Similarity").desc(), F.col("Combined_Score").desc(), *last, *total, "flyer_row", "master_row"]
    return df.withColumn("Match_Order", F.row_number().over(Window.partitionBy(KEY).orderBy(*order)))


def best_exact(df: DataFrame, real_nulls: bool = False) -> DataFrame:
    """The best row of each master description."""
    return _ranked(df, real_nulls).filter("Match_Order = 1").drop("Match_Order")


def rank_partial(df: DataFrame, n: int = 5, real_nulls: bool = False) -> DataFrame:
    """The n best rows of each master description, numbered from 1 in Match_Order."""
    return _ranked(df, real_nulls).filter(F.col("Match_Order") <= n)


def exclude_exact(partial: DataFrame, exact: DataFrame) -> DataFrame:
    return partial.join(exact.select(KEY).distinct(), KEY, "left_anti")


def union_ranked(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def matched_keys(exact: DataFrame, partial: DataFrame, key: str = KEY) -> DataFrame:
    return exact.select(key).union(partial.select(key)).distinct()


def unmatched_flyer(pairs: DataFrame, exact: DataFrame, partial: DataFrame, all_flyer: DataFrame | None = None) -> DataFrame:
    """Flyer rows, un-prefixed and distinct, whose description is in neither result. `all_flyer` adds rows that never had a pair."""
    columns = [c for c in FLYER_COLUMNS if c in pairs.columns]
    rows = pairs.select(*columns)
    if all_flyer is not None:
        rows = rows.unionByName(all_flyer.select(*columns))
    rows = rows.join(matched_keys(exact, partial, FLYER_KEY), FLYER_KEY, "left_anti").distinct()
    return rows.select(*[F.col(c).alias(c.removeprefix("PDF_")) for c in columns])


def unmatched_master(master: DataFrame, exact: DataFrame, partial: DataFrame) -> DataFrame:
    keys = matched_keys(exact, partial).withColumnRenamed(KEY, "Description")
    return master.join(keys, "Description", "left_anti")


def match_flag(master: DataFrame, exact: DataFrame, partial: DataFrame) -> DataFrame:
    """Each master row with Exact Match, Partial Match or Unmatched, exact first."""
    mark = lambda df, name: df.select(F.col(KEY).alias("Description")).distinct().withColumn(name, F.lit(True))
    out = master.join(mark(exact, "__e"), "Description", "left").join(mark(partial, "__p"), "Description", "left")
    return out.withColumn("Match_Flag", F.when(F.col("__e"), "Exact Match").when(F.col("__p"), "Partial Match").otherwise("Unmatched")).drop("__e", "__p")


def flagged_unmatched(flagged: DataFrame) -> DataFrame:
    """`unmatched_master` from the rows that `match_flag` has flagged, which spares its join."""
    return flagged.filter("Match_Flag = 'Unmatched'").drop("Match_Flag")


def row_counts(results: dict[str, DataFrame]) -> DataFrame:
    """result, rows for each result table."""
    out = None
    for name, df in results.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("result"), "rows")
        out = one if out is None else out.union(one)
    return out
