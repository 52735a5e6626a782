"""The three workloads: catalogue match, reconciliation, and page items to a table."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions import text as tx
from shelfmark.operators import clean, pairs, reconcile, scoring, tiles, vectors
from shelfmark.sources import tables
from shelfmark.sources.work import spread, store

FLYER_REQUIRED = ["Description", "Size", "Pack", "Retail_Factor", "Retail_Amt", "Page_Number"]
MASTER_REQUIRED = ["Description", "Size", "Pack", "Retail_Factor", "Retail_Amt", "nCat_Desc", "BRAND"]


def prepared(flyer: DataFrame, master: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Clean flyer rows, clean master rows, and the master rows that are paired: the first of each description, category and brand."""
    flyer = clean.filter_valid_description(clean.clean_table(flyer, FLYER_REQUIRED, "flyer_row"))
    # Written before, as filters that are pushed down would make a view's texts many times a row; and after, as it is both paired and reconciled.
    full = store(clean.filter_valid_description(clean.clean_table(store(master, "master-rows"), MASTER_REQUIRED, "master_row")), "full")
    return flyer, full, clean.dedup_first(full, ["Description", "nCat_Desc", "BRAND"], ["master_row"])


def attach(ids: DataFrame, flyer: DataFrame, master: DataFrame) -> DataFrame:
    """The attributes of both sides, after the pairs are few."""
    drop = [c for c in ("PDF_Description", "Excel_Description", "Excel_BRAND") if c in ids.columns]
    f, m = clean.prefix_columns(flyer, "PDF_", ["flyer_row"]), clean.prefix_columns(master, "Excel_", ["master_row"])
    return ids.drop(*drop).join(f, "flyer_row").join(m, "master_row")


def plain_scores(found: DataFrame, master: DataFrame) -> DataFrame:
    """Scores that need no model: boost, containment of brand and category, and word overlap as the model's score.

    Texts are cleaned and split once a row, not once a pair; what that gives is joined to the pairs.
    """
    found = store(found, "candidates")
    own = found.select("PDF_Description").distinct().select("PDF_Description", tx.match_text(F.col("PDF_Description")).alias("__a"), F.array_distinct(tx.tokenize(F.col("PDF_Description"))).alias("__x"))
    plain = {f"__{i}": tx.match_text(F.col(c)) for i, c in enumerate(("BRAND", "nCat_Desc"))}
    other = master.select("master_row", F.col("nCat_Desc").alias("Excel_nCat_Desc"), *[v.alias(k) for k, v in plain.items()], F.array_distinct(tx.tokenize(F.col("Description"))).alias("__y"))
    found = found.join(store(other, "master-words"), "master_row").join(store(own, "flyer-words"), "PDF_Description")
    within = lambda c: ((F.col("__a") != "") & (F.col(c) != "") & F.col("__a").contains(F.col(c))).cast("double")
    common = F.size(F.array_intersect("__x", "__y"))
    every = F.size("__x") + F.size("__y") - common
    found = found.withColumns({"Brand_Word_Score": within("__0"), "ncat_word_score": within("__1"), "LLM_Similarity": F.when(every > 0, common / every).otherwise(0.0)})
    return found.drop("__a", "__0", "__1", "__x", "__y").withColumns({c: F.lit(0.0) for c in ("Description_Similarity", "Brand_Description_Similarity", "Ncat_Description_Similarity")})


def plain_totals(flyer: DataFrame, master: DataFrame, threshold: float | None = 0.2) -> DataFrame:
    """flyer_row, master_row, total_Combined_Score and Combined_Score of all candidate pairs of prepared tables, by scores that need no model.

    A pair's scores hang on its texts alone, so each flyer description is scored once, and its flyer rows are joined to what it scored: the work of a flyer's further rows is that of writing their pairs.
    """
    own = store(flyer.groupBy("Description").agg(F.min("flyer_row").alias("flyer_row")), "flyer-texts")
    scored = pairs.combined_score(plain_scores(pairs.candidate_pairs(own, master, threshold), master)).select("PDF_Description", "master_row", "total_Combined_Score")
    scaled = pairs.min_max_scale(store(scored, "plain"), "total_Combined_Score")
    return spread(scaled).join(flyer.select("flyer_row", F.col("Description").alias("PDF_Description")), "PDF_Description").select("flyer_row", "master_row", "total_Combined_Score", "Combined_Score")


def match_catalogue(flyer: DataFrame, master: DataFrame, encode: Callable[[list[str]], np.ndarray] | None = vectors.char_trigrams, threshold: float | None = 0.2, k: int = 65) -> DataFrame:
    """The k best candidates of each flyer description with their scores. Without an encoder, containment of brand and category stands for similarities and ratios, and word overlap for the model's score."""
    f, _, m = prepared(flyer, master)
    return best_matches(store(f, "flyer"), store(m, "master"), encode, threshold, k)


def best_matches(flyer: DataFrame, master: DataFrame, encode: Callable[[list[str]], np.ndarray] | None = vectors.char_trigrams, threshold: float | None = 0.2, k: int = 65) -> DataFrame:
    """`match_catalogue` of prepared tables."""
    top = attach(tiles.best_candidates(flyer, master, k, threshold, encode=encode), flyer, master)
    return top if encode else top.withColumn("LLM_Similarity", tx.word_jaccard(F.col("PDF_Description"), F.col("Excel_Description")))


def reconcile_matches(scored: DataFrame, master: DataFrame, n: int = 5, flyer: DataFrame | None = None) -> dict[str, DataFrame]:
    """The five result tables from pairs with model scores and the full master table. With the `flyer` table, its rows without any pair are unmatched too."""
    ids = ("flyer_row", "master_row")
    # Ties keep the order of the descriptions as they were before upper-casing.
    rows = scored.withColumn("pair_order_description", F.col("PDF_Description"))
    rows = clean.upper_descriptions(rows, ["PDF_Description", "Excel_Description"])
    rows = store(reconcile.classify_pairs(reconcile.numeric_similarities(rows)), "classified")
    full = clean.upper_descriptions(clean.clean_distinct(master, keep=["master_row"]), ["Description"])
    exact = store(reconcile.best_exact(rows.filter("match_class = 'exact'")), "exact")
    partial = store(reconcile.rank_partial(reconcile.exclude_exact(rows.filter("match_class = 'partial'"), exact), n), "partial")
    flagged = store(reconcile.match_flag(full, exact, partial), "flagged")
    every = None if flyer is None else clean.upper_descriptions(clean.prefix_columns(flyer, "PDF_"), ["PDF_Description"])
    return {
        "Exact_Matches": exact.drop("pair_order_description", "match_class"),
        "Partial_Matches": partial.drop("pair_order_description", "match_class"),
        "PDF_Unmatched": reconcile.unmatched_flyer(rows.drop(*ids), exact, partial, every),
        "Excel_Unmatched": reconcile.flagged_unmatched(flagged),
        "Match_Flag": flagged,
    }


def page_items(images: DataFrame, classify: Callable[[str], str | None], extract: Callable[[str, int], str | None], tries: scoring.Tries = scoring.Tries(), limits: scoring.Limits = scoring.Limits()) -> tuple[DataFrame, DataFrame]:
    """Clean item rows of the images (image_name), and the images that failed with the stage they failed in."""
    answers = store(scoring.extract_items(images, classify, extract, tries=tries, limits=limits), "answers")
    good = answers.filter("stage = 'done'")
    rows = tables.parse_items_json(good.select("image_name", F.col("label").alias("Cluster"), "items_json"), "items_json")
    return clean.drop_blank_products(clean.clean_items(rows)), answers.filter("stage != 'done'").select("image_name", "stage")
