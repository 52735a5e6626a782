"""The registered queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import conversation_repair, decontamination, exact_dedup, html_extraction, importance_resampling, license_scan, mixing, near_dedup, pii, secret_scan, substring_dedup, toxicity, url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ordinal_toxicity": toxicity.op1,
        "op2_probminhash_near_dedup": near_dedup.op2,
        "op3_dice_license_scan": license_scan.op3,
        "op4_forest_secret_scan": secret_scan.op4,
        "op5_pii_surrogates": pii.op5,
        "op6_content_sort_dedup": exact_dedup.op6,
        "op7_lempel_ziv_substring_dedup": substring_dedup.op7,
        "op8_low_discrepancy_mix": mixing.op8,
        "op9_simhash_decontamination": decontamination.op9,
        "op10_template_extraction": html_extraction.op10,
        "op11_sorted_url_filter": url_filter.op11,
        "op12_importance_resampling": importance_resampling.op12,
        "op13_conversation_repair": conversation_repair.op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_dice_license_scan": license_scan.OP3_SQL,
        "op6_content_sort_dedup": exact_dedup.OP6_SQL,
        "op7_lempel_ziv_substring_dedup": substring_dedup.OP7_SQL,
        "op9_simhash_decontamination": decontamination.OP9_SQL,
        "op11_sorted_url_filter": url_filter.OP11_SQL,
        "op12_importance_resampling": importance_resampling.OP12_SQL,
        "op13_conversation_repair": conversation_repair.OP13_SQL,
    }
