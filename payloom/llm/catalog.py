"""The queries of this subpackage, by name, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from payloom.llm import bpe, chat_format, decontamination, jaccard_join, language_id, language_model, license_scan, lloyd, pii, quality_classifier, quality_rules, spelling_variants, toxicity

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_license_scan": license_scan.query,
        "op2_decontamination": decontamination.query,
        "op3_pii": pii.query,
        "op4_lm_scoring": language_model.query,
        "op5_quality_rules": quality_rules.query,
        "op6_quality_classifier": quality_classifier.query,
        "op7_bpe": bpe.query,
        "op8_language_id": language_id.query,
        "op9_toxicity": toxicity.query,
        "op10_jaccard_join": jaccard_join.query,
        "op11_spelling_variants": spelling_variants.query,
        "op12_chat_format": chat_format.query,
        "op13_centroid_clustering": lloyd.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_quality_rules": quality_rules.sql(),
        "op10_jaccard_join": jaccard_join.sql(),
        "op11_spelling_variants": spelling_variants.sql(),
        "op12_chat_format": chat_format.sql(),
        "op13_centroid_clustering": lloyd.sql(),
    }
