"""The corpus queries by name, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    conversations,
    decontamination,
    jaccard_join,
    language_id,
    license_scan,
    line_dedup,
    period_runs,
    quality_classifier,
    quality_rules,
    source_mixing,
    suffix_dedup,
    token_counts,
    toxicity,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_rules": quality_rules.query,
        "op2_ngram_jaccard_join": jaccard_join.query,
        "op3_toxicity": toxicity.query,
        "op4_language_id": language_id.query,
        "op5_benchmark_decontamination": decontamination.query,
        "op6_license_scan": license_scan.query,
        "op7_suffix_dedup": suffix_dedup.query,
        "op8_source_mixing": source_mixing.query,
        "op9_quality_classifier": quality_classifier.query,
        "op10_line_dedup": line_dedup.query,
        "op11_conversation_repair": conversations.query,
        "op12_period_runs": period_runs.query,
        "op13_token_counts": token_counts.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op6_license_scan": license_scan.oracle(),
        "op8_source_mixing": source_mixing.ORACLE,
        "op10_line_dedup": line_dedup.ORACLE,
        "op11_conversation_repair": conversations.ORACLE,
    }
