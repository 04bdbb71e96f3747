"""The queries of this subpackage, and SQL for those that it can express."""

from __future__ import annotations

from . import decontamination, html_extraction, line_dedup, mixing, ngram_jaccard, pii, quality_classifier, quality_rules, substring_dedup, url_filters


def queries() -> dict:
    import corpus_pipeline

    return {
        "op1_ngram_jaccard": ngram_jaccard.query,
        "op2_quality_rules": quality_rules.query,
        "op3_mixing": mixing.query,
        "op4_url_filters": url_filters.query,
        "op5_decontamination": decontamination.query,
        "op6_substring_dedup": substring_dedup.query,
        "op7_pii": pii.query,
        "op8_quality_classifier": quality_classifier.query,
        "op9_html_extraction": html_extraction.query,
        "op10_line_dedup": line_dedup.query,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": quality_rules.SQL, "op3_mixing": mixing.SQL, "op4_url_filters": url_filters.SQL, "op5_decontamination": decontamination.SQL}
