"""The queries of this subpackage, one for each operator, and SQL for those that SQL can express."""

from __future__ import annotations

from termloom.llm import decontamination, extraction, language_model, mixing, quality, sharding, simhash, substring_dedup, tokens, toxicity


def queries() -> dict:
    return {
        "op1_substring_dedup": substring_dedup.op1_substring_dedup,
        "op2_html_extraction": extraction.op2_html_extraction,
        "op3_language_model": language_model.op3_language_model,
        "op4_simhash": simhash.op4_simhash,
        "op5_mixing": mixing.op5_mixing,
        "op6_sharding": sharding.op6_sharding,
        "op7_token_counts": tokens.op7_token_counts,
        "op8_decontamination": decontamination.op8_decontamination,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_quality": quality.op10_quality,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_mixing": mixing.OP5_SQL, "op8_decontamination": decontamination.OP8_SQL}
