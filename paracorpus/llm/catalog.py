"""Queries and oracle SQL of the operators of this subpackage."""

from __future__ import annotations

from . import bpe_codec, nn_descent, packing, quality, secrets, simhash, substring_dedup, suffix_dedup, token_counts, toxicity


def queries() -> dict:
    return {
        "op1_token_counts": token_counts.op1_token_counts,
        "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
        "op3_substring_dedup": substring_dedup.op3_substring_dedup,
        "op4_secret_scan": secrets.op4_secret_scan,
        "op5_quality_rules": quality.op5_quality_rules,
        "op6_nn_descent": nn_descent.op6_nn_descent,
        "op7_packing": packing.op7_packing,
        "op8_simhash": simhash.op8_simhash,
        "op9_bpe_codec": bpe_codec.op9_bpe_codec,
        "op10_toxicity": toxicity.op10_toxicity,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_quality_rules": quality.ORACLE_SQL}
