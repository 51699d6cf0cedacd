"""Operators for preparing large training corpora, and their queries."""

from __future__ import annotations


def queries() -> dict:
    from .bpe import op5_bpe
    from .fingerprints import op1_fingerprints
    from .hard_negatives import op12_hard_negatives
    from .line_dedup import op6_line_dedup
    from .lm_scoring import op7_lm_scoring
    from .near_dedup import op9_near_dedup
    from .packing import op2_packing
    from .quality_rules import op10_quality_rules
    from .sharding import op3_sharding
    from .spelling import op13_spelling_variants
    from .substring_dedup import op4_substring_dedup, op8_suffix_array_dedup
    from .token_counts import op11_token_counts

    found = (op1_fingerprints, op2_packing, op3_sharding, op4_substring_dedup, op5_bpe, op6_line_dedup, op7_lm_scoring, op8_suffix_array_dedup, op9_near_dedup, op10_quality_rules, op11_token_counts, op12_hard_negatives, op13_spelling_variants)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    from .oracles import ORACLES

    return dict(ORACLES)
