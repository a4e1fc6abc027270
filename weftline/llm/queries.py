"""Queries of this subpackage and their SQL. The entry point adds the pipeline, which stands at the repository's top."""

from __future__ import annotations

from . import line_dedup
from .byte_bpe import op3_byte_bpe
from .packing import op7_best_fit_packing
from .pitman_yor import op4_pitman_yor
from .quality_rules import op10_quality_rules
from .simhash import op8_simhash
from .telephony import op6_telephony
from .token_counts import op5_token_counts
from .token_files import op9_token_files
from .toxicity import op1_toxicity

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_pitman_yor": op4_pitman_yor,
    "op5_token_counts": op5_token_counts,
    "op6_telephony": op6_telephony,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_simhash": op8_simhash,
    "op9_token_files": op9_token_files,
    "op10_quality_rules": op10_quality_rules,
}

ORACLES: dict[str, str] = {"op2_line_dedup": line_dedup.ORACLE}
