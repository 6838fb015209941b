"""Queries of the operators in this subpackage, and their DuckDB SQL where there is one."""
from __future__ import annotations

from . import (chat_format, decontaminate, hard_negatives, language_id, line_dedup, lm_scoring, mixing, near_dedup, secret_scan,
               substring_dedup, topk, whitening, window_dedup)

QUERIES = {
    "op1_chat_formatting": chat_format.op1,
    "op2_exact_topk": topk.op2,
    "op3_decontamination": decontaminate.op3,
    "op4_source_mixing": mixing.op4,
    "op5_language_id": language_id.op5,
    "op6_lm_scoring": lm_scoring.op6,
    "op7_near_dedup": near_dedup.op7,
    "op8_line_dedup": line_dedup.op8,
    "op9_substring_dedup": substring_dedup.op9,
    "op10_secret_scan": secret_scan.op10,
    "op11_window_dedup": window_dedup.op11,
    "op12_hard_negatives": hard_negatives.op12,
    "op13_whitening": whitening.op13,
}

ORACLE = {
    "op2_exact_topk": topk.SQL,
    "op3_decontamination": decontaminate.SQL,
    "op4_source_mixing": mixing.SQL,
    "op11_window_dedup": window_dedup.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
}
