"""Queries and DuckDB oracles of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontam, langid, line_dedup, lm_score, mixing, near_dup, negatives, packing, phrases, quality, suffix_dedup, token_files, topk


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_masked_lm_score": lm_score.op1,
        "op2_line_dedup": line_dedup.op2,
        "op3_best_fit_packing": packing.op3,
        "op4_quality_rules": quality.op4,
        "op5_exact_topk": topk.op5,
        "op6_source_mixing": mixing.op6,
        "op7_crf_language_id": langid.op7,
        "op8_token_files": token_files.op8,
        "op9_minhash_near_dup": near_dup.op9,
        "op10_suffix_dedup": suffix_dedup.op10,
        "op11_hard_negatives": negatives.op11,
        "op12_decontamination": decontam.op12,
        "op13_collocations": phrases.op13,
    }


def oracles() -> dict[str, str]:
    return {
        "op5_exact_topk": topk.ORACLE, "op6_source_mixing": mixing.ORACLE, "op11_hard_negatives": negatives.ORACLE,
        "op12_decontamination": decontam.ORACLE, "op13_collocations": phrases.ORACLE,
    }
