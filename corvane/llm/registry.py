"""Queries of this subpackage and, where SQL can express them, the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, chunk_dedup, fingerprint, langid, mixing, near_dedup, oracle, quality, suffix_dedup, unit_dedup, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_near_dedup": near_dedup.query,
        "op2_substring_dedup": unit_dedup.query,
        "op3_suffix_dedup": suffix_dedup.query,
        "op4_line_dedup": chunk_dedup.query,
        "op5_warc": warc.query,
        "op6_fingerprints": fingerprint.query,
        "op7_quality_rules": quality.query,
        "op8_language_id": langid.query,
        "op9_byte_bpe": bpe.query,
        "op10_mix_sources": mixing.query,
        "edited_texts": fingerprint.query_edited,
        "mix_targets": mixing.query_targets,
    }


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
