"""Registered queries of the training-data operators, and the DuckDB equivalents there are."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from mercato.llm import byte_bpe, chat_format, decontaminate, fingerprints, jaccard_join, lattice_lm, licenses, line_dedup, near_dups, periodic_runs, quality, ranked_search, url_filter


def build_llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op10_licenses": licenses.query,
        "op11_jaccard_join": jaccard_join.query,
        "op12_periodic_runs": periodic_runs.query,
        "op13_ranked_search": ranked_search.query,
        "op1_quality": quality.query,
        "op2_near_dups": near_dups.query,
        "op3_chat_format": chat_format.query,
        "op4_byte_bpe": byte_bpe.query,
        "op5_decontaminate": decontaminate.query,
        "op6_fingerprints": fingerprints.query,
        "op7_line_dedup": line_dedup.query,
        "op8_lattice_lm": lattice_lm.query,
        "op9_url_filter": url_filter.query,
        "pipeline": corpus_pipeline.run,
    }


def build_llm_oracle() -> dict[str, str]:
    return {
        "op11_jaccard_join": jaccard_join.ORACLE_SQL,
        "op13_ranked_search": ranked_search.ORACLE_SQL,
        "op2_near_dups": near_dups.ORACLE_SQL,
        "op3_chat_format": chat_format.ORACLE_SQL,
        "op5_decontaminate": decontaminate.ORACLE_SQL,
        "op7_line_dedup": line_dedup.ORACLE_SQL,
        "op9_url_filter": url_filter.ORACLE_SQL,
    }
