"""Operators for large training-data corpora, each with the query that applies it to its whole table."""

from graphloom.llm import (  # noqa: F401
    exact_dedup,
    fingerprints,
    jaccard_join,
    packing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    recompression,
    secret_scans,
    sentencepiece_bpe,
    spelling_variants,
    suffix_arrays,
    url_filters,
)
from graphloom.llm.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
