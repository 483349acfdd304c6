"""Queries of the training-data operators, by name, and the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, cotraining, decontaminate, divergence, fingerprint, jaccard, lines, neighbours, pii, sharding, tokencount, trie, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": tokencount.op1_token_counts,
        "op2_line_dedup": lines.op2_line_dedup,
        "op3_pii": pii.op3_pii,
        "op4_quality": cotraining.op4_quality,
        "op5_sharding": sharding.op5_sharding,
        "op6_decontamination": decontaminate.op6_decontamination,
        "op7_fingerprints": fingerprint.op7_fingerprints,
        "op8_warc": warc.op8_warc,
        "op9_bpe": bpe.op9_bpe,
        "op10_ngram_jaccard": jaccard.op10_ngram_jaccard,
        "op11_divergence": divergence.op11_divergence,
        "op12_trie": trie.op12_trie,
        "op13_neighbours": neighbours.op13_neighbours,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_warc": warc.OP8_SQL, "op11_divergence": divergence.OP11_SQL, "op12_trie": trie.OP12_SQL}
