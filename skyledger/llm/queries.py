"""The corpus queries by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from skyledger.llm import audit, langid, merkle, mixing, neighbours, packing, repeats, scoring, sharding, simhash, sql, tokens, vectors, winnowing

QUERIES = {
    "op1_suffix_dedup": repeats.op1_suffix_dedup,
    "op2_shard_documents": sharding.op2_shard_documents,
    "op3_simhash": simhash.op3_simhash,
    "op4_token_counts": tokens.op4_token_counts,
    "op5_lm_scoring": scoring.op5_lm_scoring,
    "op6_language_id": langid.op6_language_id,
    "op7_embedding_dedup": vectors.op7_embedding_dedup,
    "op8_nearest_neighbours": neighbours.op8_nearest_neighbours,
    "op9_pack_documents": packing.op9_pack_documents,
    "op10_mix_sources": mixing.op10_mix_sources,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_decontaminate": winnowing.op12_decontaminate,
    "op13_filter_audit": audit.op13_filter_audit,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {
        "op1_suffix_dedup": sql.REPEATS,
        "op7_embedding_dedup": sql.VECTORS,
        "op11_merkle_manifest": sql.MANIFEST,
        "op12_decontaminate": sql.WINNOWING,
        "op13_filter_audit": sql.AUDIT,
    }
