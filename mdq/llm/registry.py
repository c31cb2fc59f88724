"""Queries of this package and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from mdq.llm import (
    centroids,
    embedding_join,
    filter_audit,
    fingerprints,
    language_id,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    simhash,
    token_counts,
    token_files,
    warc,
)

QUERIES = {
    "op1_quality_classifier": quality_classifier.op1_quality_classifier,
    "op2_warc": warc.op2_warc,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_best_fit_packing": packing.op4_best_fit_packing,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_language_id": language_id.op6_language_id,
    "op7_fingerprints": fingerprints.op7_fingerprints,
    "op8_simhash": simhash.op8_simhash,
    "op9_mixing": mixing.op9_mixing,
    "op10_token_files": token_files.op10_token_files,
    "op11_embedding_join": embedding_join.op11_embedding_join,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_centroids": centroids.op13_centroids,
}

ORACLE_SQL = {
    "op2_warc": warc.OP2_SQL,
    "op9_mixing": mixing.OP9_SQL,
    "op12_filter_audit": filter_audit.OP12_SQL,
    "op13_centroids": centroids.OP13_SQL,
}
