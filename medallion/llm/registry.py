"""The subpackage's registered queries and their SQL."""

from __future__ import annotations

from medallion.llm import decontamination, embedding_pq, filter_audit, graph_search, line_templates, merkle_manifest, mixing, oracles, quality, secret_forest, signature_join, token_counts, token_files, url_filter

QUERIES = {
    "op3_secret_forest": secret_forest.query,
    "op1_line_templates": line_templates.query,
    "op7_url_filter": url_filter.query,
    "op4_embedding_pq": embedding_pq.query,
    "op6_mixing": mixing.query,
    "op2_decontamination": decontamination.query,
    "op9_quality_sites": quality.query,
    "op8_signature_join": signature_join.query,
    "op5_token_counts": token_counts.query,
    "op10_token_files": token_files.query,
    "op11_filter_audit": filter_audit.query,
    "op12_merkle_manifest": merkle_manifest.query,
    "op13_graph_search": graph_search.query,
}

ORACLE_SQL: dict[str, str] = {
    "op1_line_templates": oracles.LINE_TEMPLATES,
    "op7_url_filter": oracles.URL_FILTER,
    "op4_embedding_pq": oracles.EMBEDDINGS,
    "op8_signature_join": oracles.JACCARD,
    "op11_filter_audit": oracles.FILTER_AUDIT,
}
