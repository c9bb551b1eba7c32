"""The registered queries of this package and their SQL."""

from __future__ import annotations

from repotide.llm import (
    audit,
    centroids,
    decontaminate,
    embeddings,
    language,
    licences,
    minhash,
    mixing,
    paragraphs,
    pivots,
    sharding,
    suffixes,
    toxicity,
)

QUERIES = {
    "op1_rp_forest_links": embeddings.op1_rp_forest_links,
    "op2_paragraph_minhash_dedup": paragraphs.op2_paragraph_minhash_dedup,
    "op3_word_backoff_langid": language.op3_word_backoff_langid,
    "op4_simhash_decontamination": decontaminate.op4_simhash_decontamination,
    "op5_pareto_mix": mixing.op5_pareto_mix,
    "op6_probminhash_dedup": minhash.op6_probminhash_dedup,
    "op7_clause_toxicity": toxicity.op7_clause_toxicity,
    "op8_licence_dice": licences.op8_licence_dice,
    "op9_suffix_merge_dedup": suffixes.op9_suffix_merge_dedup,
    "op10_ring_shards": sharding.op10_ring_shards,
    "op11_ns_bounds_centroids": centroids.op11_ns_bounds_centroids,
    "op12_filter_audit": audit.op12_filter_audit,
    "op13_pivot_topk": pivots.op13_pivot_topk,
}

ORACLE = {
    "op1_rp_forest_links": embeddings.SQL,
    "op5_pareto_mix": mixing.SQL,
    "op6_probminhash_dedup": minhash.SQL,
    "op8_licence_dice": licences.SQL,
    "op11_ns_bounds_centroids": centroids.SQL,
    "op12_filter_audit": audit.SQL,
    "op13_pivot_topk": pivots.SQL,
}
