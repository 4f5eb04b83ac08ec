"""The corpus queries and their DuckDB SQL, by name."""

from __future__ import annotations

from tessera.llm import (
    bpe, decontaminate, kmeans, lexical, line_dedup, ngram_join, pii, secrets_scan, suffix_dedup,
    token_output, topk, toxicity, warc)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_ngram_jaccard_join": ngram_join.op2_ngram_jaccard_join,
    "op3_token_output": token_output.op3_token_output,
    "op4_pii": pii.op4_pii,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_exact_top_k": topk.op7_exact_top_k,
    "op8_byte_bpe": bpe.op8_byte_bpe,
    "op9_decontamination": decontaminate.op9_decontamination,
    "op10_warc": warc.op10_warc,
    "op11_centroid_clustering": kmeans.op11_centroid_clustering,
    "op12_secret_scan": secrets_scan.op12_secret_scan,
    "op13_ranked_search": lexical.op13_ranked_search,
}

SQL = {
    "op2_ngram_jaccard_join": ngram_join.OP2_SQL,
    "op7_exact_top_k": topk.OP7_SQL,
    "op9_decontamination": decontaminate.OP9_SQL,
    "op11_centroid_clustering": kmeans.OP11_SQL,
    "op13_ranked_search": lexical.OP13_SQL,
}
