"""Registered queries of the training-data operators: name -> (function, DuckDB SQL or None)."""

from __future__ import annotations

from logweave.llm import line_dedup, main_text, mixing, ngram_join, packing, periodic_runs, perplexity, spelling, token_matrix, topk, toxicity, url_filter, wordpiece

QUERIES = {
    "op1_mixing": (mixing.op1_mixing, None),
    "op2_toxicity": (toxicity.op2_toxicity, None),
    "op3_ngram_join": (ngram_join.op3_ngram_join, ngram_join.OP3_SQL),
    "op4_topk": (topk.op4_topk, topk.OP4_SQL),
    "op5_token_counts": (wordpiece.op5_token_counts, None),
    "op6_token_matrix": (token_matrix.op6_token_matrix, None),
    "op7_perplexity": (perplexity.op7_perplexity, None),
    "op8_packing": (packing.op8_packing, None),
    "op9_line_dedup": (line_dedup.op9_line_dedup, line_dedup.OP9_SQL),
    "op10_url_filter": (url_filter.op10_url_filter, None),
    "op11_html_extraction": (main_text.op11_html_extraction, None),
    "op12_periodic_runs": (periodic_runs.op12_periodic_runs, None),
    "op13_spelling_forms": (spelling.op13_spelling_forms, spelling.OP13_SQL),
}
