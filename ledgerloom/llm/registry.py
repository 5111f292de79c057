"""The numbered queries of this folder, the pipeline, and their SQL."""

from __future__ import annotations

import corpus_pipeline
from ledgerloom.llm import (
    decontaminate,
    exact_topk,
    fill_in_middle,
    language_id,
    lattice_lm,
    licences,
    ngram_join,
    periodic_runs,
    piece_transducer,
    substring_dedup,
    token_files,
    toxicity,
    url_filter,
)

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_licences": licences.op2_licences,
    "op3_ngram_join": ngram_join.op3_ngram_join,
    "op4_exact_topk": exact_topk.op4_exact_topk,
    "op5_token_files": token_files.op5_token_files,
    "op6_substring_dedup": substring_dedup.op6_substring_dedup,
    "op7_language_id": language_id.op7_language_id,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_sentencepiece": piece_transducer.op9_sentencepiece,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_fill_in_middle": fill_in_middle.op11_fill_in_middle,
    "op12_periodic_runs": periodic_runs.op12_periodic_runs,
    "op13_lattice_lm": lattice_lm.op13_lattice_lm,
}
ORACLE = {
    "op1_decontaminate": decontaminate.OP1_SQL,
    "op4_exact_topk": exact_topk.OP4_SQL,
    "op6_substring_dedup": substring_dedup.OP6_SQL,
    "op8_url_filter": url_filter.OP8_SQL,
    "op11_fill_in_middle": fill_in_middle.OP11_SQL,
}
