"""Registered queries of the training-data operators and, where SQL expresses them, their DuckDB SQL."""

from __future__ import annotations

from gridloom.llm.bucket_digest import op5_bucket_digest
from gridloom.llm.class_lm import op13_class_lm
from gridloom.llm.hard_negatives import op12_hard_negatives
from gridloom.llm.line_dedup import op7_line_dedup
from gridloom.llm.mixing import OP9_SQL, op9_source_mix
from gridloom.llm.periodic_runs import op11_periodic_runs
from gridloom.llm.packing import op8_best_fit_packing
from gridloom.llm.pii import op2_pii
from gridloom.llm.secrets import op1_secret_scan
from gridloom.llm.simhash import op4_simhash
from gridloom.llm.token_index import op3_token_index
from gridloom.llm.toxicity import op10_toxicity
from gridloom.llm.vector_dedup import op6_vector_graph

LLM_QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_pii": op2_pii,
    "op3_token_index": op3_token_index,
    "op4_simhash": op4_simhash,
    "op5_bucket_digest": op5_bucket_digest,
    "op6_vector_graph": op6_vector_graph,
    "op7_line_dedup": op7_line_dedup,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_source_mix": op9_source_mix,
    "op10_toxicity": op10_toxicity,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_class_lm": op13_class_lm,
}
LLM_SQL = {"op9_source_mix": OP9_SQL}
