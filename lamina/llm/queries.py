"""Registered queries of the training-data operators, and their SQL oracles."""

from __future__ import annotations

from lamina.llm.bpe import op9_bpe
from lamina.llm.interactions import OP12_SQL, op12_filter_diagrams
from lamina.llm.line_index import OP13_SQL, op13_cuckoo_lines
from lamina.llm.lsh_forest import OP3_SQL, op3_lsh_forest
from lamina.llm.packing import op5_best_fit_packing
from lamina.llm.pii import op6_boosted_pii
from lamina.llm.quality import OP2_SQL, op2_line_cleaning
from lamina.llm.sharding import op10_hilbert_sharding
from lamina.llm.substring import op1_paragraph_minhash
from lamina.llm.topk import OP7_SQL, op7_branch_and_bound
from lamina.llm.toxicity import op4_toxicity
from lamina.llm.vector_codes import OP11_SQL, op11_trie_codes
from lamina.llm.warc import OP8_SQL, op8_warc_segments

QUERIES = {
    "op1_paragraph_minhash": op1_paragraph_minhash,
    "op2_line_cleaning": op2_line_cleaning,
    "op3_lsh_forest": op3_lsh_forest,
    "op4_toxicity": op4_toxicity,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_boosted_pii": op6_boosted_pii,
    "op7_branch_and_bound": op7_branch_and_bound,
    "op8_warc_segments": op8_warc_segments,
    "op9_bpe": op9_bpe,
    "op10_hilbert_sharding": op10_hilbert_sharding,
    "op11_trie_codes": op11_trie_codes,
    "op12_filter_diagrams": op12_filter_diagrams,
    "op13_cuckoo_lines": op13_cuckoo_lines,
}
ORACLE_SQL = {
    "op2_line_cleaning": OP2_SQL,
    "op3_lsh_forest": OP3_SQL,
    "op7_branch_and_bound": OP7_SQL,
    "op8_warc_segments": OP8_SQL,
    "op11_trie_codes": OP11_SQL,
    "op12_filter_diagrams": OP12_SQL,
    "op13_cuckoo_lines": OP13_SQL,
}
