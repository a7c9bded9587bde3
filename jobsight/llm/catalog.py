"""Queries of this subpackage and their SQL, added to the driver's by ``__spark_entry__``."""

from __future__ import annotations

import corpus_pipeline
from jobsight.llm.bpe import op13_duckdb_bpe
from jobsight.llm.decontaminate import op8_edit_matching
from jobsight.llm.fim import OP11_SQL, op11_wavelet_fim
from jobsight.llm.imatch import op6_imatch
from jobsight.llm.importance import OP12_SQL, op12_quickselect
from jobsight.llm.langid import op5_naive_bayes
from jobsight.llm.minhash import op1_minhash
from jobsight.llm.packing import op10_best_fit
from jobsight.llm.pii import op9_disclosure
from jobsight.llm.quality import op7_rule_ensemble
from jobsight.llm.sharding import op4_consistent_ring
from jobsight.llm.suffixes import op3_deep_shallow
from jobsight.llm.warc import OP2_SQL, op2_transactions

QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_transactions": op2_transactions,
    "op3_deep_shallow": op3_deep_shallow,
    "op4_consistent_ring": op4_consistent_ring,
    "op5_naive_bayes": op5_naive_bayes,
    "op6_imatch": op6_imatch,
    "op7_rule_ensemble": op7_rule_ensemble,
    "op8_edit_matching": op8_edit_matching,
    "op9_disclosure": op9_disclosure,
    "op10_best_fit": op10_best_fit,
    "op11_wavelet_fim": op11_wavelet_fim,
    "op12_quickselect": op12_quickselect,
    "op13_duckdb_bpe": op13_duckdb_bpe,
    "pipeline": corpus_pipeline.run,
}

SQL: dict[str, str] = {
    "op2_transactions": OP2_SQL,
    "op11_wavelet_fim": OP11_SQL,
    "op12_quickselect": OP12_SQL,
}
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
