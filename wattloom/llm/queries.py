"""The registered queries of this folder and their SQL equivalents."""

from __future__ import annotations

import corpus_pipeline
from wattloom.llm.alignment import op13_shared_cuts
from wattloom.llm.forest import op11_lsh_forest
from wattloom.llm.host_rules import OP3_SQL, op3_host_rules
from wattloom.llm.interpolated import op2_interpolated_lm
from wattloom.llm.language import op5_language_id
from wattloom.llm.manifest import OP12_SQL, op12_merkle_manifest
from wattloom.llm.mixing import op1_source_mix
from wattloom.llm.neighbours import op7_projected_kd_search
from wattloom.llm.packing import op4_best_fit_packing
from wattloom.llm.pages import op8_page_differencing
from wattloom.llm.quality import op6_line_crf
from wattloom.llm.simhash import op9_gray_simhash
from wattloom.llm.toxicity import op10_clause_grammar

QUERIES = {
    "op1_source_mix": op1_source_mix,
    "op2_interpolated_lm": op2_interpolated_lm,
    "op3_host_rules": op3_host_rules,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_language_id": op5_language_id,
    "op6_line_crf": op6_line_crf,
    "op7_projected_kd_search": op7_projected_kd_search,
    "op8_page_differencing": op8_page_differencing,
    "op9_gray_simhash": op9_gray_simhash,
    "op10_clause_grammar": op10_clause_grammar,
    "op11_lsh_forest": op11_lsh_forest,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_shared_cuts": op13_shared_cuts,
    "pipeline": corpus_pipeline.run,
}
SQL: dict[str, str] = {
    "op3_host_rules": OP3_SQL,
    "op12_merkle_manifest": OP12_SQL,
}
