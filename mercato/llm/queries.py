"""Registered queries of the training-data operators."""

from mercato.llm import cover_tree, hard_negatives, licences, sharding
from mercato.llm.cover_tree import op12_cover_tree_near_dedup
from mercato.llm.ctw import op1_context_tree_weighting
from mercato.llm.decontaminate import op7_benchmark_decontamination
from mercato.llm.hard_negatives import op11_hard_negative_mining
from mercato.llm.html_text import op9_html_extraction
from mercato.llm.licences import op8_licence_scan
from mercato.llm.neardup import op5_minhash_near_dedup
from mercato.llm.orc_tokens import op6_orc_tokens
from mercato.llm.packing import op2_best_fit_packing
from mercato.llm.periodic_runs import op13_periodic_runs
from mercato.llm.quality_rules import op3_quality_rules
from mercato.llm.sharding import op4_extendible_sharding
from mercato.llm.substring import op10_substring_dedup

QUERIES = {f.__name__: f for f in (
    op1_context_tree_weighting, op2_best_fit_packing, op3_quality_rules, op4_extendible_sharding,
    op5_minhash_near_dedup, op6_orc_tokens, op7_benchmark_decontamination, op8_licence_scan, op9_html_extraction,
    op10_substring_dedup, op11_hard_negative_mining, op12_cover_tree_near_dedup, op13_periodic_runs)}

# The others need a tokenizer, a model or hashes that SQL doesn't have; their
# tests compare with brute force.
ORACLE_SQL = {"op4_extendible_sharding": sharding.oracle(), "op8_licence_scan": licences.oracle(),
              "op11_hard_negative_mining": hard_negatives.oracle(),
              "op12_cover_tree_near_dedup": cover_tree.oracle()}
