"""The queries of this subpackage, by name, and their oracle SQL where SQL can express one."""

from __future__ import annotations

from llm.bpe_automaton import op2_bpe_automaton
from llm.extendible_shards import OP8_SQL, op8_extendible_shards
from llm.filter_audit import OP12_SQL, op12_filter_audit
from llm.hard_negatives import OP13_SQL, op13_hard_negatives
from llm.line_templates import OP1_SQL, op1_line_templates
from llm.lsh_forest import op10_lsh_forest
from llm.pairwise_quality import op3_pairwise_quality
from llm.perplexity_rules import op6_perplexity_rules
from llm.pii_bootstrap import op11_pii_bootstrap
from llm.shared import shipped
from llm.substring_dedup import op9_substring_dedup
from llm.suffix_dedup import op5_suffix_dedup
from llm.template_decontamination import op4_template_decontamination
from llm.warc import op7_warc

_ALL = {
    "op1_line_templates": op1_line_templates,
    "op2_bpe_automaton": op2_bpe_automaton,
    "op3_pairwise_quality": op3_pairwise_quality,
    "op4_template_decontamination": op4_template_decontamination,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_perplexity_rules": op6_perplexity_rules,
    "op7_warc": op7_warc,
    "op8_extendible_shards": op8_extendible_shards,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_lsh_forest": op10_lsh_forest,
    "op11_pii_bootstrap": op11_pii_bootstrap,
    "op12_filter_audit": op12_filter_audit,
    "op13_hard_negatives": op13_hard_negatives,
}

QUERIES = {name: shipped(query) for name, query in _ALL.items()}

ORACLES = {"op1_line_templates": OP1_SQL, "op8_extendible_shards": OP8_SQL, "op12_filter_audit": OP12_SQL, "op13_hard_negatives": OP13_SQL}
