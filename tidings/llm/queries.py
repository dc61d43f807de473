"""The registered queries of this package and their SQL."""

from tidings.llm.chat_format import ORACLE as CHAT_ORACLE, op2_chat_format
from tidings.llm.cover_tree import ORACLE as COVER_ORACLE, op12_hard_negatives
from tidings.llm.decontamination import op6_template_decontamination
from tidings.llm.importance import ORACLE as IMPORTANCE_ORACLE, op11_importance_resampling
from tidings.llm.language_id import op1_language_id
from tidings.llm.lm_scoring import op10_context_tree_scoring
from tidings.llm.mixing import op8_entropy_mixing
from tidings.llm.prefix_forest import op13_prefix_forest
from tidings.llm.quality_classifier import op3_quality_classifier
from tidings.llm.quality_rules import op5_quality_rules
from tidings.llm.sharding import op9_kd_sharding
from tidings.llm.simhash import op7_simhash
from tidings.llm.substring_dedup import op4_substring_dedup

QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_chat_format": op2_chat_format,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_template_decontamination": op6_template_decontamination,
    "op7_simhash": op7_simhash,
    "op8_entropy_mixing": op8_entropy_mixing,
    "op9_kd_sharding": op9_kd_sharding,
    "op10_context_tree_scoring": op10_context_tree_scoring,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_prefix_forest": op13_prefix_forest,
}

# The others have no SQL: models are trained, tilts solved by iteration, cuts depend on each other, and DuckDB has neither
# zstandard ratios, XXH64 of a given seed, nor the look-behind of the template's tokens. They are tested against brute force.
ORACLE = {
    "op2_chat_format": CHAT_ORACLE,
    "op11_importance_resampling": IMPORTANCE_ORACLE,
    "op12_hard_negatives": COVER_ORACLE,
}
