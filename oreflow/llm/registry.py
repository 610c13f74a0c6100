"""Queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from .op1_packing import op1_packing
from .op2_quality_rules import op2_quality_rules
from .op3_lm_scoring import op3_lm_scoring
from .op4_minhash_dedup import op4_minhash_dedup
from .op5_suffix_dedup import op5_suffix_dedup
from .op6_decontamination import OP6_SQL, op6_decontamination
from .op7_line_dedup import OP7_SQL, op7_line_dedup
from .op8_quality_classifier import op8_quality_classifier
from .op9_toxicity import op9_toxicity
from .op10_sharding import OP10_SQL, op10_sharding
from .op11_prefix_trie import OP11_SQL, op11_prefix_trie
from .op12_sentencepiece import op12_sentencepiece
from .op13_whitening import op13_whitening

QUERIES = {f.__name__: f for f in (
    op1_packing, op2_quality_rules, op3_lm_scoring, op4_minhash_dedup, op5_suffix_dedup, op6_decontamination, op7_line_dedup, op8_quality_classifier, op9_toxicity, op10_sharding,
    op11_prefix_trie, op12_sentencepiece, op13_whitening)}

SQL = {"op6_decontamination": OP6_SQL, "op7_line_dedup": OP7_SQL, "op10_sharding": OP10_SQL,
       "op11_prefix_trie": OP11_SQL}
