"""Queries of the operators (op1 to op13) and their DuckDB SQL where there is one."""

from __future__ import annotations

from .centroid_eenns import OP11_SQL, op11_centroid_eenns
from .chat_repair import op7_chat_repair
from .cost_packing import op13_cost_packing
from .decontaminate_cgk import op1_decontaminate_cgk
from .html_tree import op8_html_tree
from .packing import op6_pattern_packing
from .pii_weak import op2_pii_weak
from .prefix_trie import OP12_SQL, op12_prefix_trie
from .quality_zstd import op9_quality_zstd
from .secret_structure import op5_secret_structure
from .simhash_pivots import op10_simhash_pivots
from .topk_nra import OP4_SQL, op4_topk_nra
from .toxicity_weak import op3_toxicity_weak

QUERIES = {
    "op1_decontaminate_cgk": op1_decontaminate_cgk,
    "op2_pii_weak": op2_pii_weak,
    "op3_toxicity_weak": op3_toxicity_weak,
    "op4_topk_nra": op4_topk_nra,
    "op5_secret_structure": op5_secret_structure,
    "op6_pattern_packing": op6_pattern_packing,
    "op7_chat_repair": op7_chat_repair,
    "op8_html_tree": op8_html_tree,
    "op9_quality_zstd": op9_quality_zstd,
    "op10_simhash_pivots": op10_simhash_pivots,
    "op11_centroid_eenns": op11_centroid_eenns,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_cost_packing": op13_cost_packing,
}

ORACLE: dict[str, str] = {
    "op4_topk_nra": OP4_SQL,
    "op11_centroid_eenns": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
}
