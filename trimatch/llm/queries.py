"""Driver queries of the training-data operators and their SQL twins."""

from __future__ import annotations

from . import chat, decontaminate
from .ann import op3_tree_neighbours
from .chat import op2_chat_perspectives
from .chosen_path import op7_near_duplicates
from .decontaminate import op10_decontamination
from .maxent import op6_maxent_scores
from .packing import op1_packing
from .pii import op5_pseudonyms
from .quality import op9_quality
from .resampling import op13_resampling
from .sharding import op12_sharding
from .suffix_trees import op4_suffix_dedup
from .token_files import op8_token_files
from .whitening import op11_whitening

QUERIES = {f.__name__: f for f in (
    op1_packing, op2_chat_perspectives, op3_tree_neighbours, op4_suffix_dedup, op5_pseudonyms,
    op6_maxent_scores, op7_near_duplicates, op8_token_files, op9_quality, op10_decontamination,
    op11_whitening, op12_sharding, op13_resampling)}

ORACLES = {
    "op2_chat_perspectives": chat.ORACLE,
    "op10_decontamination": decontaminate.ORACLE,
}
