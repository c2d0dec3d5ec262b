"""Queries of this subpackage, and the SQL they are checked against where SQL can express them."""

from __future__ import annotations

from .chat import OP9_SQL, op9_chat_rotation
from .decontaminate import op3_benchmark_decontamination
from .language import op2_language_id
from .lattice import op7_embedding_near_dedup
from .lexical import OP12_SQL, op12_lexical_search
from .mixing import op10_source_mix
from .polytope import op13_nearest_neighbours
from .ppm import op6_lm_scores
from .prefix_trie import OP11_SQL, op11_prefix_trie
from .secrets import op4_secret_scan
from .simhash import op5_simhash_near_dedup
from .token_counts import op8_token_counts
from .toxicity import op1_toxicity

OPERATORS = (
    op1_toxicity, op2_language_id, op3_benchmark_decontamination, op4_secret_scan, op5_simhash_near_dedup, op6_lm_scores, op7_embedding_near_dedup,
    op8_token_counts, op9_chat_rotation, op10_source_mix, op11_prefix_trie, op12_lexical_search, op13_nearest_neighbours,
)
QUERIES = {f.__name__: f for f in OPERATORS}

ORACLE_SQL: dict[str, str] = {"op9_chat_rotation": OP9_SQL, "op11_prefix_trie": OP11_SQL, "op12_lexical_search": OP12_SQL}
