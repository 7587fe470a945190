"""The queries of the training-data operators, each with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from .langid import op4_language_id
from .lines import op10_line_dedup
from .minhash import op5_minhash
from .mixing import op7_mixing
from .pieces import op8_sentencepiece
from .quality import OP9_SQL, op9_quality_rules
from .sharding import op2_sharding
from .suffixes import op3_suffix_dedup
from .tokens import op1_token_ids
from .topk import OP6_SQL, op6_top_k

QUERIES = {"op1_token_ids": op1_token_ids, "op2_sharding": op2_sharding, "op3_suffix_dedup": op3_suffix_dedup, "op4_language_id": op4_language_id, "op5_minhash": op5_minhash, "op6_top_k": op6_top_k, "op7_mixing": op7_mixing, "op8_sentencepiece": op8_sentencepiece, "op9_quality_rules": op9_quality_rules, "op10_line_dedup": op10_line_dedup}
ORACLE = {"op6_top_k": OP6_SQL, "op9_quality_rules": OP9_SQL}
