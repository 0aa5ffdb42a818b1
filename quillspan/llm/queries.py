"""Queries of the training-data operators and the DuckDB SQL that some of them have."""

from __future__ import annotations

from .chat import OP3_SQL, op3_chat
from .decontamination import op7_decontamination
from .packing import op1_packing
from .lm_scoring import op5_lm_scoring
from .pii import op6_pii
from .quality import OP4_SQL, op4_quality
from .sharding import op9_sharding
from .simhash import op2_simhash
from .substring_dedup import op8_substring_dedup
from .token_counts import op10_token_counts

QUERIES = {
    "op1_packing": op1_packing,
    "op2_simhash": op2_simhash,
    "op3_chat": op3_chat,
    "op4_quality": op4_quality,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_pii": op6_pii,
    "op7_decontamination": op7_decontamination,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_sharding": op9_sharding,
    "op10_token_counts": op10_token_counts,
}
ORACLES = {"op3_chat": OP3_SQL, "op4_quality": OP4_SQL}
