from trilayer.operators.dedupe import dedupe
from trilayer.operators.joins import KEEP_SPREADS, Spread, keyed_left_join, spread_by_key
from trilayer.operators.ranking import (
    global_dense_rank,
    global_ntile,
    global_ntiles,
    global_row_index,
    share_of_total,
)
from trilayer.operators.settle import FREE_SHUFFLES, discard, expire_scratch, run_scope, session_beside, session_settings, settle

__all__ = [
    "FREE_SHUFFLES", "KEEP_SPREADS", "Spread", "dedupe", "discard", "expire_scratch", "global_dense_rank", "global_ntile", "global_ntiles",
    "global_row_index", "keyed_left_join", "run_scope", "session_beside", "session_settings", "settle", "share_of_total", "spread_by_key",
]
