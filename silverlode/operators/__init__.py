"""DataFrame operators built from Spark's own ones, each safe against hot keys."""

from silverlode.operators.bitmaps import key_filter, reduced_join, rolled_up_distinct
from silverlode.operators.groups import latest_per_key, with_group_max, with_next_value
from silverlode.operators.joins import ROW_ID, balanced_join, hot_keys
from silverlode.operators.keys import add_dense_key
from silverlode.operators.measures import group_with_distinct, long_measures, with_grand_total
from silverlode.operators.ranking import bottom_k, top_dense_ranks, top_k, top_row_numbers
from silverlode.operators.running import with_running

__all__ = [
    "key_filter", "reduced_join", "rolled_up_distinct",
    "latest_per_key", "with_group_max", "with_next_value",
    "ROW_ID", "balanced_join", "hot_keys",
    "add_dense_key",
    "group_with_distinct", "long_measures", "with_grand_total",
    "bottom_k", "top_dense_ranks", "top_k", "top_row_numbers",
    "with_running",
]
