"""Reusable frame operators of the catalogue jobs."""

from freshcat.operators.backfill import keep_until_target, months_until_target
from freshcat.operators.dedup import filter_duplicate_tieup_item, first_per_key
from freshcat.operators.explode import explode_tracks
from freshcat.operators.filters import (
    all_of,
    corner_filter,
    current_rows,
    in_local_month,
    in_local_months,
    searchable,
)
from freshcat.operators.joins import Hop, flag_lookup, join_dim_material, join_hop, key_pair, snowflake_left_join
from freshcat.operators.ordering import total_order, total_order_items
from freshcat.operators.ranking import global_row_number, having_count, top_k
from freshcat.operators.rollup import OUTPUT_COLUMNS, aggregate_musics_to_album, rollup_groups

__all__ = [
    "OUTPUT_COLUMNS",
    "Hop",
    "aggregate_musics_to_album",
    "all_of",
    "corner_filter",
    "current_rows",
    "explode_tracks",
    "filter_duplicate_tieup_item",
    "first_per_key",
    "flag_lookup",
    "global_row_number",
    "having_count",
    "in_local_month",
    "in_local_months",
    "keep_until_target",
    "join_dim_material",
    "join_hop",
    "months_until_target",
    "rollup_groups",
    "searchable",
    "key_pair",
    "snowflake_left_join",
    "top_k",
    "total_order",
    "total_order_items",
]
