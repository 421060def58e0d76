"""Column-level helpers (pure ``Column -> Column`` or small literal builders)."""

from freshcat.functions.calendar import day_sequence, month_sequence
from freshcat.functions.defaults import default_if_null, null_to_text
from freshcat.functions.nested import ASSET_STRUCTURE_SCHEMA, asset_structure_schema
from freshcat.functions.timezone import (
    JST,
    local_epoch_seconds,
    local_month_bounds,
    month_range_predicate,
    to_local_wall_clock,
)

__all__ = [
    "ASSET_STRUCTURE_SCHEMA",
    "JST",
    "asset_structure_schema",
    "day_sequence",
    "default_if_null",
    "local_epoch_seconds",
    "local_month_bounds",
    "month_range_predicate",
    "month_sequence",
    "null_to_text",
    "to_local_wall_clock",
]
