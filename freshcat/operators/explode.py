"""Album track explode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from freshcat.functions.nested import asset_structure_schema


def explode_tracks(
    df: DataFrame,
    structure_column: str = "asset_structure",
    output: str = "album_track_asset_id",
    id_type: str | DataType = "bigint",
) -> DataFrame:
    """One row per track id of the album's **first** group; drops the JSON column.

    * JSON is parsed with ``from_json`` (PERMISSIVE): malformed text or NULL gives a NULL
      structure.
    * ``get(Groups, 0)`` takes the first group and is NULL for an empty array (an
      ``[0]`` index would fail under ANSI, hazard H1). Groups after the first and
      top-level ``Items`` are ignored (H2).
    * ``explode_outer`` keeps albums without tracks as one row with a NULL id.

    Everything stays a JVM expression; rows are independent, so the operator is a
    narrow, per-partition transformation (no shuffle).
    """
    parsed = F.from_json(F.col(structure_column), asset_structure_schema(id_type))
    first_group = F.get(parsed.getField("Groups"), F.lit(0))
    ids = first_group.getField("Items").getField("AssetId")
    keep = [F.col(c) for c in df.columns if c != structure_column]
    return df.select(*keep, F.explode_outer(ids).alias(output))
