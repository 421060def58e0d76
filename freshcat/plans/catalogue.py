"""The catalogue's tables by role, read as a file given by the user says.

    {"item": "catalog.items",
     "id_map": {"table": "catalog.provider_ids",
                "columns": {"collection_id": "provider_collection", "asset_id": "provider_asset"}},
     ...}

``columns`` renames a table's columns to those a role needs; other columns are not read.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BRIDGE = ("item_id", "catalog_end_date")
#: Columns that the monthly job reads of each role.
ROLES = {
    "item": ("id", "name", "delivery_start_date", "delivery_end_date", "catalog_end_date"),
    "item_artist": ("artist_id", *_BRIDGE),
    "item_filetype": ("filetype_id", *_BRIDGE),
    "item_music": ("music_id", *_BRIDGE),
    "item_site": ("site_name", *_BRIDGE),
    "music": ("id", "name", "catalog_end_date"),
    "artist": ("id", "name", "catalog_end_date"),
    "id_map": ("collection_id", "asset_id", "material_id", "catalog_end_date"),
    "music_tieup": ("music_id", "tieup_id", "pattern_id", "catalog_end_date"),
    "tieup": ("id", "name", "detailgenre_id", "searchable", "catalog_end_date"),
    "flags": ("artist_id", "is_johnnys"),
    "album_detail": (
        "id", "title_title", "release_type", "title_titletype", "title_titlelanguage", "artist_names_language",
        "artist_names_text", "asset_structure", "catalog_end_date",
    ),
    "album_collection": ("collection_detail_id", "collection_id"),
}


def read_tables(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The frame of every role; the file must name a table for each."""
    with open(path, encoding="utf-8") as f:
        given = json.load(f)
    if missing := sorted(set(ROLES) - set(given)):
        raise ValueError(f"{path}: no table for {', '.join(missing)}")
    return {role: _frame(spark, given[role], ROLES[role]) for role in ROLES}


def read_role(spark: SparkSession, path: str, role: str) -> DataFrame:
    """One role, read through SQL text (S4): the second look at a table that came back empty (S3)."""
    with open(path, encoding="utf-8") as f:
        entry = json.load(f)[role]
    return _frame(spark, entry, ROLES[role], sql=True)


def _frame(spark: SparkSession, entry, columns, sql: bool = False) -> DataFrame:
    from freshcat.sources.tables import sql_scan

    entry = entry if isinstance(entry, dict) else {"table": entry}
    source = sql_scan(spark, entry["table"]) if sql else spark.table(entry["table"])
    names = entry.get("columns", {})
    return source.select(*[F.col(f"`{names.get(c, c)}`").alias(c) for c in columns])
