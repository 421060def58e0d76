"""Corner configuration (S12): one entry per (site, corner) replaces a script each.

Corners differ in the site contract name, the file type codes, a tie-up filter that may
keep items without a tie-up, and a fallback scan for an empty collection bridge. They are
read from a JSON file that the user gives:

    [{"site": "shop_ios", "corner": "wallpaper", "site_name": "Shop (iOS)",
      "filetype_ids": ["030300"], "require_tieup": true, "fallback_collection_bridge": false}]

Codes are strings and compared as strings with a text column (``"070040"`` and ``"70040"``
are different values), as numbers with a numeric one.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, StringType, StructField, StructType


@dataclass(frozen=True)
class Corner:
    site: str
    corner: str
    site_name: str
    filetype_ids: tuple = field(default_factory=tuple)
    require_tieup: bool = True
    fallback_collection_bridge: bool = False


CORNER_SCHEMA = StructType(
    [
        StructField("site", StringType(), False),
        StructField("corner", StringType(), False),
        StructField("site_name", StringType(), False),
        StructField("filetype_id", StringType(), False),
        StructField("require_tieup", BooleanType(), False),
    ]
)


def corner_frame(spark: SparkSession, corners: Sequence[Corner]) -> DataFrame:
    """One row per (corner, file type code): the join table of the all-corners job.

    Its size is the configuration's size (tens of rows), so it is safe to broadcast.
    """
    data = [
        (c.site, c.corner, c.site_name, str(code), c.require_tieup) for c in corners for code in c.filetype_ids
    ]
    return spark.createDataFrame(data, CORNER_SCHEMA)


def read_corners(path: str) -> tuple[Corner, ...]:
    """Corners of a JSON file; unknown keys, repeated and empty entries are errors."""
    with open(path, encoding="utf-8") as f:
        entries = json.load(f)
    corners = tuple(Corner(**{**e, "filetype_ids": tuple(map(str, e.get("filetype_ids", ())))}) for e in entries)
    if not corners or len({(c.site, c.corner) for c in corners}) < len(corners):
        raise ValueError(f"{path}: no corners, or a (site, corner) twice")
    return corners


def corner_by_name(site: str, corner: str, corners: Sequence[Corner]) -> Corner:
    for c in corners:
        if c.site == site and c.corner == corner:
            return c
    raise KeyError(f"unknown corner {site}/{corner}")
