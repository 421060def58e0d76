"""JSON schema of an album's asset structure.

An album document looks like ``{"Items": [...], "Groups": [{"Items": [{"AssetId": n, ...}],
"Groups": [...], "Titles": [...], "SequenceNumber": n}, ...]}``. Only
``Groups[*].Items[*].AssetId`` is ever read, so only that path is declared: Spark then
parses less, and a mistyped field that is never read cannot null the record.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

_ID_TYPES = {"int": IntegerType(), "bigint": LongType(), "long": LongType()}


def asset_structure_schema(id_type: str | DataType = "int") -> StructType:
    """Schema with ``Groups: array<struct<Items: array<struct<AssetId: id_type>>>>``.

    ``int`` matches the catalogue (ids beyond the int range or given as strings parse
    to NULL, hazard H2); ``bigint`` widens the id.
    """
    dtype = _ID_TYPES[id_type] if isinstance(id_type, str) else id_type
    item = StructType([StructField("AssetId", dtype, True)])
    group = StructType([StructField("Items", ArrayType(item, True), True)])
    return StructType([StructField("Groups", ArrayType(group, True), True)])


ASSET_STRUCTURE_SCHEMA = asset_structure_schema("int")
