"""Null handling of the fact projection."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def default_if_null(column: Column | str, default, data_type: DataType | None = None) -> Column:
    """``x`` or ``default`` when NULL, keeping the type of ``x``.

    Give ``data_type`` (the type of ``x``) so the default is cast to it: a string id gets
    ``"0"`` and stays a string, an int id gets ``0`` (hazard H5: a bare ``when(isNull, 0)``
    over a string coerces to a number under ANSI and fails on non-numeric ids).
    """
    if data_type is None:
        fallback = F.lit(default)
    elif isinstance(data_type, StringType):
        fallback = F.lit(str(default))
    else:
        fallback = F.lit(default).cast(data_type)
    return F.coalesce(_col(column), fallback)


def null_to_text(column: Column | str, text: str = "null") -> Column:
    """NULL -> the literal text ``"null"``, result cast to string."""
    return F.coalesce(_col(column).cast("string"), F.lit(text))
