"""Row filters of the catalogue jobs."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from freshcat.functions.timezone import JST, month_range_predicate


def current_rows(df: DataFrame, end_column: str = "catalog_end_date") -> DataFrame:
    """Keep the current version of an SCD-2 dimension: ``end_column IS NULL`` (F1)."""
    return df.filter(F.col(end_column).isNull())


def in_local_month(df: DataFrame, ts_column: str, month: str, tz: str = JST) -> DataFrame:
    """Rows whose UTC instant ``ts_column`` falls in local month ``YYYY-MM`` (F2).

    Written as a half-open range over the stored column so it reaches the parquet scan.
    """
    dtype = df.schema[ts_column].dataType
    return df.filter(month_range_predicate(ts_column, month, tz, dtype))


def in_local_months(df: DataFrame, ts_column: str, oldest: str, newest: str, tz: str = JST) -> DataFrame:
    """Rows whose instant falls in local months ``oldest`` .. ``newest`` (both included);
    one pushable range, the month of each row is derived separately."""
    from freshcat.functions.timezone import _instant_literal, local_month_bounds

    dtype = df.schema[ts_column].dataType
    start, _ = local_month_bounds(oldest, tz)
    _, end = local_month_bounds(newest, tz)
    col = F.col(ts_column)
    return df.filter((col >= _instant_literal(start, dtype)) & (col < _instant_literal(end, dtype)))


def corner_filter(
    df: DataFrame,
    site_column: str,
    site_value: str,
    code_column: str,
    codes: Iterable,
) -> DataFrame:
    """``site = value AND code IN (codes)``.

    Codes are compared in the column's own type: give string codes for a string column
    (``"070040"`` and ``"70040"`` are different strings, hazard H6). An IN-list of this
    size is pushed into the scan as a set filter.
    """
    return df.filter((F.col(site_column) == F.lit(site_value)) & codes_in(df, code_column, codes))


def codes_in(df: DataFrame, code_column: str, codes: Iterable) -> Column:
    """``code IN (codes)``, compared in the column's own type.

    Text codes against a numeric column compare as numbers ("070040" matches 70040); a code
    that is not a number cannot match (H6) instead of failing under ANSI."""
    codes = list(codes)
    if isinstance(df.schema[code_column].dataType, IntegralType):
        codes = [int(c) for c in codes if str(c).strip().lstrip("+-").isdigit()]
    else:
        codes = [str(c) for c in codes]
    return F.col(code_column).isin(codes)


def all_of(df: DataFrame, equals: Mapping[str, object] | None = None, null: Iterable[str] = ()) -> DataFrame:
    """Conjunction of equalities and ``IS NULL`` tests (F5: album selection)."""
    cond: Column = F.lit(True)
    for name, value in (equals or {}).items():
        cond = cond & (F.col(name) == F.lit(value))
    for name in null:
        cond = cond & F.col(name).isNull()
    return df.filter(cond)


def searchable(df: DataFrame, flag_column: str = "searchable", keep_missing: bool = False) -> DataFrame:
    """Tie-up visibility filter.

    ``keep_missing=False``: ``flag != 0`` (F6). NULL-rejecting, so items without a tie-up
    drop out and Catalyst turns the preceding left joins into inner joins.
    ``keep_missing=True``: ``flag != 0 OR flag IS NULL`` (F7), items without a tie-up stay.
    """
    flag = F.col(flag_column)
    cond = flag != 0
    if keep_missing:
        cond = cond | flag.isNull()
    return df.filter(cond)
