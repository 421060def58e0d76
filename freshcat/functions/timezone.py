"""Time zone helpers: UTC storage, local (default JST) wall clock, month windows.

The catalogue stores instants in UTC. The monthly job asks "which items started in month M
*local time*". Writing that as ``LIKE 'YYYY-MM%'`` over a shifted timestamp cannot be pushed
to the scan; :func:`month_range_predicate` instead compares the raw stored column with the
two UTC instants that bound the local month, as literals of the column's own type, so the
parquet reader sees ``PushedFilters: [GreaterThanOrEqual(...), LessThan(...)]``.
"""

from __future__ import annotations

from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

# Fixed value: the catalogue's local zone.
JST = "Asia/Tokyo"


def to_local_wall_clock(column: Column | str, tz: str = JST) -> Column:
    """UTC instant -> local wall clock (``from_utc_timestamp``); result is TIMESTAMP."""
    col = F.col(column) if isinstance(column, str) else column
    return F.from_utc_timestamp(col, tz)


def local_epoch_seconds(column: Column | str, tz: str = JST) -> Column:
    """Epoch seconds of the *shifted* wall clock, as the catalogue jobs compute it.

    The value is ``true epoch + zone offset`` (hazard H4: 9 h ahead for JST), a BIGINT: no
    date is lost after 2038-01-19 (H3).
    """
    return F.unix_seconds(to_local_wall_clock(column, tz))


def local_month_bounds(month: str, tz: str = JST) -> tuple[datetime, datetime]:
    """UTC instants (naive, UTC wall clock) bounding local month ``YYYY-MM``: [start, end)."""
    year, mon = (int(part) for part in month.split("-")[:2])
    zone = ZoneInfo(tz)
    start = datetime(year, mon, 1, tzinfo=zone)
    end = datetime(year + (mon == 12), mon % 12 + 1, 1, tzinfo=zone)
    return (
        start.astimezone(timezone.utc).replace(tzinfo=None),
        end.astimezone(timezone.utc).replace(tzinfo=None),
    )


def _instant_literal(value: datetime, data_type: DataType | None) -> Column:
    """A literal of the column's own timestamp type so that the comparison is not cast."""
    text = value.strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(data_type, TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    # TIMESTAMP (LTZ): give the offset explicitly so the session zone does not matter.
    return F.lit(text.replace(" ", "T") + "+00:00").cast("timestamp")


def month_range_predicate(
    column: str, month: str, tz: str = JST, data_type: DataType | None = None
) -> Column:
    """``column`` (a UTC instant) falls in local month ``month`` (``YYYY-MM``).

    Same rows as ``date_format(from_utc_timestamp(column, tz), 'yyyy-MM') = month`` but
    pushable. Pass the column's ``data_type`` (NTZ or LTZ) so the literal type matches.
    """
    start, end = local_month_bounds(month, tz)
    col = F.col(column)
    return (col >= _instant_literal(start, data_type)) & (col < _instant_literal(end, data_type))


def local_month_partition(column: Column | str, tz: str = JST) -> Column:
    """Partition value ``YYYYMM01`` of the local month of a UTC instant."""
    return F.concat(F.date_format(to_local_wall_clock(column, tz), "yyyyMM"), F.lit("01"))
