"""Sort specifications and total orders.

The catalogue jobs rank by a single column with many ties (score is constant, release
dates repeat), so which row survives a "first per group" is left to chance, and a frame
that is read twice may cut ties differently in each read (hazard H9). Every ranking
operator here therefore takes ``ties`` and, by default, appends all remaining orderable
columns: the result is the same on every run and on every retry of a lost task.

Null order follows Spark: ascending = NULLS FIRST, descending = NULLS LAST.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

OrderItem = Union[str, tuple, Column]


def sort_expr(item: OrderItem) -> Column:
    if isinstance(item, Column):
        return item
    if isinstance(item, str):
        return F.col(item).asc()
    name, ascending = item
    return F.col(name).asc() if ascending else F.col(name).desc()


def order_names(order: Iterable[OrderItem]) -> list[str]:
    names = []
    for item in order:
        if isinstance(item, str):
            names.append(item)
        elif isinstance(item, tuple):
            names.append(item[0])
    return names


def _orderable(dtype) -> bool:
    if isinstance(dtype, MapType):
        return False
    if isinstance(dtype, ArrayType):
        return _orderable(dtype.elementType)
    if isinstance(dtype, StructType):
        return all(_orderable(f.dataType) for f in dtype.fields)
    return True


def total_order(
    df: DataFrame,
    order: Sequence[OrderItem],
    ties: Sequence[OrderItem] | None = None,
    exclude: Iterable[str] = (),
) -> list[Column]:
    """``order`` followed by ``ties``; ``ties=None`` means every other orderable column
    of ``df`` ascending (a total order whenever the rows are distinct)."""
    exprs = [sort_expr(o) for o in order]
    if ties is None:
        used = set(order_names(order)) | set(exclude)
        ties = [f.name for f in df.schema.fields if f.name not in used and _orderable(f.dataType)]
    return exprs + [sort_expr(t) for t in ties]


def total_order_items(
    df: DataFrame,
    order: Sequence[tuple | str],
    ties: Sequence[tuple | str] | None = None,
    exclude: Iterable[str] = (),
) -> list[tuple[str, bool]]:
    """Like :func:`total_order` but as ``(name, ascending)`` pairs (named columns only)."""
    def norm(item):
        return (item, True) if isinstance(item, str) else (item[0], bool(item[1]))

    items = [norm(o) for o in order]
    if ties is None:
        used = {n for n, _ in items} | set(exclude)
        ties = [f.name for f in df.schema.fields if f.name not in used and _orderable(f.dataType)]
    return items + [norm(t) for t in ties]
