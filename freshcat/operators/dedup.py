"""First row per key.

``row_number() over (partition by key order by ...) = 1`` is planned by Spark as a
partial ``WindowGroupLimit`` in every map task, then a shuffle, then the final limit:
a key that holds a third of all rows sends one row per task through the shuffle.

NULL keys: a window partitions all NULL-key rows together. The catalogue job relies on
that by accident -- group rows after the rollup have ``material_id`` NULL, so all of them
collapse into one (hazard H8). ``null_key`` makes the choice explicit:

* ``"collapse"`` (default, the catalogue's result): keep the single first NULL-key row; it
  is the same window, in which every task sends at most one NULL-key row;
* ``"keep"``: NULL-key rows pass through untouched;
* ``"drop"``: NULL-key rows are removed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshcat.operators.ordering import total_order
from freshcat.operators.rollup import OUTPUT_COLUMNS

_RN = "__fc_rn"


def first_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[tuple | str],
    ties: Sequence[tuple | str] | None = None,
    null_key: str = "collapse",
    within: Sequence[str] = (),
) -> DataFrame:
    """Keep the first row per ``key`` by ``order`` + ``ties`` (default: all other columns).

    ``within``: keys that split the input into independent runs (site, corner, month);
    NULL-key rows collapse per ``within`` group.
    """
    within = list(within)
    keys = [key] if isinstance(key, str) else list(key)
    exprs = total_order(df, order, ties, exclude=keys + within)
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    first = F.row_number().over(Window.partitionBy(*within, *keys).orderBy(*exprs))
    if null_key == "collapse" and len(keys) == 1:
        # one window over all rows: the NULL rows are a key like another, cut to a row a task
        return df.withColumn(_RN, first).where(F.col(_RN) == 1).drop(_RN)
    keyed = df.where(has_key).withColumn(_RN, first).where(F.col(_RN) == 1).drop(_RN)
    if null_key == "drop":
        return keyed
    nulls = df.where(~has_key)
    if null_key == "collapse":
        one = F.row_number().over(Window.partitionBy(*within, F.lit(0)).orderBy(*exprs))
        nulls = nulls.withColumn(_RN, one).where(F.col(_RN) == 1).drop(_RN)
    elif null_key != "keep":
        raise ValueError("null_key must be 'collapse', 'keep' or 'drop'")
    return keyed.unionByName(nulls)


def filter_duplicate_tieup_item(
    df: DataFrame,
    order_column: str = "score",
    ascending: bool = False,
    key: str = "material_id",
    rank_column: str = "tieup_id",
    ties: Sequence[tuple | str] | None = None,
    null_key: str = "collapse",
    output: Sequence[str] = OUTPUT_COLUMNS,
    within: Sequence[str] = (),
    sort: bool = True,
) -> DataFrame:
    """Catalogue signature: one row per material, lowest ``tieup_id`` first, then the
    15 fact columns sorted by ``order_column`` (ties broken by the other columns).

    ``sort=False`` leaves out the order, for callers that order or partition again."""
    within = list(within)
    first = first_per_key(df, key, [(rank_column, True)], ties=ties, null_key=null_key, within=within)
    first = first.select(*within, *output)
    if not sort:
        return first
    order = [(w, True) for w in within] + [(order_column, ascending)]
    return first.orderBy(*total_order(first, order, ties))
