"""Album rollup (C3): many track rows of one large group become one group row.

Semantics (same result as a global ``row_number`` + group count + per-group
``row_number`` + survivor filter):

1. rank all rows by ``order`` (+ ``ties``); with ``top_k`` keep the first ``top_k`` rows;
2. a group is *large* when ``count(group) >= threshold`` among the kept rows (NULL groups
   count 0 and are never large; the count is of rows, so fan-out raises it, H10);
3. each large group keeps only its best-ranked row, turned into a group row: id, name,
   artist and date swapped to the group's values, track-level columns blanked, kind set
   to ``album`` and score reset to 0; other rows pass through as ``music`` rows;
4. rows come out in rank order (a group row at the rank of its best row).

Plan, chosen for scale: one pass, one exchange on the group key, no join.

* no global ``row_number`` (it moves every row into one task): the top-k cut is a partial
  top-k with a merge, or by rank for a large k (:func:`first_rows`), and the final order
  is a distributed range sort;
* of a group only its first ``threshold`` rows matter: if there are so many the group is large
  and its first row stands for it, otherwise they are the whole group. ``row_number() <=
  threshold`` is planned as a partial ``WindowGroupLimit`` before the shuffle, so a group that
  holds a third of all rows sends ``threshold`` rows a task;
* how many are left is a second window with the same keys, which needs no further exchange;
* the final sort moves each row once, as it came, with a flag for group rows; the output columns
  are made from it behind the sort;
* NULL-group rows (never large) get a key of their own each, so that they spread over the
  tasks instead of meeting in one.

``group_column`` is used for the count *and* the window (H11).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from freshcat.operators.ordering import total_order_items
from freshcat.operators.ranking import first_rows

# The fact columns of the catalogue job and how a group row is built.
OUTPUT_COLUMNS = (
    "pickup",
    "music_id",
    "music_name",
    "material_id",
    "material_name",
    "artist_id",
    "artist_name",
    "release_date",
    "pattern_id",
    "tieup_detail_genre_id",
    "tieup_name",
    "tieup_id",
    "johnnys",
    "transition_type",
    "score",
)
ALBUM_VALUES = {
    "music_id": "album_music_id",
    "music_name": "album_music_name",
    "artist_id": "album_artist_id",
    "artist_name": "album_artist_name",
    "release_date": "album_release_date",
}
BLANK_ON_ALBUM = (
    "material_id",
    "material_name",
    "pattern_id",
    "tieup_detail_genre_id",
    "tieup_name",
    "tieup_id",
    "johnnys",
)
ZERO_ON_ALBUM = ("score",)
KIND_COLUMN = "transition_type"
KINDS = ("album", "music")

_ALONE = "__fc_alone"
_RN = "__fc_rn"
_KEPT = "__fc_kept"
_LARGE = "__fc_large"


def rollup_groups(
    df: DataFrame,
    group_column: str,
    order: Sequence[tuple | str],
    threshold: int,
    top_k: int | None = None,
    ties: Sequence[tuple | str] | None = None,
    output: Sequence[str] = OUTPUT_COLUMNS,
    group_values: Mapping[str, str] = ALBUM_VALUES,
    blank: Sequence[str] = BLANK_ON_ALBUM,
    zero: Sequence[str] = ZERO_ON_ALBUM,
    kind_column: str = KIND_COLUMN,
    kinds: tuple[str, str] = KINDS,
    within: Sequence[str] = (),
    sort: bool = True,
) -> DataFrame:
    """Roll rows of large groups up into one group row; see the module docstring.

    ``sort=False`` leaves out the final order for callers that rank or group again. (A range
    sort looks at its input twice; what runs twice here is the windows over the rows that were
    shuffled once, not what is below that exchange.)

    ``order``: ``[(column, ascending), ...]``; ``ties`` completes it to a total order
    (default: every other column ascending), which fixes the surviving row (H9).

    ``within``: extra keys (e.g. site, corner, month) that split the input into
    independent rollups run in one job; they prefix every count, window and top-k and
    are kept in the output.
    """
    within = list(within)
    items = total_order_items(df, order, ties, exclude=within)

    def by(names, directions):
        return [F.col(n).asc() if asc else F.col(n).desc() for n, asc in zip(names, directions)]

    directions = [asc for _, asc in items]
    base_order = by([n for n, _ in items], directions)
    base = first_rows(df, order, top_k, ties, within) if top_k else df

    types = {f.name: f.dataType for f in df.schema.fields}
    album_kind, music_kind = kinds
    # A swapped pair with one string side (e.g. an int release date and a text album
    # date) is returned as string, the type the lenient coercion gave; under ANSI the
    # union would otherwise try to turn the text into a number and fail.
    as_text = {
        name
        for name, src in group_values.items()
        if name in types
        and types[name] != types[src]
        and (isinstance(types[name], StringType) or isinstance(types[src], StringType))
    }

    def item_row(name: str):
        if name == kind_column:
            return F.lit(music_kind)
        if name in as_text:
            return F.col(name).cast("string")
        return F.col(name)

    def group_row(name: str):
        if name == kind_column:
            return F.lit(album_kind)
        if name in group_values:
            col = F.col(group_values[name])
            return col.cast("string") if name in as_text else col
        if name in blank:
            return F.lit(None).cast(types[name])
        if name in zero:
            return F.lit(0).cast(types[name])
        return F.col(name)

    keys = [*[F.col(w) for w in within], F.col(group_column), F.col(_ALONE)]
    grouped = F.col(group_column).isNotNull()
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*base_order))
    headed = (
        base.withColumn(_ALONE, F.when(~grouped, F.monotonically_increasing_id()))
        .withColumn(_RN, first)
        .where(F.col(_RN) <= max(threshold, 1))
        .withColumn(_KEPT, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    )
    large = grouped & (F.col(_KEPT) >= threshold)
    # a row crosses the final exchange once, as it came; what it turns into is made behind the sort
    carried = list(dict.fromkeys([n for n in (*(n for n, _ in items), *output, *group_values.values()) if n in types and n not in within]))
    rolled = headed.where(~large | (F.col(_RN) == 1)).select(*within, *carried, large.alias(_LARGE))
    if sort:
        rolled = rolled.orderBy(*[F.col(w).asc() for w in within], *base_order)
    return rolled.select(
        *within,
        *[F.when(F.col(_LARGE), group_row(c)).otherwise(item_row(c)).alias(c) for c in output],
    )


def aggregate_musics_to_album(
    df: DataFrame,
    top_k: int | None = None,
    threshold_num: int = 5,
    order_column: str = "score",
    ascending: bool = False,
    group_column: str = "album_music_id",
    ties: Sequence[tuple | str] | None = None,
    within: Sequence[str] = (),
    sort: bool = True,
) -> DataFrame:
    """Catalogue signature of :func:`rollup_groups` (15 output columns, C3)."""
    return rollup_groups(
        df,
        group_column=group_column,
        order=[(order_column, ascending)],
        threshold=threshold_num,
        top_k=top_k,
        ties=ties,
        within=within,
        sort=sort,
    )
