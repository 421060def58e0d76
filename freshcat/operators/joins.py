"""Left-outer snowflake joins (J1-J16, C1) and the flag-list lookup.

Every join here is an equi LEFT OUTER join, as in the catalogue jobs. Keys of the right
side are renamed to private names before the join and dropped after it, so there is
never a duplicate column name and never a drop-by-lineage (hazard H7: dropping
``right[key]`` after a self-join removes the *left* key).

Physical strategy is left to Catalyst + AQE: a right side that turns out small at run
time is broadcast, a skewed key is split by the skew-join rule, and a selective filter on
the left side can prune the right scan through a runtime bloom filter.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


@dataclass
class Hop:
    """One join of a snowflake: ``left.left_key == right.right_key``.

    ``columns``: right columns to bring, as a list (same names) or a mapping
    ``{right_name: output_name}``; ``None`` brings every non-key column.
    """

    right: DataFrame
    left_key: str | Sequence[str]
    right_key: str | Sequence[str]
    columns: Mapping[str, str] | Sequence[str] | None = None
    how: str = "left"


def _as_list(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def join_hop(left: DataFrame, hop: Hop, tag: str = "0") -> DataFrame:
    left_keys = _as_list(hop.left_key)
    right_keys = _as_list(hop.right_key)
    if len(left_keys) != len(right_keys):
        raise ValueError("left_key and right_key must have the same length")
    if hop.columns is None:
        mapping = {c: c for c in hop.right.columns if c not in right_keys}
    elif isinstance(hop.columns, Mapping):
        mapping = dict(hop.columns)
    else:
        mapping = {c: c for c in hop.columns}
    clash = set(mapping.values()) & set(left.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} already exist on the left side; rename them in the hop")
    tmp = [f"__fc_k{tag}_{i}" for i in range(len(right_keys))]
    right = hop.right.select(
        *[F.col(k).alias(t) for k, t in zip(right_keys, tmp)],
        *[F.col(src).alias(dst) for src, dst in mapping.items()],
    )
    ltypes = {f.name: f.dataType for f in left.schema.fields}
    rtypes = {f.name: f.dataType for f in right.schema.fields}
    pairs = [key_pair(F.col(lk), ltypes[lk], F.col(t), rtypes[t]) for lk, t in zip(left_keys, tmp)]
    cond: Column = reduce(lambda a, b: a & b, [a == b for a, b in pairs])
    return left.join(right, cond, hop.how).drop(*tmp)


def key_pair(left: Column, ltype, right: Column, rtype) -> tuple[Column, Column]:
    """Join keys of a numeric and a text column compare as numbers, with text that is not
    a number matching nothing (hazard H6: the lenient engine did this; ANSI would fail the
    whole job on the first non-numeric id). Other type pairs are left to Spark."""
    if isinstance(ltype, StringType) and isinstance(rtype, NumericType):
        return left.try_cast(rtype), right
    if isinstance(rtype, StringType) and isinstance(ltype, NumericType):
        return left, right.try_cast(ltype)
    return left, right


def snowflake_left_join(base: DataFrame, hops: Sequence[Hop]) -> DataFrame:
    """Apply the hops in order; later hops may use columns brought by earlier ones."""
    out = base
    for i, hop in enumerate(hops):
        out = join_hop(out, hop, tag=str(i))
    return out


def join_dim_material(
    dim_hub_item: DataFrame,
    dim_hub_item_and_artist: DataFrame,
    dim_hub_item_and_ftdt: DataFrame,
    dim_hub_music_and_item: DataFrame,
    dim_hub_item_and_site_contract: DataFrame,
    dim_hub_music: DataFrame,
    dim_hub_artist: DataFrame,
    item_key: str = "id",
    bridge_key: str = "item_id",
    dim_key: str = "id",
) -> DataFrame:
    """Material snowflake (C1): item, four item bridges, then music and artist hops.

    Output: item columns, then every non-key column of each bridge and dimension in join
    order. Bridges are many-to-many, so an item with two artists yields two rows.
    """
    return snowflake_left_join(
        dim_hub_item,
        [
            Hop(dim_hub_item_and_artist, item_key, bridge_key),
            Hop(dim_hub_item_and_ftdt, item_key, bridge_key),
            Hop(dim_hub_music_and_item, item_key, bridge_key),
            Hop(dim_hub_item_and_site_contract, item_key, bridge_key),
            Hop(dim_hub_music, "music_id", dim_key),
            Hop(dim_hub_artist, "artist_id", dim_key),
        ],
    )


def flag_lookup(
    df: DataFrame,
    flags: DataFrame,
    left_key: str,
    right_key: str,
    flag_column: str,
    output: str = "johnnys",
) -> DataFrame:
    """Left-join a flag list and turn it into a 0/1 presence column.

    The list is reduced to distinct ``(key, present)`` pairs first (at most two rows per
    key), so duplicate list entries cannot fan the fact out (H14); a row whose flag
    value is NULL counts as absent, and an unmatched row gets 0 -- the same values a
    ``when(flag IS NULL, 0).otherwise(1)`` after the raw join gives, before ``distinct``.
    """
    tmp = "__fc_flag_key"
    reduced = flags.select(
        F.col(right_key).alias(tmp), F.col(flag_column).isNotNull().cast("int").alias(output)
    ).distinct()
    left, right = key_pair(F.col(left_key), df.schema[left_key].dataType, F.col(tmp), reduced.schema[tmp].dataType)
    joined = df.join(reduced, left == right, "left").drop(tmp)
    return joined.withColumn(output, F.coalesce(F.col(output), F.lit(0)))
