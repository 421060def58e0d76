"""Semi-join reduction of a large table by a filter of fixed size.

A left join of a small side with a large one shuffles the large one whole, though most of its
rows match nothing. :func:`maybe_in` leaves out, in the large table's scan stage, rows whose key
cannot be among the small side's keys; the join that follows is exact.

The keys are hashed to one bit each in a table of at most :data:`SLOTS` rows of 64 bits, built by
a partial + final ``bit_or`` and broadcast: its bound does not depend on the data, so the plan is
the same at every size. With more keys than bits it lets more rows through and is still right.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, IntegralType, NumericType, StringType

from freshcat.operators.joins import key_pair

#: Rows of a filter at most (12 bytes each in the broadcast, 2^26 bits in all).
SLOTS = 1 << 20


def _same_type(left: DataType, right: DataType) -> DataType | None:
    """The type in which a join compares keys of these types, where equal keys have equal hashes."""
    if isinstance(left, StringType) and isinstance(right, NumericType):
        left = right
    elif isinstance(right, StringType) and isinstance(left, NumericType):
        right = left
    if isinstance(left, (FloatType, DoubleType)) or isinstance(right, (FloatType, DoubleType)):
        return None
    return left if left == right or (isinstance(left, IntegralType) and isinstance(right, IntegralType)) else None


def _places(key: Column) -> tuple[Column, Column]:
    h = F.xxhash64(key)
    return F.pmod(h, F.lit(SLOTS)), F.shiftrightunsigned(h, 40).bitwiseAND(F.lit(63)).cast("int")


def maybe_in(df: DataFrame, key: str, keys: DataFrame, keys_column: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` may be one of ``keys`` (never fewer than those that are).

    Keys compare as :func:`freshcat.operators.joins.join_hop` compares them; null keys match
    nothing and go. ``df`` is not shuffled. Fractional and unlike key types: ``df`` as it is.
    """
    ltype, rtype = df.schema[key].dataType, keys.schema[keys_column].dataType
    if _same_type(ltype, rtype) is None:
        return df
    left, right = key_pair(F.col(key), ltype, F.col(keys_column), rtype)
    if isinstance(_same_type(ltype, rtype), IntegralType):
        left, right = left.cast("bigint"), right.cast("bigint")
    slot, bit = _places(F.col("__fc_key"))
    bits = (
        keys.select(right.alias("__fc_key")).where(F.col("__fc_key").isNotNull())
        .select(slot.alias("__fc_slot"), bit.alias("__fc_bit"))
        .groupBy("__fc_slot").agg(F.expr("bit_or(shiftleft(1L, __fc_bit))").alias("__fc_mask"))
    )
    slot, bit = _places(left)
    return (
        df.where(left.isNotNull()).withColumn("__fc_at", slot)
        .join(F.broadcast(bits), F.col("__fc_at") == F.col("__fc_slot"))
        .withColumn("__fc_bit", bit)
        .where(F.expr("(shiftrightunsigned(__fc_mask, __fc_bit) & 1) = 1"))
        .drop("__fc_at", "__fc_slot", "__fc_bit", "__fc_mask")
    )
