"""Top-k, HAVING-count and a distributed global row number."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshcat.operators.ordering import total_order
from freshcat.session import stage


def top_k(df: DataFrame, order: Sequence[tuple | str], k: int, ties: Sequence[tuple | str] | None = None) -> DataFrame:
    """First ``k`` rows in a total order (F8, O4): ``TakeOrderedAndProject``, i.e. a partial
    top-k in every task and one merge; a large ``k`` is cut by rank and range-sorted instead
    (:func:`first_rows`). ``k`` falsy = all."""
    exprs = total_order(df, order, ties)
    if k and k > MERGED_ROWS:
        return first_rows(df, order, k, ties).orderBy(*exprs)
    return df.orderBy(*exprs).limit(k) if k else df.orderBy(*exprs)


def having_count(df: DataFrame, key: str, threshold: int, count_column: str = "row_count") -> DataFrame:
    """Groups of ``key`` with ``count(key) >= threshold``.

    ``count(key)`` skips NULL, so the NULL group counts 0 and never reaches a threshold of
    1 or more. Partial + final hash aggregate: a hot key is pre-counted in every task.
    """
    return (
        df.groupBy(key)
        .agg(F.count(F.col(key)).alias(count_column))
        .where(F.col(count_column) >= F.lit(threshold))
    )


def global_row_number(
    df: DataFrame,
    order: Sequence[tuple | str],
    ties: Sequence[tuple | str] | None = None,
    output: str = "rank",
    partitions: int | None = None,
    within: Sequence[str] = (),
) -> DataFrame:
    """``row_number() over ([partition by within] order by ...)``, a BIGINT, without pulling
    every row (or every row of a ``within`` group) into one task (W1).

    1. range-partition by ``within`` and the total order, sort inside the partitions, and write
       that down with ``monotonically_increasing_id``, which Spark defines as the partition's
       number (bits 33 and up) and the row's place in it (the lower 33): the only shuffle of rows;
    2. count the written rows per partition (and group): one row each, at most groups +
       partitions rows; a running sum over them gives each partition its start in the group;
    3. rank = start + place - the group's first place in the partition.
    """
    within = list(within)
    exprs = total_order(df, order, ties, exclude=within)
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(w).asc() for w in within]
    ordered = df.repartitionByRange(n, *keys, *exprs).sortWithinPartitions(*keys, *exprs)
    ranged = stage(ordered.withColumn("__fc_at", F.monotonically_increasing_id()), "ranged")
    part = F.shiftrightunsigned("__fc_at", 33)
    counts = ranged.groupBy(part.alias("__fc_p"), *within).agg(F.count(F.lit(1)).alias("__fc_cnt"), F.min("__fc_at").alias("__fc_first"))
    running = Window.partitionBy(*within).orderBy("__fc_p").rowsBetween(Window.unboundedPreceding, -1)
    tmp = [f"__fc_w{i}" for i in range(len(within))]
    starts = counts.select(
        "__fc_p", "__fc_first", *[F.col(w).alias(t) for w, t in zip(within, tmp)],
        F.coalesce(F.sum("__fc_cnt").over(running), F.lit(0)).alias("__fc_off"),
    )
    same = part == F.col("__fc_p")
    for w, t in zip(within, tmp):
        same = same & F.col(w).eqNullSafe(F.col(t))
    return (
        ranged.join(starts if within else F.broadcast(starts), same)
        .withColumn(output, (F.col("__fc_off") + F.col("__fc_at") - F.col("__fc_first") + 1).cast("bigint"))
        .drop("__fc_at", "__fc_p", "__fc_first", "__fc_off", *tmp)
    )


#: Up to so many rows a group, tasks x k rows may meet in one task (as Spark's own top-k and
#: limited windows do); more are cut by their rank in a range-partitioned table.
MERGED_ROWS = 1000


def first_rows(df: DataFrame, order: Sequence[tuple | str], k: int, ties: Sequence[tuple | str] | None = None,
               within: Sequence[str] = ()) -> DataFrame:
    """The first ``k`` rows by a total order, of the table or of every ``within`` group (F8),
    in no order. Any ``k`` gives the same rows as a full ranking would."""
    if k > MERGED_ROWS:
        ranked = global_row_number(df, order, ties, output="__fc_rank", within=within)
        return ranked.where(F.col("__fc_rank") <= k).drop("__fc_rank")
    exprs = total_order(df, order, ties, exclude=list(within))
    if not within:
        return df.orderBy(*exprs).limit(k)
    rank = F.row_number().over(Window.partitionBy(*within).orderBy(*exprs))
    return df.withColumn("__fc_rank", rank).where(F.col("__fc_rank") <= k).drop("__fc_rank")
