"""Balanced contiguous shards from global byte prefix sums (DataFrame operations only).

Rows are put in order of (id, checksum, size) by a range partitioning, every partition's
total is added up, a prefix sum over those few totals gives each partition its start, and a
running sum inside the partition gives each row the bytes before it in the whole table.
Cutting those at equal targets gives contiguous shards of near-equal size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshcat.llm.common import stage, unstage


def shard_by_bytes(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot), a row for each row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 1 (a null text has none), so it is never zero.
    A row goes to the shard that the middle of its byte range falls into: shards are
    contiguous in the order, each within one document of total / shards. ``slot`` counts
    from 0 without gaps inside a shard.

    Null ids come first in the order; repeated ids are ordered by checksum and size, and rows
    equal in all three are interchangeable (a scan-position column spreads them, so that a
    group of equal rows of any size is split over partitions). An empty table gives no rows.
    """
    binary = F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(binary) + F.lit(1)).cast("long").alias("size"),
        F.crc32(binary).alias("text_crc32"),
        F.monotonically_increasing_id().alias("seen"),
    )
    order = ["doc_id", "text_crc32", "size", "seen"]
    # the partition a row fell into is written down with it: later steps never depend on a
    # second sampling giving the same splitters
    ranged = stage(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "shard-ranged")

    # one row for each partition: a bounded single-partition window and a bounded broadcast
    totals = ranged.groupBy("part").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    starts = totals.select(
        "part",
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
        F.sum("bytes").over(every).alias("total"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (
        ranged.withColumn("upto", F.sum("size").over(upto))
        .withColumn("place", F.row_number().over(inside).cast("long"))
        .join(F.broadcast(starts), "part")
        .select(
            "doc_id", "size", "text_crc32",
            F.least(
                F.lit(shards - 1),
                F.expr(f"((2 * (bytes_before + upto) - size) * {int(shards)}) div (2 * total)"),
            ).cast("int").alias("shard"),
            (F.col("rows_before") + F.col("place") - 1).alias("rank"),
        )
    )
    placed = stage(placed, "shard-placed")
    unstage(ranged)
    first = placed.groupBy("shard").agg(F.min("rank").alias("first"))  # a row for each shard
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot")
    )
