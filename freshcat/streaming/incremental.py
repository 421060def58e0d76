"""Incremental publishing: re-run the monthly job for the months new item files touch.

The catalogue jobs are batch jobs over a versioned catalogue. When item rows arrive as
new files, only the local months they start in need to be published again. This runner
watches the item files with Structured Streaming (file source, ``availableNow`` trigger:
process what is there, then stop) and, per micro-batch, hands the touched months, as ranges, to
a publish callback -- typically a :func:`freshcat.plans.monthly_job.backfill_job` written
with dynamic partition overwrite, so a replayed batch rewrites the same partitions.

The stream's checkpoint (under the shared ``spark.checkpoint.dir`` unless given) records
which files were processed, so a restarted runner resumes after the last committed batch.
The month list of a batch is a distinct over the batch (bounded by the calendar, not by
the data); the heavy work stays in the Spark job the callback starts.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from freshcat.functions.timezone import JST, to_local_wall_clock
from freshcat.operators.backfill import runs_of
from freshcat.plans.monthly_job import months_between
from freshcat.session import checkpoint_dir


def touched_months(batch: DataFrame, ts_column: str, tz: str = JST) -> list[str]:
    """Local months (``YYYY-MM``) the rows of ``batch`` start in, oldest first."""
    months = batch.select(F.date_format(to_local_wall_clock(ts_column, tz), "yyyy-MM").alias("m")).where(
        F.col("m").isNotNull()
    ).distinct()
    return sorted(r.m for r in months.collect())


def run_incremental(
    spark: SparkSession,
    source_dir: str,
    schema: StructType,
    ts_column: str,
    publish: Callable[[str, str], None],
    checkpoint: str | None = None,
    tz: str = JST,
    max_files_per_trigger: int | None = None,
) -> list[tuple[int, str, str]]:
    """Process every item file not seen yet; call ``publish(oldest, newest)`` for each run of
    neighbouring months that a batch touched (months between that it did not touch are left alone).

    Returns ``(batch_id, oldest, newest)`` of each call.
    """
    location = checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/incremental-{uuid.uuid4().hex}"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    items = reader.parquet(source_dir)
    done: list[tuple[int, str, str]] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        months = touched_months(batch, ts_column, tz)
        if months:
            span = months_between(months[0], months[-1])[::-1]
            for oldest, newest in sorted(runs_of(span, {batch_id: months})):
                publish(oldest, newest)
                done.append((batch_id, oldest, newest))

    query = (
        items.writeStream.foreachBatch(handle)
        .option("checkpointLocation", location)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return done
