"""Sinks (S6-S10, C5): partitioned CSV output, named export, registration, audit.

Output layout: ``{root}/site=<site>/corner=<corner>/target_date=<YYYYMMDD>/`` with header
CSV files (exactly one, sorted, for the corner-month export). Writes use dynamic partition
overwrite, so rewriting one month
(or one corner) leaves every other partition in place, and a retried task or job simply
rewrites its own partitions (idempotent under executor loss).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

PARTITION_COLUMNS = ("site", "corner", "target_date")


def partition_schema(columns: Sequence[str] = PARTITION_COLUMNS) -> list[StructField]:
    """Partition columns are read back as strings, never inferred (``target_date`` would
    otherwise come back as an int, hazard H18)."""
    return [StructField(c, StringType(), True) for c in columns]


def write_partitioned_csv(
    df: DataFrame,
    root: str,
    partition_values: dict[str, str] | None = None,
    partition_columns: Sequence[str] = PARTITION_COLUMNS,
    order: Sequence[Column] | None = None,
    single_file: bool = False,
    null_value: str | None = None,
    empty_value: str | None = None,
) -> None:
    """Write ``df`` as header CSV under Hive-style partitions.

    ``partition_values`` adds constant partition columns (one corner-month job);
    otherwise ``df`` must already carry them (all corners / all months in one job).
    By default every task writes its own files (no partition passes through one task).
    ``single_file`` gives each partition directory exactly one file, written by one task
    and sorted by ``order`` inside it -- the export format of the corner jobs, whose
    partitions hold one month's new arrivals of one corner; do not use it for table-sized
    partitions.
    """
    out = df
    for name, value in (partition_values or {}).items():
        out = out.withColumn(name, F.lit(value))
    cols = list(partition_columns)
    if single_file:
        out = out.repartition(*[F.col(c) for c in cols])
        if order:
            # by partition first: the writer then has nothing left to sort, and keeps the order
            out = out.sortWithinPartitions(*[F.col(c).asc() for c in cols], *order)
    writer = (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", "true")
        .partitionBy(*cols)
    )
    if null_value is not None:
        writer = writer.option("nullValue", null_value)
    if empty_value is not None:
        writer = writer.option("emptyValue", empty_value)
    writer.csv(root)


def read_partitioned_csv(
    spark: SparkSession,
    root: str,
    data_schema: StructType,
    partition_columns: Sequence[str] = PARTITION_COLUMNS,
    null_value: str | None = None,
    empty_value: str | None = None,
) -> DataFrame:
    """Read the layout back with an explicit schema (data columns + string partitions)."""
    schema = StructType(list(data_schema.fields) + partition_schema(partition_columns))
    reader = spark.read.schema(schema).option("header", "true")
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    if empty_value is not None:
        reader = reader.option("emptyValue", empty_value)
    return reader.csv(root)


#: Fixed set: the characters that partition folders have as %XX.
_ESCAPED = re.compile("[\x01-\x1f\"#%'*/:=?\\\\\x7f{\\[\\]^]")


def escaped(name: str) -> str:
    """A value as it stands in the name of a partition folder."""
    return _ESCAPED.sub(lambda m: f"%{ord(m.group()):02X}", name)


def partition_dir(root: str, values: dict[str, str], partition_columns: Sequence[str] = PARTITION_COLUMNS) -> str:
    return root.rstrip("/") + "/" + "/".join(f"{c}={escaped(values[c])}" for c in partition_columns)


def export_named_file(spark: SparkSession, directory: str, file_name: str, pattern: str = "part-*") -> str:
    """Rename the single data file of ``directory`` to ``file_name``.

    Uses the Hadoop FileSystem of the path (works for HDFS / object stores). Only files
    matching ``pattern`` are considered, so ``_SUCCESS`` and ``.crc`` files never win.
    Returns the new path.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path_cls = jvm.org.apache.hadoop.fs.Path
    dir_path = path_cls(directory)
    fs = dir_path.getFileSystem(conf)
    statuses = fs.globStatus(path_cls(directory.rstrip("/") + "/" + pattern))
    files = sorted(str(s.getPath().toString()) for s in (statuses or []) if s.isFile())
    if len(files) != 1:
        raise RuntimeError(f"expected exactly one {pattern} file in {directory}, found {len(files)}")
    target = path_cls(directory.rstrip("/") + "/" + file_name)
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(path_cls(files[0]), target):
        raise RuntimeError(f"rename of {files[0]} to {target} failed")
    return str(target.toString())


def create_partitioned_table(
    spark: SparkSession,
    table: str,
    root: str,
    data_schema: StructType,
    partition_columns: Sequence[str] = PARTITION_COLUMNS,
) -> None:
    """Declare an external partitioned CSV table over ``root`` (no data is moved)."""
    cols = [f"`{f.name}` {f.dataType.simpleString()}" for f in data_schema.fields]
    cols += [f"`{c}` string" for c in partition_columns]
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(
        f"CREATE TABLE {table} ({', '.join(cols)}) USING csv "
        f"OPTIONS (header 'true') PARTITIONED BY ({', '.join(partition_columns)}) "
        f"LOCATION '{root}'"
    )


def register_partitions(spark: SparkSession, table: str) -> str:
    """Make newly written partition directories visible to the catalog.

    ``MSCK REPAIR TABLE`` runs synchronously in the session, so there is nothing to poll.
    Returns ``"SUCCEEDED"`` to keep the state-returning contract of the original helper.
    """
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return "SUCCEEDED"


def partition_row_counts(
    written: DataFrame,
    expected: DataFrame,
    keys: Sequence[str] = PARTITION_COLUMNS,
    count_column: str = "row_count",
) -> DataFrame:
    """Rows per partition, for every expected partition, zero where nothing was written
    (S10, C10). ``expected`` holds the keys (e.g. corners x calendar days)."""
    counts = written.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_column))
    return expected.join(counts, list(keys), "left").select(
        *keys, F.coalesce(F.col(count_column), F.lit(0).cast("bigint")).alias(count_column)
    )
