"""Publishing with a commit (S6-S8, C8), its audit (S10, C10) and registration.

A run writes into a folder of its own, ``{root}/_runs/{run}``, and commits by renaming its
manifest into place. The manifest has a JSON line for every partition that the run stands for:
its values, rows, the written file and the name it is to have. Publishing swaps the files in by
the manifest, clears the partitions' other files and keeps the manifest in
``{root}/_manifests``. So

* a run that dies before its commit has published nothing, and nothing of it is ever read;
* a run that dies after its commit is finished by :func:`recover`, which every later run calls
  first; each step of the swap can be repeated;
* a partition without rows is a file with a header, decided by this run's rows and not by what
  lies in its folder;
* the manifests tell how many rows every published partition has, without reading it.

Spark's readers skip both folders (their names begin with ``_``). Loops here run over manifest
lines: corners x months, a number of the configuration and the calendar.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from freshcat.sources.sinks import PARTITION_COLUMNS, partition_dir, write_partitioned_csv

RUNS, MANIFESTS = "_runs", "_manifests"
#: Partitions a statement registers.
REGISTER_BLOCK = 200


class Files:
    """The few file operations that publishing needs, by the path's Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def names(self, folder: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(folder))) if self.exists(folder) else []

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def rename(self, source: str, target: str) -> None:
        self.fs.mkdirs(self.path(target).getParent())
        if not self.fs.rename(self.path(source), self.path(target)):
            raise RuntimeError(f"rename of {source} to {target} failed")

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def full_name(self, name: str) -> str:
        return str(self.fs.makeQualified(self.path(name)).toString())


def write_run(
    df: DataFrame,
    root: str,
    partitions: Sequence[Mapping[str, str]] | None,
    name: Callable[[Mapping[str, str]], str],
    order: Sequence[Column] | None = None,
    partition_columns: Sequence[str] = PARTITION_COLUMNS,
) -> str:
    """Write ``df`` as one run and commit its manifest; returns the run. Nothing is published yet.

    ``partitions``: what the run stands for, with rows or without; ``df`` must have no others
    (None: those that have rows).
    ``name``: a partition's file name. The rows are counted by partition first, and the writer's
    own count (an observed metric of the write) has to agree.
    """
    spark, columns = df.sparkSession, list(partition_columns)
    files = Files(spark, root)
    run = f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:12]}"
    folder = f"{root.rstrip('/')}/{RUNS}/{run}"
    rows = {tuple(r[c] for c in columns): r["count"] for r in df.groupBy(*columns).count().collect()}
    if partitions is None:
        partitions = [dict(zip(columns, values, strict=True)) for values in sorted(rows)]
    strange = set(rows) - {tuple(p[c] for c in columns) for p in partitions}
    if strange:
        raise ValueError(f"rows of partitions that were not asked for: {sorted(strange, key=str)}")
    if rows:
        written = Observation(f"write-{run}")
        write_partitioned_csv(df.observe(written, F.count(F.lit(1)).alias("rows")), f"{folder}/data", partition_columns=columns, order=order, single_file=True)
        if written.get["rows"] != sum(rows.values()):
            raise RuntimeError(f"{written.get['rows']} rows written, {sum(rows.values())} counted")
    header = ",".join(c for c in df.columns if c not in columns) + "\n"
    lines = []
    for p in partitions:
        own = {c: p[c] for c in columns}
        directory, n = partition_dir(f"{folder}/data", own, columns), rows.get(tuple(own.values()), 0)
        if not n:
            files.write(f"{directory}/part-none.csv", header)
        parts = [f for f in files.names(directory) if f.startswith("part-")]
        if len(parts) != 1:
            raise RuntimeError(f"expected one file in {directory}, found {len(parts)}")
        lines.append(json.dumps({"run": run, **own, "rows": n, "file": name(own), "source": parts[0]}))
    files.write(f"{folder}/manifest.tmp", "\n".join(lines) + "\n")
    files.rename(f"{folder}/manifest.tmp", f"{folder}/manifest.json")
    return run


def publish_run(spark: SparkSession, root: str, run: str, partition_columns: Sequence[str] = PARTITION_COLUMNS) -> list[dict]:
    """Swap a committed run's files in. Every step can be repeated, so a second call after a
    death in the middle ends in the same tree. Returns the manifest's lines."""
    files, base = Files(spark, root), root.rstrip("/")
    folder = f"{base}/{RUNS}/{run}"
    lines = [json.loads(x) for x in files.read(f"{folder}/manifest.json").splitlines()]
    for line in lines:
        own = {c: line[c] for c in partition_columns}
        source = f"{partition_dir(f'{folder}/data', own, partition_columns)}/{line['source']}"
        target = f"{partition_dir(base, own, partition_columns)}/{line['file']}"
        if files.exists(source):  # not there: moved before
            if files.exists(target):
                files.delete(target)
            files.rename(source, target)
        directory = partition_dir(base, own, partition_columns)
        for other in files.names(directory):
            if other != line["file"]:
                files.delete(f"{directory}/{other}")
    files.rename(f"{folder}/manifest.json", f"{base}/{MANIFESTS}/{run}.json")
    files.delete(folder)
    return lines


def recover(spark: SparkSession, root: str, partition_columns: Sequence[str] = PARTITION_COLUMNS) -> list[str]:
    """Finish runs that were committed but not published to the end, oldest first; returns them.
    Runs without a manifest are left alone: they may be alive, and are never published."""
    files, base = Files(spark, root), root.rstrip("/")
    done = [r for r in files.names(f"{base}/{RUNS}") if files.exists(f"{base}/{RUNS}/{r}/manifest.json")]
    for run in done:
        publish_run(spark, root, run, partition_columns)
    return done


def published(spark: SparkSession, root: str, partition_columns: Sequence[str] = PARTITION_COLUMNS) -> DataFrame:
    """The newest manifest line of every published partition: its values, rows, file and run."""
    schema = StructType([StructField(c, StringType()) for c in ("run", *partition_columns, "file")] + [StructField("rows", LongType())])
    folder = f"{root.rstrip('/')}/{MANIFESTS}"
    if not Files(spark, root).exists(folder):
        return spark.createDataFrame([], schema)
    lines = spark.read.schema(schema).json(folder)
    newest = F.max_by(F.struct("rows", "file", "run"), F.col("run")).alias("line")
    return lines.groupBy(*partition_columns).agg(newest).select(*partition_columns, "line.rows", "line.file", "line.run")


def add_partitions(spark: SparkSession, table: str, partitions: Iterable[Mapping[str, str]], partition_columns: Sequence[str] = PARTITION_COLUMNS) -> None:
    """Register just these partitions of an external table: the root is not listed."""
    quoted = [", ".join(f"`{c}`='" + str(p[c]).replace("\\", "\\\\").replace("'", "\\'") + "'" for c in partition_columns) for p in partitions]
    for k in range(0, len(quoted), REGISTER_BLOCK):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(f"PARTITION ({q})" for q in quoted[k:k + REGISTER_BLOCK]))


def audit(spark: SparkSession, root: str, partitions: Sequence[Mapping[str, str]], partition_columns: Sequence[str] = PARTITION_COLUMNS) -> DataFrame:
    """What is really there, for every expected partition (S10, C10): its values, ``rows`` read
    back from its files, ``listed`` (the manifest's rows, null: never published), ``files`` and

    ``status``: ``ok``; ``empty``: published without rows; ``missing``: never published, no
    file; ``lost``: published, but no file is there; ``unlisted``: files that no run published;
    ``differs``: other rows than were published.

    Only the expected partitions are read, not the rest of the root.
    """
    columns, files = list(partition_columns), Files(spark, root)
    keys = StructType([StructField(c, StringType()) for c in columns])
    expected = spark.createDataFrame([tuple(p[c] for c in columns) for p in partitions], keys).distinct()
    there = [d for d in dict.fromkeys(partition_dir(root, p, columns) for p in partitions) if files.exists(d)]
    if there:
        reader = lambda kind: spark.read.format(kind).option("basePath", root).option("pathGlobFilter", "*.csv")
        shape = StructType([StructField("first", StringType()), *keys.fields])
        lines = reader("csv").schema(shape).option("header", "true").option("multiLine", "true").load(there)
        count = lines.groupBy(*columns).agg(F.count(F.lit(1)).alias("rows"))
        # of the files just the names are read
        listing = reader("binaryFile").load(there).select(*[F.col(c).cast("string") for c in columns]).groupBy(*columns).agg(F.count(F.lit(1)).alias("files"))
    else:
        count = expected.limit(0).withColumn("rows", F.lit(0).cast("long"))
        listing = expected.limit(0).withColumn("files", F.lit(0).cast("long"))
    listed = published(spark, root, columns).select(*columns, F.col("rows").alias("listed"))
    rows, number = F.coalesce("rows", F.lit(0).cast("long")), F.coalesce("files", F.lit(0).cast("long"))
    status = (
        F.when((number == 0) & F.col("listed").isNull(), "missing").when(number == 0, "lost").when(F.col("listed").isNull(), "unlisted")
        .when(rows != F.col("listed"), "differs").when(rows == 0, "empty").otherwise("ok")
    )
    return expected.join(count, columns, "left").join(listing, columns, "left").join(listed, columns, "left").select(
        *columns, rows.alias("rows"), "listed", number.alias("files"), status.alias("status"))
