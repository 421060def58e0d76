"""Spark session settings shared by jobs, tests and the benchmark.

The settings that matter for correctness are pinned here:

* ``spark.sql.session.timeZone=UTC`` -- catalogue timestamps are stored in UTC and the
  epoch of a shifted wall clock depends on the session zone (hazard H4).
* ANSI mode stays ON (the Spark 4 default); the operators are written so that they do
  not depend on the lenient 2.4 behaviour (H1, H3, H5, H6).

The settings that matter for scale are AQE (runtime re-planning: broadcast of sides that
turn out small, skew-join splitting, partition coalescing) and the shuffle width.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Dynamic overwrite: rewriting one month must not delete the others.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable part of :data:`SESSION_CONF` to a live session."""
    for key, value in SESSION_CONF.items():
        if key.startswith("spark.ui."):
            continue
        spark.conf.set(key, value)
    return spark


def get_session(
    app: str = "freshcat",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the pinned settings.

    ``master`` is only set when given, so on a cluster the submit command decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_conf(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be on shared storage and is set by the cluster. Only when
    it is unset (local tests) a private scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            # a machine-local folder is not visible to the executors of a cluster
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for cluster runs")
        configured = tempfile.mkdtemp(prefix="freshcat-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and read it back.

    Used where one intermediate feeds several branches whose pushed-down filters differ
    (so Spark cannot reuse a common exchange and would recompute the whole subtree per
    branch). The written table also cuts the lineage: a lost executor re-reads files
    instead of re-running the scans and joins above it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path)  # no job to infer what is known


_STAGED: list[str] = []


def staged_mark() -> int:
    """A mark to pass to :func:`drop_staged_since` once the staged frames are consumed."""
    return len(_STAGED)


def drop_staged_since(spark: SparkSession, mark: int) -> int:
    """Delete the intermediates staged after ``mark`` (call only after the action that
    read them has finished). Returns how many folders were removed."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    while len(_STAGED) > mark:
        path = jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        if path.getFileSystem(conf).delete(path, True):
            removed += 1
    return removed
