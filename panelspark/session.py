"""SparkSession construction with the settings the operators assume."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. ANSI mode stays on: operators use try_divide / try_cast.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins keyed by (ticker, Date) may reuse an existing hash partitioning on ticker
    # (the panel is already partitioned by ticker for the window stack), so only the
    # small side moves.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
    # Model plans carry many aliased feature expressions (impute, scale, per-column swaps);
    # inferring constraints through them grows combinatorially. Results do not depend on it.
    "spark.sql.constraintPropagation.enabled": "false",
    # Checkpoint files of a finished job are removed once their DataFrame is garbage.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "panelspark", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster, pass ``master=None`` and let spark-submit decide; ``shuffle_partitions``
    should be sized so one partition of the widest stage fits executor memory.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    if master and master.startswith("local"):
        # Local mode runs everything in the driver JVM; the 1g default is too small.
        builder = builder.config("spark.driver.memory", os.environ.get("PANELSPARK_DRIVER_MEMORY", "8g"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The setting names a folder that driver and executors share, and is used as is. Where it is
    unset, a scratch folder is made in local mode only (tests, bench): on a cluster a
    machine-local folder would lose the data, so that raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder shared by driver and executors")
        path = tempfile.mkdtemp(prefix="panelspark-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under this application's folder inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/panelspark-{spark.sparkContext.applicationId}/{name}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch table through the file system that holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def clean_scratch(spark: SparkSession) -> None:
    """Delete every scratch table of this application. Call it once no returned DataFrame is
    needed any more: lazy results may still read their tables."""
    delete_path(spark, scratch_path(spark, ""))


def wide_plan_settings(spark: SparkSession) -> None:
    """Apply the settings wide model plans need to a session this package did not create."""
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")


def materialize(df):
    """Write ``df`` once as a Parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``, but computes the plan once (an eager
    ``checkpoint()`` of an unpersisted plan computes it twice: once for the count, once for the
    write) and the re-read gets column pruning and predicate pushdown."""
    import uuid
    path = scratch_path(df.sparkSession, f"table-{uuid.uuid4().hex[:16]}")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
