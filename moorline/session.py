"""SparkSession construction and cluster-safe scratch locations.

On a cluster the session is created by the platform: we only read
``spark.checkpoint.dir`` from it and refuse to run without one, because
executors cannot see a folder of the driver's machine.  On a local master a
temporary folder stands in when the setting is absent (tests, local runs); it
is removed when the process ends.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession

# Settings that every job wants regardless of scale.  Partition counts are
# left to AQE: it coalesces small shuffles and splits skewed join partitions
# at runtime, so the same code runs on local[8] and on 1000 executors.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    # Checkpointed rollups are per run; let the context cleaner delete their
    # files once the DataFrames are no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "moorline",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder, with its scheme.  Unset, it is a temporary
    folder on a local master and an error anywhere else."""
    context = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not current:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        current = tempfile.mkdtemp(prefix="moorline-ckpt-")
        atexit.register(shutil.rmtree, current, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", current)
    if not context.getCheckpointDir():
        context.setCheckpointDir(current)
    return current


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"


def materialize(df):
    """Cut lineage: reliable checkpoint into the shared checkpoint folder
    (survives executor loss; never a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
