"""Session settings the plans in this package rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution does the run-time work: it coalesces small shuffle
# partitions, splits skewed ones and switches joins to broadcast when the
# measured size of a side is below the threshold.  No plan forces a broadcast.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session that already exists."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str | None:
    """Folder all executors can reach, as the cluster names it.

    A temporary folder of this machine stands in for it only in local mode,
    where this machine is the cluster.
    """
    folder = spark.conf.get("spark.checkpoint.dir", "")
    if folder:
        return folder
    if spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="tariffworks-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    return None


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store a result that several later steps read, and go on from what is stored.

    Survives the loss of executors because the data leaves their local disks.  Fails where no
    shared folder is configured: recomputing the chain at each of its steps is no substitute.
    Checkpoints go with the session if spark.cleaner.referenceTracking.cleanCheckpoints is set.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = shared_folder(df.sparkSession)
        if folder is None:
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(folder)
    return df.checkpoint()
