"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

#: Runtime SQL settings the operators rely on. UTC fixes what a text date with an
#: offset truncates to; the skew settings let AQE split what no operator salted. Timestamps are
#: written in the form that has Parquet statistics, so scans by time skip row groups. Rows that are kept
#: may leave their shuffle in fewer partitions than it began with, like those of any other plan. On disk,
#: the shuffle files of a finished query go at once instead of with the driver's next garbage collection, and a
#: task that writes into a few partition folders keeps a file open in each instead of sorting its rows by folder.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}
#: Set only where the session leaves them open. Many small shuffle partitions, which the adaptive
#: planner joins up to the advisory size, serve small and large inputs alike; a local session
#: has no use for them.
CLUSTER_CONF = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SQL_CONF.items():
        spark.conf.set(key, value)
    if not _single_process(spark):
        given = {k for k, _ in spark.sparkContext.getConf().getAll()}
        for key, value in CLUSTER_CONF.items():
            if key not in given and spark.conf.get("spark.sql.shuffle.partitions") == "200":
                spark.conf.set(key, value)
    return spark


def _single_process(spark: SparkSession) -> bool:
    return re.match(r"local(\[|$)", spark.sparkContext.master) is not None


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without
    that setting may use a folder of the machine it runs on.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not _single_process(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    local = tempfile.mkdtemp(prefix="fieldtrail-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, never used before."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
