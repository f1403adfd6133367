"""Session construction and shared-folder helpers.

Cluster jobs never invent scratch space: lineage cuts and staged writes go
under the folder the cluster names in ``spark.checkpoint.dir``. Only a
``local`` master (unit tests, a laptop) falls back to a fresh
``mktemp``-style folder when that setting is absent; a cluster without it is
an error. Staged folders are removed when the driver's JVM exits.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "estatelake") -> SparkSession:
    """A session tuned for the operators in this package.

    * AQE on: coalesces small shuffles, splits skewed join partitions and
      turns a sort-merge join into a broadcast join when the runtime size of
      one side is under ``autoBroadcastJoinThreshold`` (the size check that
      guards every broadcast here).
    * Session time zone pinned to UTC so dates derived from timestamps are
      stable across machines.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.autoBroadcastJoinThreshold": "32m",
        "spark.sql.files.maxPartitionBytes": "128m",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.driver.memory": "16g",
    }
    if shuffle_partitions:    # otherwise the cluster's own setting stands
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="estatelake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for staged tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable lineage cut (survives executor loss): ``checkpoint`` into the
    shared folder, never ``localCheckpoint``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
