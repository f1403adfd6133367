"""Persisted tables and sinks (S9–S17) on shared storage.

Tables are Parquet directories under one lake root (a shared filesystem /
object-store path, never a machine-local folder on a cluster). History is
partitioned by ``snapshot_date`` and rewritten with dynamic partition
overwrite, so a rerun of one night replaces that night only.

Replacing a table writes a new version folder and then switches to it by
creating one empty marker file, which every store does atomically: a failed
write leaves the old version in place, readers of it are not disturbed, and a
table can be replaced from a plan that reads it. The version before the
replaced one is deleted.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class Lake:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _fs(self, path: str):
        sc = self.spark.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(sc._jsc.hadoopConfiguration()), p

    def version(self, name: str) -> int:
        """The current version of a replaced table, 0 when it never was."""
        fs, p = self._fs(f"{self.root}/_current/{name}")
        if not fs.exists(p):
            return 0
        return max((int(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().isdigit()), default=0)

    def _reserve(self, name: str) -> int:
        """A version number that no other writer has: the file that reserves it is created without overwriting."""
        while True:
            fs, p = self._fs(f"{self.root}/_current/{name}")
            taken = [int(f.getPath().getName().split(".")[0]) for f in fs.listStatus(p)] if fs.exists(p) else []
            n = max(taken, default=0) + 1
            try:
                fs.create(self._fs(f"{self.root}/_current/{name}/{n:08d}.reserved")[1], False).close()
                return n
            except Py4JJavaError as e:
                if "Exist" not in e.java_exception.getClass().getName():
                    raise

    def _versions(self, name: str) -> list[int]:
        fs, p = self._fs(f"{self.root}/_current/{name}")
        return sorted(int(f.getPath().getName()) for f in fs.listStatus(p) if f.getPath().getName().isdigit())

    def _versioned(self, name: str, n: int) -> str:
        return f"{self.root}/{name}" if n == 0 else f"{self.root}/{name}-v{n:08d}"

    def path(self, name: str) -> str:
        return self._versioned(name, self.version(name))

    # S9 / S6 -----------------------------------------------------------------
    def exists(self, name: str) -> bool:
        try:
            self.spark.read.parquet(self.path(name)).schema  # noqa: B018 - forces resolution
            return True
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return False

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def read_or_empty(self, name: str, schema: StructType) -> DataFrame:
        """S6 tail: the table, or an empty frame of ``schema``."""
        return self.read(name) if self.exists(name) else self.spark.createDataFrame([], schema)

    # S12 ---------------------------------------------------------------------
    def replace(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """``CREATE OR REPLACE TABLE name AS <df>``, also when ``df`` reads the table it replaces."""
        before, n = self.version(name), self._reserve(name)
        w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self._versioned(name, n))
        fs, marker = self._fs(f"{self.root}/_current/{name}/{n:08d}")
        fs.create(marker, False).close()
        older = [v for v in self._versions(name) if v < before]
        for v in older:
            fs.delete(self._fs(self._versioned(name, v))[1], True)
        return self.read(name)

    # S10 ---------------------------------------------------------------------
    def overwrite_partitions(self, name: str, df: DataFrame, partition_by: Sequence[str]) -> None:
        """Dynamic partition overwrite: only partitions present in ``df`` are
        replaced."""
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(*partition_by).parquet(self.path(name)))

    # S13 ---------------------------------------------------------------------
    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        w = df.write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(name))

    # S14 ---------------------------------------------------------------------
    def ensure(self, name: str, schema: StructType, partition_by: Sequence[str] = ()) -> None:
        """Create-if-absent with a typed (empty) schema."""
        if self.exists(name):
            return
        w = self.spark.createDataFrame([], schema).write.mode("overwrite")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(self.path(name))

    # S15 ---------------------------------------------------------------------
    def register(self, name: str, df: DataFrame | None = None) -> DataFrame:
        d = df if df is not None else self.read(name)
        d.createOrReplaceTempView(name)
        return d

    def unregister(self, name: str) -> None:
        self.spark.catalog.dropTempView(name)

    # S16 ---------------------------------------------------------------------
    def report(self, name: str, row: dict) -> None:
        """Append one JSON run report (counters, metadata) as a one-row table."""
        self.spark.createDataFrame([(json.dumps(row, default=str),)], "doc string") \
            .coalesce(1).write.mode("append").text(self.path(name))

    def report_from(self, name: str, df: DataFrame) -> None:
        """Append a one-row aggregate as JSON (computed by Spark, written by
        the executors — nothing is collected)."""
        df.coalesce(1).write.mode("append").json(self.path(name))

    def read_json(self, name: str) -> DataFrame:
        return self.spark.read.json(self.path(name))

    # S17 ---------------------------------------------------------------------
    def counts(self, names: Sequence[str]) -> DataFrame:
        """Row counts of the named tables; absent tables report NULL."""
        parts = []
        for n in names:
            if self.exists(n):
                parts.append(self.read(n).agg(F.count(F.lit(1)).alias("n"))
                             .select(F.lit(n).alias("table"), "n"))
            else:
                parts.append(self.spark.range(1).select(F.lit(n).alias("table"),
                                                        F.lit(None).cast("long").alias("n")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV sink with a header line."""
    df.write.mode(mode).option("header", "true").option("escape", '"').csv(path)
