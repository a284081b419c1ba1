"""Parquet tables that are replaced whole: every version has its own folder, a small log names the current one."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG_SCHEMA = "version int, folder string, rows long, published_at timestamp"


class VersionedTable:
    """One writer at a time; readers always see a complete version, and a failed write leaves no trace in the log."""

    def __init__(self, spark: SparkSession, path: str, partition_by: tuple[str, ...] = ()):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), partition_by

    def log(self) -> DataFrame:
        """Published versions; an absent log reads as empty."""
        try:
            return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.path}/_log")
        except Exception as error:  # the path does not exist before the first publish
            if "PATH_NOT_FOUND" not in str(error):
                raise
            return self.spark.createDataFrame([], LOG_SCHEMA)

    def current(self) -> tuple[int, str] | None:
        newest = self.log().agg(F.max(F.struct("version", "folder")).alias("v")).first()["v"]
        return None if newest is None else (newest["version"], newest["folder"])

    def read(self, version: int | None = None) -> DataFrame | None:
        if version is None:
            found = self.current()
            folder = None if found is None else found[1]
        else:
            row = self.log().filter(F.col("version") == version).select("folder").first()
            folder = None if row is None else row["folder"]
        return None if folder is None else self.spark.read.parquet(f"{self.path}/{folder}")

    def publish(self, df: DataFrame) -> int:
        """Write a new version and make it current. The frame may read the version it replaces."""
        found = self.current()
        version = 1 if found is None else found[0] + 1
        folder = f"v{version:08d}-{uuid.uuid4().hex[:8]}"
        writer = df.write.mode("errorifexists")
        if self.partition_by:
            writer = writer.partitionBy(*self.partition_by)
        writer.parquet(f"{self.path}/{folder}")
        rows = self.spark.read.parquet(f"{self.path}/{folder}").count()
        entry = self.spark.createDataFrame([(version, folder, rows)], "version int, folder string, rows long")
        entry.withColumn("published_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(
            f"{self.path}/_log"
        )
        return version
