"""Tables written once in the folder all executors share, so that later steps do not replay earlier ones."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlake.session import checkpoint_dir


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # shuffle files go when the write is done


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the folder named by ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet to the shared folder and read it back; the write's shuffle files are deleted."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    schema = df.schema
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))
