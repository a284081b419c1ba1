"""CSV scan, audited batch load, sample and report export."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assetlake import schemas
from assetlake.operators.profiling import dataset_profile, null_profile, value_ranges
from assetlake.operators.tables import latest_per_key

RAW_FILE_SCHEMA = T.StructType(
    [T.StructField(header, schemas.RAW_EQUIPMENT[column].dataType) for header, column in schemas.RAW_HEADER.items()]
)


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Equipment records with a header line; the schema is given, a malformed line fails the scan."""
    scanned = spark.read.csv(path, header=True, schema=RAW_FILE_SCHEMA, mode="FAILFAST", enforceSchema=False)
    return scanned.select(*[F.col(f"`{header}`").alias(column) for header, column in schemas.RAW_HEADER.items()])


def stored_bytes(spark: SparkSession, path: str) -> int:
    sizes = spark.read.format("binaryFile").load(path).select("length")
    return sizes.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def _audit(spark: SparkSession, audit_path: str, **values) -> None:
    row = {name: values.get(name) for name in schemas.DATA_IMPORTS.fieldNames()}
    frame = spark.createDataFrame([tuple(row.values())], schemas.DATA_IMPORTS)
    now = F.current_timestamp().cast("timestamp_ntz")
    stamp = "started_at" if values["status"] == "in_progress" else "completed_at"
    frame.withColumn(stamp, now).coalesce(1).write.mode("append").parquet(audit_path)


def load_batch(
    spark: SparkSession, path: str, table_path: str, audit_path: str, batch_id: str | None = None, source="csv"
) -> str:
    """Append a file to the raw table under a batch id, with audit rows for start and end; returns the id.

    The batch is one partition of the table and is overwritten on a rerun, so a repeated load cannot double it.
    """
    batch = batch_id or str(uuid.uuid4())
    common = {"run_id": batch, "file_name": path}
    _audit(spark, audit_path, **common, status="in_progress")
    try:
        size = stored_bytes(spark, path)
        rows = read_raw_csv(spark, path).withColumns(
            {
                "timestamp": F.current_timestamp().cast("timestamp_ntz"),
                "source_system": F.lit(source),
                "raw_data": F.to_json(F.struct(*schemas.RAW_HEADER.values())),
                "batch_id": F.lit(batch),
            }
        )
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(table_path)
        )
        # counted from the footers of the written partition: an Observation would make the session
        # unserialisable for MLlib models, whose training summaries hold it
        written = spark.read.parquet(table_path).filter(F.col("batch_id") == batch).count()
        _audit(spark, audit_path, **common, status="completed", file_size=size, records_count=written)
    except Exception as error:
        _audit(spark, audit_path, **common, status="failed", error_message=str(error))
        raise
    return batch


def import_status(spark: SparkSession, audit_path: str) -> DataFrame:
    """Current state per run: its start and its last audit row."""
    rows = spark.read.schema(schemas.DATA_IMPORTS).parquet(audit_path)
    started = rows.groupBy("run_id").agg(F.min("started_at").alias("started_at"))
    last = latest_per_key(rows.drop("started_at").withColumn("_end", F.col("status") != "in_progress"), ["run_id"], ["_end", "completed_at"])
    return last.drop("_end").join(started, "run_id")


def write_sample(df: DataFrame, order_by: Sequence[str], path: str, rows: int = 100) -> None:
    """First rows under an explicit order as one CSV file."""
    df.orderBy(*order_by).limit(rows).coalesce(1).write.mode("overwrite").csv(path, header=True)


def write_prepared(train: DataFrame, test: DataFrame, base: str) -> None:
    for name, frame in (("train", train), ("test", test)):
        frame.write.mode("overwrite").parquet(f"{base}/{name}")
        frame.write.mode("overwrite").csv(f"{base}/{name}_csv", header=True)


def quality_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: the dataset profile with missing counts and value ranges as nested lists (one entry per column)."""
    nulls = null_profile(df, columns).agg(F.sort_array(F.collect_list(F.struct("column_name", "null_count"))))
    ranges = value_ranges(df, columns).agg(F.sort_array(F.collect_list(F.struct("column_name", "min", "max"))))
    return dataset_profile(df).withColumns({"missing": nulls.scalar(), "value_ranges": ranges.scalar()})


def write_report(report: DataFrame, path: str) -> None:
    report.coalesce(1).write.mode("overwrite").json(path)
