"""JDBC scans and writes. The database and its driver jar are the caller's; nothing is started here."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_options(
    url: str,
    query: str,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 16,
    fetch_size: int = 10000,
    **extra: str,
) -> dict[str, str]:
    """Options of a query scan; with a numeric partition column the scan is split into parallel ranges."""
    options = {"url": url, "fetchsize": str(fetch_size), **extra}
    if partition_column is None:
        return {**options, "query": query}
    if bounds is None:
        raise ValueError("a partitioned scan needs the bounds of its partition column")
    return {
        **options,
        "dbtable": f"({query}) q",
        "partitionColumn": partition_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }


def read_query(spark: SparkSession, **arguments) -> DataFrame:
    return spark.read.format("jdbc").options(**scan_options(**arguments)).load()


def replace_table(df: DataFrame, url: str, table: str, partitions: int = 16, **extra: str) -> None:
    """Replace the rows of a table; at most ``partitions`` connections write."""
    writer = df.coalesce(partitions).write.format("jdbc").mode("overwrite")
    writer.options(url=url, dbtable=table, truncate="true", batchsize="10000", **extra).save()
