"""Identifiers, formatting, JSON and time text."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from assetlake.functions.numeric import _col

# Readable labels of the equipment type codes.
TYPE_LABELS = {"L": "Low Quality", "M": "Medium Quality", "H": "High Quality"}


def format_probability(p) -> Column:
    """'N/A', '<0.1%', '>99.9%' or the percentage with one decimal."""
    p = _col(p).cast("double")
    return (
        F.when(p.isNull(), F.lit("N/A"))
        .when(p < 0.001, F.lit("<0.1%"))
        .when(p > 0.999, F.lit(">99.9%"))
        .otherwise(F.concat((p * 100).cast("decimal(20,10)").cast("decimal(10,1)").cast("string"), F.lit("%")))
    )


def format_equipment_type(code) -> Column:
    code = _col(code)
    label = F.lit("Unknown")
    for key, text in TYPE_LABELS.items():
        label = F.when(code == key, F.lit(text)).otherwise(label)
    return label


def surrogate_key(*columns) -> Column:
    return F.md5(F.concat(*[_col(c).cast("string") for c in columns]))


def json_text(document, member: str) -> Column:
    return F.get_json_object(_col(document), f"$.{member}")


def json_object(*columns) -> Column:
    """JSON object that keeps NULL members."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def parse_iso(text) -> Column:
    """ISO-8601 text with or without a zone to a timestamp; unreadable text gives NULL."""
    return _col(text).try_cast("timestamp")


def date_range_array(as_of, days: int = 30) -> Column:
    end = _col(as_of).cast("date")
    return F.array(F.date_sub(end, days), end)


def random_id(prefix: str = "") -> Column:
    return F.concat(F.lit(prefix), F.uuid())


def batch_item_id(batch, position) -> Column:
    return F.concat(_col(batch).cast("string"), F.lit("_item_"), _col(position).cast("string"))


def clean_column_name(name: str) -> str:
    """Brackets and blanks become underscores; runs are collapsed and ends trimmed."""
    return re.sub(r"_+", "_", re.sub(r"[\[\]()<>\s]+", "_", name)).strip("_")


def clean_column_names(df):
    cleaned = [clean_column_name(c) for c in df.columns]
    if len(set(cleaned)) != len(cleaned):
        raise ValueError(f"column names collide after cleaning: {cleaned}")
    return df.toDF(*cleaned)


def register_sql_functions(spark: SparkSession) -> None:
    """Make the two formatting functions callable from SQL text."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION format_probability(p DOUBLE) RETURNS STRING RETURN "
        "CASE WHEN p IS NULL THEN 'N/A' WHEN p < 0.001 THEN '<0.1%' WHEN p > 0.999 THEN '>99.9%' "
        "ELSE concat(CAST(CAST(CAST(p * 100 AS DECIMAL(20,10)) AS DECIMAL(10,1)) AS STRING), '%') END"
    )
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TYPE_LABELS.items())
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION format_equipment_type(code STRING) RETURNS STRING RETURN "
        f"CASE code {cases} ELSE 'Unknown' END"
    )
