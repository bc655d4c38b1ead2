"""Writers, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from lodestat.session import shared_folder
from lodestat.sources import xlsx


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_folder(spark)}/lodestat-{label}-{uuid.uuid4().hex}"


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> str:
    writer = df.write.mode("errorifexists")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",", date_format: str | None = None) -> str:
    writer = df.write.mode("errorifexists").option("header", header).option("sep", sep)
    if date_format:
        writer = writer.option("dateFormat", date_format)
    writer.csv(path)
    return path


def write_ndjson(df: DataFrame, path: str) -> str:
    df.write.mode("errorifexists").json(path)
    return path


def write_xlsx(df: DataFrame, path: str, header: bool = True) -> str:
    """A folder of workbooks, one a task."""
    xlsx.register(df.sparkSession)
    df.write.format("xlsx").mode("append").option("header", header).save(path)
    return path


def write_splits(df: DataFrame, path: str, split: str = "split") -> str:
    """One folder of CSV files per split value."""
    df.write.mode("errorifexists").partitionBy(split).option("header", True).csv(path)
    return path
