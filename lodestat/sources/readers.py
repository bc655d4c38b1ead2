"""Readers for the file shapes the analyses start from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.sources import xlsx


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    header: bool = True,
    names: Sequence[str] | None = None,
    skip_where: tuple[str, Sequence[str]] | None = None,
) -> DataFrame:
    """CSV with a given schema.

    ``skip_where=(column, texts)`` drops the lines whose first-named column holds one of the texts;
    this is how leading junk or a second header is skipped in a file split over many tasks.
    """
    if skip_where is None:
        df = spark.read.schema(schema).option("sep", sep).option("header", header).csv(path)
    else:
        column, texts = skip_where
        loose = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
        df = spark.read.schema(loose).option("sep", sep).option("header", header).csv(path)
        df = df.filter(F.col(column).isNull() | ~F.col(column).isin(*texts))
        df = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    return df.toDF(*names) if names else df


def read_csv_by_year(spark: SparkSession, glob: str, schema: T.StructType, id_column: str, second_header: str) -> DataFrame:
    """Yearly files under a glob: the year comes from the file path, a second header line is dropped."""
    loose = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    df = spark.read.schema(loose).option("header", True).csv(glob)
    df = df.withColumn("file_year", F.regexp_extract(F.col("_metadata.file_path"), r"_(\d{4})[/.]", 1).cast("int"))
    df = df.filter(F.col(id_column) != second_header)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], "file_year")


def read_ndjson(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_xlsx(spark: SparkSession, path: str, schema: T.StructType | None = None, sheet: str = "0", skip: int = 0, header: bool = True) -> DataFrame:
    """Sheets of the workbooks below ``path``; see ``sources.xlsx``."""
    xlsx.register(spark)
    reader = spark.read.format("xlsx").options(sheet=sheet, skip=skip, header=header)
    return (reader.schema(schema) if schema else reader).load(path)


def object_stats(spark: SparkSession, path: str, payload_mb: int = 6) -> DataFrame:
    """Total bytes, object count, mean size and the number of payloads under a folder (metadata only)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length")
    stats = files.agg(F.sum("length").alias("total_bytes"), F.count(F.lit(1)).alias("objects"))
    return stats.select(
        "total_bytes",
        "objects",
        (F.col("total_bytes") / F.col("objects")).alias("mean_bytes"),
        F.ceil(F.col("total_bytes") / (payload_mb * 1024 * 1024)).alias("payloads"),
    )
