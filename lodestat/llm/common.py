"""Small helpers that several operators share."""

from __future__ import annotations

import math
import string
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.session import shared_folder

# fixed values: a word is a run of anything but ASCII space and the controls tab to carriage return
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def id_remainder(key: str, modulus: int) -> Column:
    """crc32 of the id's text, modulo; -1 for a null id, which is therefore in no numbered class."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % modulus, F.lit(-1))


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def whole_row(df: DataFrame, name: str = "doc") -> Column:
    """All columns as one struct, where no name of theirs can clash with a column added beside it."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias(name)


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, *, partition_by: tuple[str, ...] = (), compression: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage is cut and lost executors cost nothing twice."""
    path = new_path(df.sparkSession, label)
    df.write.option("compression", compression).partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts_for(spark: SparkSession, total_bytes: float, part_bytes: int) -> int:
    """Parts of about ``part_bytes``, and no fewer than the session's shuffle partitions."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(total_bytes / part_bytes))


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of every query that is run inside go when it ends; for steps that are written and read back, whose shuffles nobody reads again."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)
