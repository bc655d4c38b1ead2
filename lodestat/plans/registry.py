"""Registry of runnable plans: a key, the Spark plan, and the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PLANS: dict[str, Callable[["Tables"], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """The tables of one folder, opened on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def plan(key: str, sql: str | None = None):
    def register(function):
        if key in PLANS:
            raise ValueError(f"key registered twice: {key}")
        PLANS[key] = function
        if sql is not None:
            SQL[key] = sql
        return function

    return register


def r6(value: Column | str, digits: int = 6) -> Column:
    return F.round(F.col(value) if isinstance(value, str) else value, digits)
