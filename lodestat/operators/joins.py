"""Join shapes of the analyses."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.operators.quantiles import attach


def left_chain(first: DataFrame, others: Sequence[DataFrame], key: str) -> DataFrame:
    """Left-join tables on one key; all joins share the key, so one exchange per table suffices."""
    return reduce(lambda left, right: left.join(right, key, "left"), others, first)


def absent_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).distinct().join(right.select(key).distinct(), key, "left_anti")


def keep_listed(df: DataFrame, keys: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows whose key occurs in ``keys``; unlike NOT IN this is safe for nulls."""
    listed = keys.select(F.col(right_key).alias("_listed"))
    return df.join(listed, F.col(left_key) == F.col("_listed"), "left_semi")


def complement(df: DataFrame, taken: Sequence[DataFrame], key: str) -> DataFrame:
    """Rows whose key is in none of the taken tables."""
    union = reduce(DataFrame.union, [x.select(key) for x in taken])
    return df.join(union, key, "left_anti")


def lookup(df: DataFrame, table: DataFrame, key: str, table_key: str, column: str, out: str, default=None) -> DataFrame:
    """Bind one column of a table with unique keys; the optimizer broadcasts it when it is small."""
    small = table.select(F.col(table_key).alias(key), F.col(column).alias(out))
    joined = attach(df, small, [key])
    return joined if default is None else joined.withColumn(out, F.coalesce(out, F.lit(default)))


def mean_of_folds(folds: Sequence[DataFrame], key: str, value: str, out: str) -> DataFrame:
    """Mean of a value over tables with the same key: one union and one aggregate, not k joins."""
    union = reduce(DataFrame.unionByName, [f.select(key, value) for f in folds])
    return union.groupBy(key).agg(F.avg(value).alias(out), F.count(value).alias("folds"))
