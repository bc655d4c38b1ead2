"""Repeatable samples. A draw is a place in hash order, never a random generator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.operators.ordered import hash_key, hash_row_numbers, running_totals


def sample_rows(df: DataFrame, ids: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """n rows; each task keeps its n least hashes, then the least n of those are taken."""
    return df.withColumn("_h", hash_key(*ids, seed=seed)).orderBy("_h").limit(n).drop("_h")


def one_per_value(df: DataFrame, columns: Sequence[str], ids: Sequence[str], seed: int = 42) -> DataFrame:
    """One row for each value of each categorical column: (column, value, the row's fields)."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    long = df.withColumn("_h", hash_key(*ids, seed=seed)).select("*", F.inline(cells))
    picked = long.groupBy("column", "value").agg(F.min_by(F.struct(*df.columns), "_h").alias("_row"))
    return picked.select("column", "value", "_row.*")


def cap_per_class(df: DataFrame, label: str, ids: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """At most n rows of each class, in hash order."""
    return hash_row_numbers(df, ids, [label], seed, "_i").filter(F.col("_i") <= n).drop("_i")


def evenly_spaced(df: DataFrame, order: str, count: int | None = None, share: float | None = None) -> DataFrame:
    """Rows at evenly spaced places floor(i (n - 1) / (k - 1)) of a unique order column.

    Whether a place is hit is arithmetic on the place itself, so no list of places is joined.
    """
    ranked = running_totals(df.withColumn("_one", F.lit(1)), order, ["_one"])
    n = df.agg(F.count(F.lit(1))).scalar()
    k = F.lit(count) if count is not None else F.ceil(n * F.lit(share))
    place = F.col("cum__one") - 1
    i = F.ceil(place * (k - 1) / (n - 1))
    hit = F.floor(i * (n - 1) / (k - 1)) == place
    kept = ranked.filter(F.when((k >= n) | (n <= 1), True).when(k <= 1, place == 0).otherwise(hit & (i < k)))
    return kept.select(*df.columns)
