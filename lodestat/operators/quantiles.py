"""Exact quantiles without holding a group's values in memory."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.operators.ordered import running_totals


def melt(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """Long form (keys, column, value) with values as double."""
    return df.select(
        *keys,
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
        ).alias("_cell"),
    ).select(*keys, "_cell.column", "_cell.value")


def value_ranks(long: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Distinct values with ``n`` (rows of the value) and ``upto`` (rows up to and with it)."""
    counts = long.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    return running_totals(counts, value, ["n"], keys).withColumnRenamed("cum_n", "upto")


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float], keys: Sequence[str] = ()
) -> DataFrame:
    """One row per (keys, column) with a column per named probability, linear interpolation.

    Built from counts of distinct values and their running totals: memory does not grow with the
    group, and a hot key or hot value only adds to a count.
    """
    groups = [*keys, "column"]
    ranks = value_ranks(melt(df, columns, keys), groups)
    sizes = ranks.groupBy(*groups).agg(F.sum("n").alias("_size"))
    left, right = ranks.alias("r_"), sizes.alias("s_")
    on = None
    for g in groups:
        test = F.col(f"r_.{g}").eqNullSafe(F.col(f"s_.{g}"))
        on = test if on is None else on & test
    rows = left.join(right, on).select("r_.*", "s_._size")
    before = F.col("upto") - F.col("n")
    wanted = F.array(*[F.lit(float(p)) for p in probabilities.values()])
    place = lambda i: F.get(wanted, i) * (F.col("_size") - 1)
    holds = lambda at: (before <= at) & (at < F.col("upto"))
    numbers = F.sequence(F.lit(0), F.lit(len(probabilities) - 1))
    # a distinct value is kept for the probabilities whose lower or upper rank falls on it
    kept = F.filter(numbers, lambda i: holds(F.floor(place(i))) | holds(F.ceil(place(i))))
    hits = rows.withColumn("_i", F.explode(kept))
    ends = hits.groupBy(*groups, "_i").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.max("_size").alias("_size"))
    share = place(F.col("_i")) - F.floor(place(F.col("_i")))
    ends = ends.withColumn("_q", F.col("_lo") + (F.col("_hi") - F.col("_lo")) * share)
    out = [F.max(F.when(F.col("_i") == i, F.col("_q"))).alias(name) for i, name in enumerate(probabilities)]
    return ends.groupBy(*groups).agg(F.max("_size").alias("size"), *out)


def attach(df: DataFrame, per_key: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Bind a table with one row per key back to the rows (null keys match).

    The per-key side is unique, so a hot key on the row side is only probed; adaptive execution
    splits such a partition of the row side.
    """
    left, right = df.alias("l_"), per_key.alias("k_")
    on = None
    for k in keys:
        test = F.col(f"l_.{k}").eqNullSafe(F.col(f"k_.{k}"))
        on = test if on is None else on & test
    extra = [c for c in per_key.columns if c not in keys]
    return left.join(right, on, how).select("l_.*", *[F.col(f"k_.{c}") for c in extra])


def quantile_struct(df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float]) -> DataFrame:
    """A single row with one struct column ``q`` of fields ``<column>_<name>``, for use as a scalar."""
    table = exact_quantiles(df, columns, probabilities)
    cells = [
        F.max(F.when(F.col("column") == c, F.col(name))).alias(f"{c}_{name}") for c in columns for name in probabilities
    ]
    return table.agg(*cells).select(F.struct("*").alias("q"))


def quantile_values(df: DataFrame, columns: Sequence[str], probabilities: Mapping[str, float]) -> dict[str, float]:
    """The quantiles as numbers on the driver: one row, as wide as the arguments."""
    return quantile_struct(df, columns, probabilities).first()["q"].asDict()
