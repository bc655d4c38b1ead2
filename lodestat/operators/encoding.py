"""Categorical encoders. Fitted state is a small table or a list of levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.operators.ordered import running_totals
from lodestat.operators.quantiles import attach



def levels(df: DataFrame, column: str) -> list:
    """Sorted distinct values; each becomes a column, so there are as many as a table can have columns."""
    return sorted(r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().collect())


def one_hot(df: DataFrame, columns: Sequence[str], drop: str | None = None) -> DataFrame:
    """Indicator columns ``<column>_<level>``; ``drop`` may be "first" or "last"."""
    out = df
    for c in columns:
        found = levels(df, c)
        found = {"first": found[1:], "last": found[:-1]}.get(drop or "", found)
        out = out.withColumns({f"{c}_{v}": F.coalesce((F.col(c) == v).cast("int"), F.lit(0)) for v in found}).drop(c)
    return out


def multilabel(df: DataFrame, column: str, sep: str = ",", prefix: str = "has_") -> DataFrame:
    """Indicator columns for the members of a delimited list column."""
    with_list = df.withColumn("_list", F.transform(F.split(column, sep), lambda x: F.trim(x)))
    found = levels(with_list.select(F.explode("_list").alias("v")), "v")
    return with_list.withColumns(
        {f"{prefix}{v}": F.coalesce(F.array_contains("_list", v).cast("int"), F.lit(0)) for v in found}
    ).drop("_list", column)


def ordinal_codes(df: DataFrame, column: str) -> DataFrame:
    """(value, code): the place of the value among the sorted distinct values, from 0."""
    distinct = df.filter(F.col(column).isNotNull()).select(column).distinct().withColumn("_one", F.lit(1))
    codes = running_totals(distinct, column, ["_one"])
    return codes.select(column, (F.col("cum__one") - 1).cast("int").alias("code"))


def ordinal_encode(df: DataFrame, column: str, fitted: DataFrame, out: str, unknown: int = -999) -> DataFrame:
    codes = fitted.select(column, F.col("code").alias(out))
    return attach(df, codes, [column]).withColumn(out, F.coalesce(out, F.lit(unknown)))


def count_encode(df: DataFrame, column: str, out: str, train: DataFrame | None = None) -> DataFrame:
    counts = (df if train is None else train).groupBy(column).agg(F.count(F.lit(1)).alias(out))
    return attach(df, counts, [column]).withColumn(out, F.coalesce(out, F.lit(0)))


def target_encode_ordered(
    df: DataFrame, column: str, target: str, order: str, out: str, prior: float = 0.5, weight: float = 1.0
) -> DataFrame:
    """Mean target over the category's rows that come before this one, pulled to a prior.

    ``order`` is a unique order column inside the category, e.g. a shuffled row number.
    """
    rows = df.withColumns({"_y": F.col(target).cast("double"), "_one": F.lit(1)})
    summed = running_totals(rows, order, ["_y", "_one"], [column])
    before_y, before_n = F.col("cum__y") - F.col("_y"), F.col("cum__one") - 1
    return summed.withColumn(out, (before_y + prior * weight) / (before_n + weight)).select(*df.columns, out)
