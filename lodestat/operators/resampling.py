"""Class balancing by synthetic rows and neighbour editing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.operators.neighbours import knn_join
from lodestat.session import checkpointed


def smote(df: DataFrame, id_: str, vector: str, label: str, minority, per_row: int, k: int = 30, seed: int = 42) -> DataFrame:
    """Synthetic rows between a minority row and one of its k nearest minority rows.

    The neighbour and the place between the two come from a hash of (id, number, seed).
    """
    small = df.filter(F.col(label) == minority)
    return _interpolated(small, small, knn_join(small, small, id_, vector, k), id_, vector, label, minority, per_row, seed)


def _interpolated(
    small: DataFrame, ends: DataFrame, near: DataFrame, id_: str, vector: str, label: str, minority, per_row: int, seed: int, reach: float = 1.0, name: str = ""
) -> DataFrame:
    """``per_row`` rows for every query of ``near`` (query, neighbour, rank), up to the share ``reach`` of the way to its neighbours in ``ends``."""
    most = near.groupBy("query").agg(F.max("rank").alias("_k"))
    draws = most.select("query", "_k", F.explode(F.sequence(F.lit(1), F.lit(per_row))).alias("number"))
    draws = draws.withColumn("rank", F.pmod(F.xxhash64("query", "number", F.lit(seed)), F.col("_k")).cast("int") + 1)
    place = F.pmod(F.xxhash64("query", "number", F.lit(seed + 1)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    chosen = draws.withColumn("u", place * reach).join(near, ["query", "rank"])
    base = small.select(F.col(id_).alias("query"), F.col(vector).alias("_a"))
    other = ends.select(F.col(id_).alias("neighbour"), F.col(vector).alias("_b"))
    joined = chosen.join(base, "query").join(other, "neighbour")
    between = F.zip_with("_a", "_b", lambda a, b: a.cast("double") + F.col("u") * (b.cast("double") - a.cast("double")))
    row = F.concat(F.concat_ws("-", "query", "number"), F.lit(name))
    return joined.select(row.alias("row"), F.col("query").alias("origin"), F.lit(minority).alias(label), between.alias(vector))


def border_classes(df: DataFrame, id_: str, vector: str, label: str, minority, neighbours: int = 10) -> DataFrame:
    """(query, others, border) of the minority rows: how many of the nearest rows have another label, and what that makes of the row.

    "noise" if all have, "danger" if at least half but not all have, else "safe". A row without any other row is safe.
    """
    small = df.filter(F.col(label) == minority)
    near = knn_join(small, df, id_, vector, neighbours).select("query", "neighbour")
    told = near.join(df.select(F.col(id_).alias("neighbour"), F.col(label).alias("_l")), "neighbour")
    counts = told.groupBy("query").agg(F.count_if(~F.col("_l").eqNullSafe(F.lit(minority))).alias("others"), F.count(F.lit(1)).alias("_n"))
    counts = small.select(F.col(id_).alias("query")).distinct().join(counts, "query", "left").na.fill(0, ["others", "_n"])
    border = F.when(F.col("_n") == 0, "safe").when(F.col("others") == F.col("_n"), "noise").when(2 * F.col("others") >= F.col("_n"), "danger").otherwise("safe")
    return counts.select("query", "others", border.alias("border"))


def borderline_smote(
    df: DataFrame, id_: str, vector: str, label: str, minority, per_row: int, k: int = 30, neighbours: int = 10, kind: int = 1, seed: int = 42
) -> DataFrame:
    """Synthetic rows of the minority rows in danger only, as ``smote`` makes them.

    Kind 1 goes between such a row and one of its k nearest minority rows. Kind 2 makes as many again between it and one of its k
    nearest rows of other labels, at most half of the way; their names end in "-o". The danger set is written once and gates both.
    """
    small = df.filter(F.col(label) == minority)
    classes = checkpointed(border_classes(df, id_, vector, label, minority, neighbours))
    danger = checkpointed(small.join(classes.filter("border = 'danger'").select(F.col("query").alias(id_)), id_, "left_semi"))
    made = _interpolated(small, small, knn_join(danger, small, id_, vector, k), id_, vector, label, minority, per_row, seed)
    if kind == 1:
        return made
    if kind != 2:
        raise ValueError("kind is 1 or 2")
    rest = df.filter(~F.col(label).eqNullSafe(F.lit(minority)))
    over = _interpolated(small, rest, knn_join(danger, rest, id_, vector, k), id_, vector, label, minority, per_row, seed + 2, 0.5, "-o")
    return made.unionByName(over)


def edit_by_neighbours(df: DataFrame, id_: str, vector: str, label: str, k: int = 3) -> DataFrame:
    """Keep the rows whose label agrees with the mode of their k nearest rows."""
    from lodestat.operators.neighbours import vote

    df = checkpointed(df)
    mode = vote(knn_join(df, df, id_, vector, k), df, id_, label, weighted=False)
    return df.join(mode.withColumnRenamed("query", id_), id_).filter(F.col(label) == F.col("predicted")).drop("predicted")
