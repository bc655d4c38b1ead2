"""Nearest prototypes of mixed-type rows, with the prototypes as a table of any length."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.session import checkpointed

USED = 3  # numeric and categorical columns that make up cells; the others count in distances only


def _subsets(columns: Sequence[str]) -> list[tuple[str, ...]]:
    return [s for n in range(len(columns), -1, -1) for s in combinations(columns, n)]


def _key(agreed: int, values: Sequence[str], level: Column, cells: Sequence[Column]) -> Column:
    """One long for a cell; two cells with one long only add candidates, whose distances are computed in full."""
    return F.xxhash64(F.lit(agreed), *values, level.cast("int"), *[c.cast("long") for c in cells])


def nearest_gower(
    rows: DataFrame, id_: str, prototypes: DataFrame, key: str, numeric: Sequence[str], categorical: Sequence[str], ranges: Mapping[str, float], levels: int = 16
) -> DataFrame:
    """(id, nearest, distance): for every row the key of the prototype at the least Gower distance, and that distance.

    Distances equal to 9 digits go by the least key. The distance is the mean over all columns of |difference| / range and of 0 or 1
    for equal or different categories. Rows equal in all columns are searched once, and so are equal prototypes.

    A blocked join in two steps, on equal keys only. A block is a set of agreeing categories with a cell of the numeric columns, of width
    2^-level in units of the ranges. First a row meets one prototype of each of its own blocks, at every level: the best of these bounds
    its distance. A prototype that agrees on a set of categories only has one full mismatch for every other, so what the bound leaves for the
    numeric columns is a radius; sets that leave none are ruled out. Then the row meets all prototypes of the cells that this radius touches,
    at the level where cells are about as wide, at most 3 a column. Blocks use the first three columns of either kind.
    ``levels`` limits the finest width; prototypes that differ, but are closer than it and share their categories, are met together.

    A row with a null or NaN in a column gets a null prototype, a prototype with one is nobody's nearest, and without prototypes all are null.
    """
    columns = [*numeric, *categorical]
    whole = lambda df: df.where(F.expr(" and ".join([f"`{c}` is not null" for c in columns] + [f"not isnan(`{c}`)" for c in numeric])))
    profiles = checkpointed(whole(rows.select(*[F.col(c).cast("double").alias(c) for c in numeric], *categorical)).distinct())
    heads = whole(prototypes.select(key, *[F.col(c).cast("double").alias(c) for c in numeric], *categorical))
    heads = checkpointed(heads.groupBy(*columns).agg(F.min(key).alias("_key")))
    widths = {c: float(ranges[c] or 1.0) for c in numeric}
    cut, sets = list(numeric[:USED]), _subsets(categorical[:USED])
    ends = profiles.select(*cut).unionByName(heads.select(*cut)).agg(F.lit(0).alias("_"), *[f(c).alias(f"{n}_{c}") for c in cut for n, f in (("lo", F.min), ("hi", F.max))]).first()
    empty = any(ends[f"lo_{c}"] is None for c in cut)
    span = max((0.0 if empty else (ends[f"hi_{c}"] - ends[f"lo_{c}"]) / widths[c] for c in cut), default=0.0)
    top = -(math.floor(math.log2(span)) + 1) if span > 0 else 0  # cells this wide hold everything
    bottom = max(top, levels)
    at = {c: (F.col(c) - F.lit(0.0 if empty else ends[f"lo_{c}"])) / widths[c] for c in cut}
    width = lambda level: F.pow(F.lit(2.0), -level)

    def blocks(df: DataFrame) -> DataFrame:
        """Each row in its own block at every level and set of agreeing categories."""
        spread = df.withColumn("_level", F.explode(F.sequence(F.lit(top), F.lit(bottom))))
        cells = [F.floor(at[c] / width(F.col("_level"))) for c in cut]
        return spread.withColumn("_block", F.explode(F.array(*[_key(i, s, F.col("_level"), cells) for i, s in enumerate(sets)]))).drop("_level")

    homes = checkpointed(blocks(heads).select("_block", F.struct("_key", *columns).alias("_p")))
    terms = [F.abs(F.col(c) - F.col(f"_p.{c}")) / widths[c] for c in numeric] + [(F.col(c) != F.col(f"_p.{c}")).cast("double") for c in categorical]
    distance = sum(terms[1:], terms[0]) / len(columns)
    samples = homes.groupBy("_block").agg(F.min_by("_p", "_p._key").alias("_p"))
    bounds = blocks(profiles).join(samples, "_block").groupBy(*columns).agg(F.min(distance).alias("_bound"))
    bounds = checkpointed(bounds)

    asked = None
    for i, s in enumerate(sets):
        left = F.col("_bound") * len(columns) - (min(len(categorical), USED) - len(s)) + 1e-8
        near = bounds.withColumn("_r", left).where("_r >= 0")
        near = near.withColumn("_level", F.greatest(F.lit(top), F.least(F.lit(bottom), F.floor(-F.log2("_r")).cast("int"))))
        for c in cut:
            w, last = width(F.col("_level")), F.floor(F.lit(0.0 if empty else (ends[f"hi_{c}"] - ends[f"lo_{c}"]) / widths[c]) / width(F.col("_level")))
            low, high = F.greatest(F.lit(0), F.floor((at[c] - F.col("_r")) / w)), F.least(last, F.floor((at[c] + F.col("_r")) / w))
            near = near.withColumn(f"_cell_{c}", F.explode(F.sequence(low, high)))
        part = near.select(*columns, _key(i, s, F.col("_level"), [F.col(f"_cell_{c}") for c in cut]).alias("_block"))
        asked = part if asked is None else asked.unionByName(part)
    met = asked.join(homes, "_block").withColumn("_d", distance)
    best = met.groupBy(*columns).agg(F.min(F.struct(F.round("_d", 9).alias("rounded"), F.col("_p._key").alias("key"), "_d")).alias("_best"))
    found = best.select(*[F.col(c).alias(f"_f_{c}") for c in columns], F.col("_best.key").alias("nearest"), F.col("_best._d").alias("distance"))
    same = [F.col(c).cast("double") == F.col(f"_f_{c}") for c in numeric] + [F.col(c) == F.col(f"_f_{c}") for c in categorical]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return rows.select(id_, *columns).join(found, on, "left").select(id_, "nearest", "distance")
