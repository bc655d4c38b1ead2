"""Train/validation/test splits, folds and sliding windows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.operators.ordered import hash_key, hash_row_numbers, row_numbers, running_totals
from lodestat.operators.quantiles import attach


def check_cover(keys: DataFrame, parts: Sequence[DataFrame], key: str) -> DataFrame:
    """One row: number of keys, whether no key is in two parts, whether every key is in one."""
    tagged = reduce(DataFrame.union, [p.select(key).distinct().withColumn("_part", F.lit(i)) for i, p in enumerate(parts)])
    seen = tagged.groupBy(key).agg(F.count(F.lit(1)).alias("_parts"))
    joined = keys.select(key).distinct().join(seen, key, "full_outer")
    return joined.agg(
        F.count(F.lit(1)).alias("keys"),
        (F.coalesce(F.max("_parts"), F.lit(0)) <= 1).alias("disjoint"),
        (F.count("_parts") == F.count(F.lit(1))).alias("complete"),
    )


def split_by_bucket(df: DataFrame, ids: Sequence[str], shares: Mapping[str, float], seed: int = 42, out: str = "split") -> DataFrame:
    """Split by the place of a row's hash in [0, 1); needs no shuffle and survives new rows."""
    place = F.conv(F.substring(hash_key(*ids, seed=seed), 1, 8), 16, 10).cast("double") / float(2**32)
    names, edge, label = list(shares), 0.0, None
    for name in names[:-1]:
        edge += shares[name]
        test = place < F.lit(edge)
        label = F.when(test, name) if label is None else label.when(test, name)
    return df.withColumn(out, label.otherwise(names[-1]))


def split_crc32(df: DataFrame, column: str, test_share: float, out: str = "is_test") -> DataFrame:
    """Test rows are those whose CRC-32 of the little-endian 8-byte id is below the share of 2^32."""
    big_endian = F.hex(F.col(column).cast("long"))
    padded = F.lpad(big_endian, 16, "0")
    little = F.concat(*[F.substring(padded, i, 2) for i in range(15, 0, -2)])
    return df.withColumn(out, F.crc32(F.unhex(little)) < F.lit(int(test_share * 2**32)))


def split_stratified(
    df: DataFrame, ids: Sequence[str], strata: str, shares: Mapping[str, float], seed: int = 42, out: str = "split"
) -> DataFrame:
    """Cut every class, in hash order, at the cumulative shares (exact up to rounding)."""
    ranked = hash_row_numbers(df, ids, [strata], seed, "_i")
    sizes = df.groupBy(strata).agg(F.count(F.lit(1)).alias("_n"))
    ranked = attach(ranked, sizes, [strata])
    names, edge, label = list(shares), 0.0, None
    for name in names[:-1]:
        edge += shares[name]
        test = F.col("_i") <= F.round(F.col("_n") * F.lit(edge))
        label = F.when(test, name) if label is None else label.when(test, name)
    return ranked.withColumn(out, label.otherwise(names[-1])).drop("_i", "_n")


def split_exact_counts(
    df: DataFrame, ids: Sequence[str], strata: str, shares: Mapping[str, float], seed: int = 42, out: str = "split"
) -> DataFrame:
    """Every class gives int(share * n) rows to each split but the last, which takes the rest."""
    ranked = hash_row_numbers(df, ids, [strata], seed, "_i")
    sizes = df.groupBy(strata).agg(F.count(F.lit(1)).alias("_n"))
    ranked = attach(ranked, sizes, [strata])
    names, edge, label = list(shares), F.lit(0), None
    for name in names[:-1]:
        edge = edge + F.floor(F.col("_n") * F.lit(shares[name]))
        test = F.col("_i") <= edge
        label = F.when(test, name) if label is None else label.when(test, name)
    return ranked.withColumn(out, label.otherwise(names[-1])).drop("_i", "_n")


def fold_numbers(
    df: DataFrame, ids: Sequence[str], folds: int, strata: Sequence[str] = (), group: str | None = None,
    seed: int = 42, out: str = "fold",
) -> DataFrame:
    """Folds 0..k-1 by turns in hash order: inside strata, or over whole groups."""
    if group is None:
        ranked = hash_row_numbers(df, ids, list(strata), seed, "_i")
        return ranked.withColumn(out, ((F.col("_i") - 1) % folds).cast("int")).drop("_i")
    groups = hash_row_numbers(df.select(group).distinct(), [group], (), seed, "_i")
    groups = groups.select(group, ((F.col("_i") - 1) % folds).cast("int").alias(out))
    return attach(df, groups, [group])


def split_groups(df: DataFrame, group: str, label, slots: Mapping[str, int], strata: int = 5, out: str = "split") -> DataFrame:
    """Whole groups to splits, classes balanced: one row per group with its split.

    Groups are cut in strata of like label share; inside a stratum they are dealt from the largest
    to the smallest over the slots there and back, so sizes even out too.
    """
    g = df.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.count_if(label).alias("_pos"))
    k = g.agg(F.count(F.lit(1))).scalar()
    g = row_numbers(g.withColumn("_share", F.col("_pos") / F.col("_n")), "_share", group, name="_i")
    g = g.withColumn("_stratum", F.floor((F.col("_i") - 1) * strata / k)).drop("_i")
    g = row_numbers(g, "_n", group, ["_stratum"], "_i", descending=True)
    width = sum(slots.values())
    turn = (F.col("_i") - 1) % (2 * width)
    place = F.when(turn < width, turn).otherwise(2 * width - 1 - turn)
    names, edge, choice = list(slots), 0, None
    for name in names[:-1]:
        edge += slots[name]
        choice = F.when(place < edge, name) if choice is None else choice.when(place < edge, name)
    return g.select(group, choice.otherwise(names[-1]).alias(out))


def split_last_periods(series: DataFrame, time: str, horizon: int, out: str = "split") -> DataFrame:
    """The last ``horizon`` distinct periods are test. The cut is one value, found by a top-k."""
    last = series.select(time).distinct().orderBy(F.desc(time)).limit(horizon)
    cut = last.agg(F.min(time)).scalar()
    return series.withColumn(out, F.when(F.col(time) >= cut, "test").otherwise("train"))


def sliding_windows(series: DataFrame, time: str, window: int, horizon: int, step: int) -> DataFrame:
    """Every complete (train window, test horizon) split of a numbered series, in long form.

    A row knows from its own number which splits hold it, so nothing is joined: the splits with
    start in (i - window - horizon, i] that are multiples of the step.
    """
    numbered = running_totals(series.withColumn("_one", F.lit(1)), time, ["_one"]).withColumn("_i", F.col("cum__one") - 1)
    n = series.agg(F.count(F.lit(1))).scalar()
    last = F.floor((n - horizon - window) / step)
    low = F.greatest(F.lit(0), F.ceil((F.col("_i") - window - horizon + 1) / step))
    high = F.least(last, F.floor(F.col("_i") / step))
    rows = numbered.filter(low <= high).withColumn("split", F.explode(F.sequence(low, high)))
    part = F.when(F.col("_i") < F.col("split") * step + window, "train").otherwise("test")
    return rows.withColumn("part", part).select(*series.columns, "split", "part")
