"""Look-back features per account.

A look-back frame of length p only needs rows at most p old. Time is cut into slices longer than
the longest look-back; every row goes to its own slice and, if late in it, as context to the next.
A hot account is thus spread over as many tasks as there are slices, and every frame is whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestat.operators.rolling import rolling_statistics

HOUR = 3_600_000_000


def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def time_sliced(df: DataFrame, ts: str, longest_hours: float) -> DataFrame:
    """Copy each row into its own time slice and, if a look-back from there can see it, the next one.

    Slices are twice the longest look-back, so half of the rows travel twice. Adds ``_us``
    (microseconds), ``_slice`` and ``_own`` (false on context copies).
    """
    reach = int(longest_hours * HOUR)
    home = F.floor(F.col("_us") / F.lit(2 * reach))
    timed = df.withColumn("_us", micros(ts))
    late = F.col("_us") >= (home + 1) * F.lit(2 * reach) - F.lit(reach)
    steps = F.when(late, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    spread = timed.withColumn("_step", F.explode(steps))
    return spread.withColumn("_slice", home + F.col("_step")).withColumn("_own", F.col("_step") == 0).drop("_step")


def look_back(keys: Sequence[str], hours: float):
    """Frame over (t - p, t]: open on the left, closed on the right, peers included."""
    return Window.partitionBy(*keys, "_slice").orderBy("_us").rangeBetween(-int(hours * HOUR) + 1, 0)


def rolling_amounts(
    df: DataFrame, account: str, ts: str, amount: str, periods: Sequence[int], by: Sequence[str] = (), prefix: str = ""
) -> DataFrame:
    """Sum, median and count of the amount over each look-back (hours), per account and ``by`` values."""
    sliced = time_sliced(df, ts, max(periods))
    return rolling_statistics(sliced, [account, *by, "_slice"], amount, {f"{p}h": int(p * HOUR) for p in periods}, prefix).drop("_slice")


def rolling_amounts_pairs(
    df: DataFrame, account: str, ts: str, amount: str, periods: Sequence[int], group_by: Sequence[str]
) -> DataFrame:
    """The account features again for every pair of grouping columns; one exchange per pair."""
    out = rolling_amounts(df, account, ts, amount, periods)
    for a, b in combinations(group_by, 2):
        out = rolling_amounts(out, account, ts, amount, periods, (a, b), f"{a}_{b}_")
    return out


def lookback_distinct(df: DataFrame, account: str, ts: str, column: str, hours: int, out: str) -> DataFrame:
    """Distinct values of a column among the account's rows in the look-back."""
    w = look_back([account], hours)
    seen = F.size(F.collect_set(column).over(w)).cast("long").alias(out)
    return time_sliced(df, ts, hours).select(*df.columns, "_own", seen).filter("_own").drop("_own")


def rolling_angles(df: DataFrame, account: str, ts: str, days: Sequence[int]) -> DataFrame:
    """Circular statistics of the time of day over each look-back.

    The sums of sine and cosine are sufficient: they give the mean direction, the mean resultant
    length and, through ``functions.special.kappa_of_resultant``, the concentration.
    """
    angle = time_angle(ts)
    sliced = time_sliced(df.withColumn("_angle", angle), ts, 24 * max(days))
    sums = []
    for d in days:
        w = look_back([account], 24 * d)
        sums += [
            F.sum(F.sin("_angle")).over(w).alias(f"sin_{d}d"),
            F.sum(F.cos("_angle")).over(w).alias(f"cos_{d}d"),
            F.count(F.lit(1)).over(w).alias(f"n_{d}d"),
        ]
    out = sliced.select(*df.columns, "_own", F.col("_angle").alias("angle"), *sums).filter("_own").drop("_own")
    for d in days:
        s, c, n = F.col(f"sin_{d}d"), F.col(f"cos_{d}d"), F.col(f"n_{d}d")
        out = out.withColumn(f"mean_{d}d", F.atan2(s, c)).withColumn(f"resultant_{d}d", F.sqrt(s * s + c * c) / n)
    return out


def time_angle(ts: str) -> Column:
    """Time of day on a circle, [0, 2 pi)."""
    t = F.col(ts)
    seconds = F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    return seconds * (2 * 3.141592653589793 / 86400)
