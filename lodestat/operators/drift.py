"""Drift between a benchmark and a monitored population."""

from __future__ import annotations

import logging
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.functions.bins import cut_index
from lodestat.operators.aggregates import RULES, histogram_rules
from lodestat.operators.quantiles import exact_quantiles
from lodestat.operators.ranking import somers_d
from lodestat.session import checkpointed

log = logging.getLogger(__name__)


def width_bin(value: Column, low: Column, step: Column, bins: Column) -> Column:
    """Equal-width bin [e_i, e_i+1), outer bins open to both sides."""
    guess = F.floor((value - low) / step)
    exact = (
        F.when(value < low + guess * step, guess - 1).when(value >= low + (guess + 1) * step, guess + 1).otherwise(guess)
    )
    return F.greatest(F.lit(0).cast("long"), F.least(exact, bins - 1))


def _edges(benchmark: DataFrame, column: str, bins: str | int | Sequence[float], data_range: tuple[float, float] | None) -> list[float] | tuple[float, float, int]:
    """Explicit edges as given, or (low, high, number) of equal-width bins."""
    value = F.col(column).cast("double")
    if not isinstance(bins, (str, int)):
        edges = [float(e) for e in bins]
        if len(edges) < 2 or any(a >= b for a, b in zip(edges, edges[1:])):
            raise ValueError("bin edges must be two or more and rise")
        return edges
    if data_range is not None and not data_range[0] < data_range[1]:
        raise ValueError("data_range must rise")
    inside = benchmark if data_range is None else benchmark.filter(value.between(*data_range))
    ends = inside.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    if ends["lo"] is None:
        raise ValueError(f"the benchmark has no value of {column}")
    low, high = data_range or (ends["lo"], ends["hi"])
    if isinstance(bins, int):
        if bins < 1:
            raise ValueError("at least one bin is needed")
        number = bins
    else:
        if bins not in RULES:
            raise ValueError(f"unknown rule: {bins}")
        found = histogram_rules(inside, column, [bins]).first()
        number = max(1, math.ceil((high - low) / found["width"])) if found["width"] else 1
    # a constant column gets one unit of width, as histograms have it
    return (low, high, number) if low < high else (low - 0.5, high + 0.5, number)


def psi(
    benchmark: DataFrame, monitoring: DataFrame, column: str, rule: str | int | Sequence[float] = "doane", eps: float = 1e-6,
    data_range: tuple[float, float] | None = None, open_ended: bool = True,
) -> DataFrame:
    """Population stability index over bins set by the benchmark alone.

    ``rule`` is the name of a bin rule, a number of equal-width bins, or rising edges. Bins are closed below; the outer ones are open
    to both sides, or, with ``open_ended`` off, the last is closed above and values outside are left out. ``data_range``
    bounds what equal-width bins cover. Empty shares become eps and both sides are scaled to one again before the sum. Raises for an
    empty side, edges that don't rise and unknown rules. Only bins that hold a value become rows; the others are two
    known terms, so a great number of bins costs nothing.
    """
    edges = _edges(benchmark, column, rule, data_range)
    value = F.col(column).cast("double")
    if isinstance(edges, list):
        low, high, number = edges[0], edges[-1], len(edges) - 1
        place = cut_index(F.col("v"), edges[1:-1], right=False).cast("long")
    else:
        low, high, number = edges
        place = width_bin(F.col("v"), F.lit(low), F.lit((high - low) / number), F.lit(number))
    sides = benchmark.select(value.alias("v"), F.lit(0).alias("side")).union(monitoring.select(value, F.lit(1)))
    sides = sides.filter(F.col("v").isNotNull() if open_ended else F.col("v").between(low, high))
    counts = sides.groupBy(place.alias("bin")).agg(F.count_if(F.col("side") == 0).alias("b"), F.count_if(F.col("side") == 1).alias("m"))
    counts = checkpointed(counts)
    sums = counts.agg(F.sum("b").alias("b"), F.sum("m").alias("m"), F.count_if(F.col("b") > 0).alias("full_b"), F.count_if(F.col("m") > 0).alias("full_m"), F.count(F.lit(1)).alias("n")).first()
    if not sums["b"] or not sums["m"]:
        raise ValueError("both sides need values")
    # the shares of one side add up to one, and each of its empty bins adds eps
    scale_b, scale_m = 1 + eps * (number - sums["full_b"]), 1 + eps * (number - sums["full_m"])
    q = F.when(F.col("b") == 0, eps).otherwise(F.col("b") / sums["b"]) / scale_b
    p = F.when(F.col("m") == 0, eps).otherwise(F.col("m") / sums["m"]) / scale_m
    both_empty = (number - sums["n"]) * (eps / scale_m - eps / scale_b) * math.log(scale_b / scale_m)
    return counts.agg((F.sum((p - q) * F.ln(p / q)) + both_empty).alias("psi"), F.lit(number).cast("long").alias("bins"))


def score_breaks(df: DataFrame, score: str, quantiles: int | list[float]) -> list[float]:
    """Distinct finite quantile break points (a list as long as the argument, not the data)."""
    probabilities = [i / quantiles for i in range(1, quantiles)] if isinstance(quantiles, int) else list(quantiles)
    row = exact_quantiles(df, [score], {f"q{i}": p for i, p in enumerate(probabilities)}).first()
    found = {row[f"q{i}"] for i in range(len(probabilities))} if row else set()
    return sorted(v for v in found if v is not None and v not in (float("inf"), float("-inf")))


def bin_weights(benchmark: DataFrame, monitoring: DataFrame, score: str, breaks: list[float]) -> dict[int, float]:
    """Monitoring / benchmark count per score bin, after the coverage checks."""

    def counts(df: DataFrame) -> dict[int, int]:
        rows = df.filter(F.col(score).isNotNull() & ~F.isnan(score))
        binned = rows.groupBy(cut_index(F.col(score).cast("double"), breaks).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        # at most one row per bin
        return {r["bin"]: r["n"] for r in binned.collect()}

    base, now = counts(benchmark), counts(monitoring)
    uncovered = sorted(set(now) - set(base))
    if uncovered:
        raise ValueError(f"score bins {uncovered} occur in monitoring but not in the benchmark")
    if not set(base) & set(now):
        raise ValueError("benchmark and monitoring share no score bin")
    unused = sorted(set(base) - set(now))
    if unused:
        log.warning("benchmark rows in score bins %s get zero weight", unused)
    return {b: now.get(b, 0) / n for b, n in base.items()}


def wsri(
    benchmark: DataFrame, monitoring: DataFrame, score: str, label: Column, quantiles: int | list[float] = 20, metric=somers_d
) -> DataFrame:
    """Ranking power on monitoring over that on the benchmark reweighted to the monitoring scores.

    ``metric(df, score, label, weight)`` returns one row with one column; null when the
    benchmark's value is 0.
    """
    breaks = score_breaks(benchmark, score, quantiles)
    weights = bin_weights(benchmark, monitoring, score, breaks)
    table = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
    clean = lambda df: df.filter(F.col(score).isNotNull() & ~F.isnan(score))
    weighted = clean(benchmark).withColumn("_w", table[cut_index(F.col(score).cast("double"), breaks)])
    base = metric(weighted, score, label, F.col("_w"))
    now = metric(clean(monitoring), score, label, None)
    d_now = F.col(now.columns[0])
    d_base = base.scalar()
    return now.select(
        d_now.alias("monitoring_d"), d_base.alias("benchmark_d"), F.when(d_base != 0, d_now / d_base).alias("wsri")
    )
