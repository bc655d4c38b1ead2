"""Customer value: recency, frequency, money, and expected worth."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _days(df: DataFrame, customer: str, time: str, amount: str) -> DataFrame:
    """One row per customer and day of purchase."""
    return df.groupBy(customer, F.to_date(time).alias("_day")).agg(F.sum(amount).alias("_spent"))


def rfm_summary(df: DataFrame, customer: str, time: str, amount: str, end: str) -> DataFrame:
    """Repeat days, days from first to last, age at the end, mean spend of the repeat days, days since last."""
    stop = F.lit(end).cast("date")
    days = _days(df.filter(F.to_date(time) <= stop), customer, time, amount)
    row = days.groupBy(customer).agg(
        (F.count(F.lit(1)) - 1).alias("frequency"), F.min("_day").alias("_first"), F.max("_day").alias("_last"),
        F.sum("_spent").alias("_all"), F.min_by("_spent", "_day").alias("_start"),
    )
    mean = F.when(F.col("frequency") > 0, (F.col("_all") - F.col("_start")) / F.col("frequency")).otherwise(0.0)
    return row.select(
        customer, "frequency", F.date_diff("_last", "_first").alias("recency"), F.date_diff(stop, F.col("_first")).alias("T"),
        mean.alias("monetary_value"), F.date_diff(stop, F.col("_last")).alias("days_since_last"),
    )


def rfm_train_test(df: DataFrame, customer: str, time: str, amount: str, train_end: str, test_end: str) -> DataFrame:
    """The summary up to the train end and purchase days and mean day spend in the holdout after it."""
    train = rfm_summary(df, customer, time, amount, train_end)
    after = df.filter((F.to_date(time) > F.lit(train_end).cast("date")) & (F.to_date(time) <= F.lit(test_end).cast("date")))
    held = _days(after, customer, time, amount).groupBy(customer).agg(
        F.count(F.lit(1)).alias("test_frequency"), F.avg("_spent").alias("test_monetary_value")
    )
    return train.join(held, customer, "left").na.fill(0, ["test_frequency", "test_monetary_value"])


def name_segments(scores: DataFrame, rules: Mapping[str, Column], default: str = "Other", out: str = "segment") -> DataFrame:
    """First rule that holds names the segment."""
    choice = None
    for name, rule in rules.items():
        choice = F.when(rule, name) if choice is None else choice.when(rule, name)
    return scores.withColumn(out, choice.otherwise(default))


def gamma_gamma_spend(frequency: Column, mean_spend: Column, p: float, q: float, gamma: float) -> Column:
    """Expected spend per purchase given the repeat purchases seen."""
    return p * (gamma + frequency * mean_spend) / (p * frequency + q - 1)


def discounted_value(df: DataFrame, customer: str, expected: Column, spend: Column, months: int, rate: float) -> DataFrame:
    """Sum over months of new expected purchases x spend, discounted.

    ``expected`` is the cumulative number of purchases by month, a column expression of ``month``.
    """
    rows = df.withColumn("month", F.explode(F.sequence(F.lit(0), F.lit(months))))
    rows = rows.withColumns({"_n": expected, "_spend": spend})
    # sum of (N_t - N_{t-1}) d^t, with the terms of each N_t gathered
    d = 1 / (1 + rate)
    m = F.col("month")
    up = F.when(m > 0, F.pow(F.lit(d), m)).otherwise(0.0)
    down = F.when(m < months, F.pow(F.lit(d), m + 1)).otherwise(0.0)
    return rows.groupBy(customer).agg(F.sum(F.col("_n") * (up - down) * F.col("_spend")).alias("clv"))
