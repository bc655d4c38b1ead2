"""Column selection, missing values, duplicates and profiles."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.operators.quantiles import quantile_values

KINDS = {
    "numeric": (T.NumericType,),
    "string": (T.StringType,),
    "temporal": (T.DateType, T.TimestampType, T.TimestampNTZType),
    "boolean": (T.BooleanType,),
}


def clean_name(name: str) -> str:
    """Lower case, runs of anything but letters and digits to one underscore, none at the ends."""
    return re.sub(r"[^0-9a-z]+", "_", name.lower()).strip("_")


def clean_names(df: DataFrame, prefixes: Sequence[str] = ("num__", "cat__")) -> DataFrame:
    def bare(name: str) -> str:
        for p in prefixes:
            name = name.removeprefix(p)
        return clean_name(name)

    return df.toDF(*[bare(c) for c in df.columns])


def columns_of_kind(df: DataFrame, kind: str) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, KINDS[kind])]


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"not in the table: {missing}")
    return df.drop(*columns)


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """One aggregate row of non-null counts decides which columns stay."""
    filled = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if filled[c] > 0])


def unpivot_row(row: DataFrame, names: Sequence[str], fields: Sequence[str], key: str = "column") -> DataFrame:
    """Turn a one-row table with columns ``<name>__<field>`` into one row per name."""
    cells = [F.struct(F.lit(n).alias(key), *[F.col(f"{n}__{f}").alias(f) for f in fields]) for n in names]
    return row.select(F.inline(F.array(*cells)))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and share of the columns that have any."""
    columns = list(columns or df.columns)
    row = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(f"{c}__nulls") for c in columns],
        *[F.avg(F.col(c).isNull().cast("double")).alias(f"{c}__share") for c in columns],
    )
    return unpivot_row(row, columns, ["nulls", "share"]).filter("nulls > 0")


def texts_to_null(df: DataFrame, texts: Sequence[str] = ("", "NaN")) -> DataFrame:
    strings = set(columns_of_kind(df, "string"))
    return df.select(*[F.when(~F.col(c).isin(*texts), F.col(c)).alias(c) if c in strings else F.col(c) for c in df.columns])


def fill_by_kind(df: DataFrame, string: str = "Unknown", number: float = 0) -> DataFrame:
    strings, numbers = set(columns_of_kind(df, "string")), set(columns_of_kind(df, "numeric"))

    def fill(field: T.StructField) -> Column:
        c = F.col(field.name)
        if field.name in strings:
            return F.coalesce(c, F.lit(string)).alias(field.name)
        if field.name in numbers:
            return F.coalesce(c, F.lit(number).cast(field.dataType)).alias(field.name)
        return c

    return df.select(*[fill(f) for f in df.schema.fields])


def fill_median(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    medians = quantile_values(df, columns, {"p50": 0.5})
    return df.select(
        *[F.coalesce(F.col(c), F.lit(medians[f"{c}_p50"])).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def keep_between_quantiles(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    q = quantile_values(df, [column], {"low": low, "high": high})
    return df.filter((F.col(column) >= q[f"{column}_low"]) & (F.col(column) <= q[f"{column}_high"]))


def map_values(df: DataFrame, column: str, mapping: Mapping, default=None, strict: bool = False, out: str | None = None) -> DataFrame:
    """Look values up in a small literal map; ``strict`` stops on a value the map lacks."""
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    mapped = F.create_map(*pairs)[F.col(column)]
    if strict:
        mapped = F.when(F.col(column).isNull() | F.col(column).isin(*mapping), mapped).otherwise(
            F.raise_error(F.concat(F.lit("no mapping for "), F.col(column).cast("string")))
        )
    elif default is not None:
        mapped = F.coalesce(mapped, F.lit(default))
    return df.withColumn(out or column, mapped)


INTEGER_LADDER = ((T.ByteType(), 7), (T.ShortType(), 15), (T.IntegerType(), 31))


def narrow_integers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast each column to the smallest signed type that holds its minimum and maximum."""
    ends = df.agg(*[F.min(c).alias(f"lo_{c}") for c in columns], *[F.max(c).alias(f"hi_{c}") for c in columns]).first()
    out = df
    for c in columns:
        low, high = ends[f"lo_{c}"], ends[f"hi_{c}"]
        for kind, bits in INTEGER_LADDER:
            if low is not None and -(2**bits) <= low and high < 2**bits:
                out = out.withColumn(c, F.col(c).cast(kind))
                break
    return out


def keep_first(df: DataFrame, subset: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row (by ``order``) of every group of equal ``subset`` values.

    An aggregate, so copies of one hot row are folded before the shuffle. The group key that
    travels is a digest of the subset.
    """
    digest = F.sha2(F.to_json(F.struct(*subset), {"ignoreNullFields": "false"}), 256)
    rest = [c for c in df.columns if c not in order]
    first = df.groupBy(digest.alias("_digest")).agg(
        F.min_by(F.struct(*order, *rest), F.struct(*order)).alias("_row")
    )
    return first.select(*[F.col("_row")[c].alias(c) for c in df.columns])


def duplicate_members(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Every row whose ``subset`` values occur more than once."""
    digest = F.sha2(F.to_json(F.struct(*subset), {"ignoreNullFields": "false"}), 256)
    marked = df.withColumn("_digest", digest)
    repeated = marked.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return marked.join(repeated.select("_digest"), "_digest", "left_semi").drop("_digest")


def range_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    row = df.agg(
        *[F.min(c).cast("double").alias(f"{c}__low") for c in columns],
        *[F.max(c).cast("double").alias(f"{c}__high") for c in columns],
    )
    table = unpivot_row(row, columns, ["low", "high"])
    return table.select(
        "column", "low", "high", ((F.col("low") + F.col("high")) / 2).alias("mid"), ((F.col("high") - F.col("low")) / 2).alias("half_range")
    )


def nonzero_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    row = df.agg(*[F.avg((F.col(c) != 0).cast("double")).alias(f"{c}__share") for c in columns])
    return unpivot_row(row, columns, ["share"])


def longest_values(df: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """Per string column the first (by ``order``) value of the greatest byte length."""
    row = df.agg(
        *[F.max_by(c, F.struct(F.octet_length(c), -F.col(order))).alias(f"{c}__value") for c in columns],
        *[F.max(F.octet_length(c)).alias(f"{c}__bytes") for c in columns],
    )
    return unpivot_row(row, columns, ["value", "bytes"])
