"""Running totals, ranks, lags and carried values over orders of any size.

A window without a partition key, or with a key that holds a large share of the rows, sorts
all of those rows in one task. The functions here deal rows out by ranges of (keys, order), so a
slice holds about 1/parts of the table, whatever the keys look like; they work inside (key, slice)
groups and add what the earlier slices of the key hand over. The slices are written to the shared folder
once: the input is computed once, and both the rows and the hand-over values read the written table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestat.session import checkpointed

SLICE = "_slice"


def slice_count(df: DataFrame) -> int:
    """As many slices as the session has shuffle partitions, the setting that follows the data's size; 8 at least."""
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def sliced(df: DataFrame, order: Sequence[Column | str], parts: int | None = None) -> DataFrame:
    """Write ``df`` with ``_slice``, a number that never falls along ``order``. Rows equal in ``order`` share a slice."""
    dealt = df.repartitionByRange(parts or slice_count(df), *order)
    return checkpointed(dealt.withColumn(SLICE, F.spark_partition_id()))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _of(keys: Sequence[str]) -> Window:
    """Window over the keys of a table with a row per (key, slice)."""
    return Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))


def _hand_over(rows: DataFrame, carried: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Bind the per-(key, slice) hand-over values to the rows."""
    left, right = rows.alias("rows_"), carried.alias("carried_")
    on = _same(F.col(f"rows_.{SLICE}"), F.col(f"carried_.{SLICE}"))
    for k in keys:
        on = on & _same(F.col(f"rows_.{k}"), F.col(f"carried_.{k}"))
    extra = [c for c in carried.columns if c not in (*keys, SLICE)]
    joined = left.join(right, on, "left")
    return joined.select("rows_.*", *[F.col(f"carried_.{c}") for c in extra])


def running_totals(
    df: DataFrame,
    order: str,
    measures: Sequence[str],
    keys: Sequence[str] = (),
    parts: int | None = None,
    descending: bool = False,
) -> DataFrame:
    """Add ``cum_<measure>``: the sum of the measure over rows of the key up to and with this one.

    ``df`` should have one row per (keys, order), so group by the order column first; equal order
    values would be peers and share a total.
    """
    keys = list(keys)
    table = sliced(df, [*keys, order], parts)
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    inside = (
        Window.partitionBy(*keys, SLICE)
        .orderBy(direction(order))
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = table.select("*", *[F.sum(m).over(inside).alias(f"_in_{m}") for m in measures])
    totals = table.groupBy(*keys, SLICE).agg(*[F.sum(m).alias(f"_tot_{m}") for m in measures])
    earlier = _of(keys).orderBy(direction(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(*keys, SLICE, *[F.sum(f"_tot_{m}").over(earlier).alias(f"_before_{m}") for m in measures])
    joined = _hand_over(rows, carried, keys)
    return joined.select(
        *df.columns,
        *[(F.col(f"_in_{m}") + F.coalesce(F.col(f"_before_{m}"), F.lit(0))).alias(f"cum_{m}") for m in measures],
    )


def previous_row(
    df: DataFrame, order: str, fields: dict[str, str], keys: Sequence[str] = (), parts: int | None = None, tie: str | None = None
) -> DataFrame:
    """Add ``fields[new] = column`` of the row just before this one in the key's order.

    ``order`` must be unique inside the key, or ``tie`` must tell equal values apart.
    """
    keys, by = list(keys), [order] if tie is None else [order, tie]
    table = sliced(df, [*keys, *by], parts)
    state = F.struct(*[F.col(c).alias(new) for new, c in fields.items()])
    inside = Window.partitionBy(*keys, SLICE).orderBy(*by)
    rows = table.withColumn("_lag", F.lag(state).over(inside))
    ends = table.groupBy(*keys, SLICE).agg(F.max_by(state, F.struct(*by)).alias("_end"))
    across = _of(keys).orderBy(SLICE)
    carried = ends.select(*keys, SLICE, F.lag("_end").over(across).alias("_carry"))
    joined = _hand_over(rows, carried, keys).withColumn("_prev", F.coalesce("_lag", "_carry"))
    return joined.select(*df.columns, *[F.col("_prev")[new].alias(new) for new in fields])


def carry_forward(
    df: DataFrame, order: str, columns: Sequence[str], keys: Sequence[str] = (), parts: int | None = None
) -> DataFrame:
    """Replace nulls by the last non-null value before them in the key's order."""
    keys = list(keys)
    table = sliced(df, [*keys, order], parts)
    inside = Window.partitionBy(*keys, SLICE).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = table.select("*", *[F.last(c, ignorenulls=True).over(inside).alias(f"_in_{c}") for c in columns])
    ends = table.groupBy(*keys, SLICE).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_end_{c}") for c in columns]
    )
    across = _of(keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, SLICE, *[F.last(f"_end_{c}", True).over(across).alias(f"_carry_{c}") for c in columns])
    joined = _hand_over(rows, carried, keys)
    return joined.select(
        *[F.coalesce(f"_in_{c}", f"_carry_{c}").alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def _numbered(df: DataFrame, order: Sequence[Column], keys: Sequence[str], name: str) -> DataFrame:
    """Row numbers inside the key; a hot key and a hot value are cut into slices alike."""
    keys = list(keys)
    table = sliced(df, [*keys, *order])
    rows = table.withColumn("_in", F.row_number().over(Window.partitionBy(*keys, SLICE).orderBy(*order)))
    earlier = _of(keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    totals = table.groupBy(*keys, SLICE).agg(F.count(F.lit(1)).alias("_tot"))
    carried = totals.select(*keys, SLICE, F.sum("_tot").over(earlier).alias("_before"))
    number = F.col("_in") + F.coalesce(F.col("_before"), F.lit(0))
    return _hand_over(rows, carried, keys).select(*df.columns, number.cast("long").alias(name))


def row_numbers(
    df: DataFrame,
    value: str,
    tie: str,
    keys: Sequence[str] = (),
    name: str = "row_number",
    descending: bool = False,
) -> DataFrame:
    """Add the 1-based row number inside the key by ``value``, equal values by ascending ``tie``."""
    return _numbered(df, [F.col(value).desc() if descending else F.col(value).asc(), F.col(tie).asc()], keys, name)


def hash_key(*columns: str, seed: int = 42) -> Column:
    """A text hash with an even spread and the same value in every SQL engine."""
    return F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in columns], F.lit(str(seed))))


def hash_row_numbers(df: DataFrame, ids: Sequence[str], keys: Sequence[str] = (), seed: int = 42, name: str = "row_number") -> DataFrame:
    """Row number inside the key in hash order of the ids, a repeatable shuffle."""
    hashed = df.withColumn("_hash", hash_key(*ids, seed=seed))
    return _numbered(hashed, [F.col("_hash").asc()], keys, name).drop("_hash")


def ntile_from_rank(rank: Column, total: Column, tiles: int) -> Column:
    """The NTILE number of a 1-based rank: the first ``total % tiles`` tiles hold one more row."""
    size = F.floor(total / tiles)
    extra = total % tiles
    wide = extra * (size + 1)
    return F.when(rank <= wide, F.floor((rank - 1) / (size + 1)) + 1).otherwise(
        extra + F.floor((rank - 1 - wide) / F.greatest(size, F.lit(1))) + 1
    ).cast("int")
