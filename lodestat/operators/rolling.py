"""Sums, counts and medians of many look-back frames in one pass over rows in time order.

A stream of rows sorted by group and time is worked off in chunks. A chunk holds its own rows and, of the rows before
them, those a frame can still see. Counts and sums are differences of running totals; medians are read from a wavelet matrix
over the value ranks, so a row costs the same steps whether its frame holds ten rows or a million.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = 1 << 16
PIECE = 1 << 12  # rows of a batch that goes out
NO_TIME = np.iinfo(np.int64).min // 4


class WaveletMatrix:
    """Order statistics of any range of a fixed sequence of ranks (0..): one stable partition per bit, highest first."""

    def __init__(self, ranks: np.ndarray):
        self.bits = max(1, int(ranks.max(initial=0)).bit_length())
        self.zeros: list[np.ndarray] = []
        row = ranks
        for bit in range(self.bits - 1, -1, -1):
            one = (row >> bit & 1).astype(bool)
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]))
            row = np.concatenate([row[~one], row[one]])

    def smallest(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The rank at place ``k`` (from 0) of each sorted range [low, high); k must be inside."""
        low, high, k, found = low.copy(), high.copy(), k.copy(), np.zeros_like(k)
        for zeros in self.zeros:
            low_zero, high_zero = zeros[low], zeros[high]
            ones = k >= high_zero - low_zero
            k = np.where(ones, k - (high_zero - low_zero), k)
            low = np.where(ones, zeros[-1] + low - low_zero, low_zero)
            high = np.where(ones, zeros[-1] + high - high_zero, high_zero)
            found = found * 2 + ones
        return found


def frame_starts(us: np.ndarray, group: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """[start, end) of the rows of the group in (t - reach, t], peers of t included, for rows sorted by group and time."""
    n = len(us)
    edges = np.flatnonzero(np.diff(group)) + 1
    firsts, lasts = np.concatenate([[0], edges]), np.concatenate([edges, [n]])
    # times of successive groups are moved apart, so that one search serves all
    base = np.repeat(us[firsts], lasts - firsts)
    length = us[lasts - 1] - us[firsts] + reach + 1
    moved = us - base + np.repeat(np.concatenate([[0], np.cumsum(length)[:-1]]), lasts - firsts)
    start = np.searchsorted(moved, moved - reach, "right")
    first = np.repeat(firsts, lasts - firsts)
    return np.maximum(start, first), np.searchsorted(moved, moved, "right")


def _sums(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(np.where(np.isfinite(values), values, 0.0))])
    out = total[end] - total[start]
    if not np.isfinite(values).all():
        held = {x: np.concatenate([[0], np.cumsum(match)]) for x, match in ((np.inf, values == np.inf), (-np.inf, values == -np.inf), (np.nan, np.isnan(values)))}
        up, down, none = (h[end] - h[start] > 0 for h in held.values())
        out = np.where(up, np.inf, np.where(down, -np.inf, out))
        out = np.where(none | (up & down), np.nan, out)
    return out


def frame_statistics(us: np.ndarray, group: np.ndarray, values: np.ndarray, known: np.ndarray, reaches: Sequence[int], own: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(sum, median, count) of the known values in every frame of each reach, for the rows marked ``own``."""
    place = np.concatenate([[0], np.cumsum(known)])
    held = values[known]
    sorted_values, ranks = np.unique(held, return_inverse=True)
    matrix = WaveletMatrix(ranks.astype(np.int64))
    out = []
    for reach in reaches:
        start, end = frame_starts(us, group, reach)
        start, end = place[start[own]], place[end[own]]
        count = end - start
        some = count > 0
        median = np.full(len(count), np.nan)
        if some.any():
            low, high, n = start[some], end[some], count[some]
            left = sorted_values[matrix.smallest(low, high, (n - 1) // 2)]
            right = sorted_values[matrix.smallest(low, high, n // 2)]
            with np.errstate(invalid="ignore"):
                median[some] = np.where(left == right, left, left + (right - left) * 0.5)
        out.append((_sums(held, start, end), median, count))
    return out


def rolling_statistics(df: DataFrame, keys: Sequence[str], amount: str, reaches: dict[str, int], prefix: str = "", own: str = "_own", time: str = "_us") -> DataFrame:
    """Add ``prefix`` sum_, median_ and count_ of ``amount`` over (t - reach, t] inside ``keys`` for every named reach, rows with ``own`` only.

    One exchange by ``keys``; a group streams through its task in time order, and what a task holds follows the
    longest frame, not the group. Null amounts count for nothing; a frame without an amount has null sum and median and
    count 0; rows without a time are each other's peers. NaN is the largest value, as in sorting.
    """
    inside = Window.partitionBy(*keys).orderBy(F.col(time).asc_nulls_first())
    ready = df.withColumn("_first", F.row_number().over(inside) == 1)
    names, longest = list(reaches), max(reaches.values())
    kept = [f for f in df.schema.fields if f.name not in (own, time)]
    made = [T.StructField(f"{prefix}{kind}_{name}", T.LongType() if kind == "count" else T.DoubleType()) for name in names for kind in ("sum", "median", "count")]
    schema = T.StructType([*(T.StructField(f.name, f.dataType, True) for f in kept), *made])
    columns = [f.name for f in kept]

    def worked(table: pa.Table, times: np.ndarray, group: np.ndarray, fresh: int) -> Iterator[pa.RecordBatch]:
        """Results for the rows from ``fresh`` on, in pieces: what is only carried along is never held a second time."""
        mine = table.column(own).to_numpy(zero_copy_only=False).astype(bool)
        mine[:fresh] = False
        if not mine.any():
            return
        column = table.column(amount).combine_chunks()
        known = np.asarray(column.is_valid())
        values = column.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
        found = frame_statistics(times, group, values, known, [reaches[x] for x in names], mine)
        row, done = 0, 0
        for piece in table.select(columns).to_batches(max_chunksize=PIECE):
            wanted = mine[row : row + piece.num_rows]
            row, n = row + piece.num_rows, int(wanted.sum())
            if n:
                out = piece.filter(pa.array(wanted)).columns
                for total, median, count in found:
                    total, median, count = (x[done : done + n] for x in (total, median, count))
                    out += [pa.array(total, mask=count == 0), pa.array(median, mask=count == 0), pa.array(count.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(out, names=[*columns, *(f.name for f in made)])
                done += n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, context = [], 0  # rows in hand; how many of them were worked off and are context only

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal waiting, context
            table = pa.Table.from_batches(waiting)
            times = table.column(time).combine_chunks().cast(pa.int64()).fill_null(NO_TIME).to_numpy(zero_copy_only=False)
            group = np.cumsum(table.column("_first").to_numpy(zero_copy_only=False).astype(np.int64))
            cut = len(times)
            if not last:  # the rows at the last time may have peers still to come
                cut = int(np.flatnonzero((group == group[-1]) & (times == times[-1]))[0])
                if cut <= context:
                    waiting = table.to_batches()
                    return
            yield from worked(table.slice(0, cut), times[:cut], group[:cut], context)
            if not last:
                seen = int(np.searchsorted(times[group == group[-1]], times[-1] - longest, "right")) + int((group < group[-1]).sum())
                seen = min(seen, cut)
                waiting, context = table.slice(seen).to_batches(), cut - seen

        rows = 0
        for batch in batches:
            if batch.num_rows:
                waiting.append(batch)
                rows += batch.num_rows
                if rows >= max(CHUNK, context):
                    yield from flush(False)
                    rows = 0
        if waiting:
            yield from flush(True)

    return ready.mapInArrow(run, schema)
