import datetime
import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.operators import rolling
from lodestat.operators import windows as Wn


def test_order_statistics_of_any_range():
    draw = np.random.default_rng(1)
    for n, top in ((1, 1), (50, 1), (300, 7), (500, 500), (257, 10**6)):
        ranks = draw.integers(0, top, n)
        matrix = rolling.WaveletMatrix(ranks)
        low = draw.integers(0, n, 400)
        high = np.minimum(n, low + 1 + draw.integers(0, n, 400))
        k = (draw.random(400) * (high - low)).astype(int)
        found = matrix.smallest(low, high, k)
        assert all(f == sorted(ranks[a:b])[i] for f, a, b, i in zip(found, low, high, k, strict=True))


def plain(rows, hours):
    """(sum, median, count) per row and look-back by listing every frame."""
    out = {}
    for i, user, ts, value in rows:
        for h in hours:
            reach = datetime.timedelta(hours=h)
            if ts is None:
                frame = [v for _, u, t, v in rows if u == user and t is None and v is not None]
            else:
                frame = [v for _, u, t, v in rows if u == user and t is not None and ts - reach < t <= ts and v is not None]
            if any(math.isnan(v) for v in frame):
                ordered = sorted(frame, key=lambda v: (math.isnan(v), v))
                n = len(ordered)
                a, b = ordered[(n - 1) // 2], ordered[n // 2]
                middle = a if a == b else a + (b - a) * 0.5
            else:
                middle = statistics.median(frame) if frame else None
            out[i, h] = (sum(frame) if frame else None, middle, len(frame))
    return out


def odd_events(n=900):
    draw = random.Random(2)
    start = datetime.datetime(2024, 3, 1)
    rows = []
    for i in range(n):
        user = draw.choice([1, 1, 1, 1, 2, 3, None, 4 + i])
        ts = start + datetime.timedelta(minutes=draw.choice([draw.randrange(60 * 24 * 40), 60 * draw.randrange(50)]))
        rows.append((i, user, None if draw.random() < 0.02 else ts, draw.choice([None, float(draw.randrange(5)), round(draw.random() * 100, 2), 1e9])))
    return rows


@pytest.mark.parametrize("chunk", [1, 16, 1 << 16])
def test_frames_against_brute_force(spark, monkeypatch, chunk):
    """Ties, nulls in every column, a hot account and chunks that end anywhere."""
    monkeypatch.setattr(rolling, "CHUNK", chunk)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10" if chunk < 100 else "10000")
    try:
        rows, hours = odd_events(), [1, 24, 168]
        table = spark.createDataFrame(rows, "event_id int, user int, ts timestamp_ntz, value double").withColumn("_first", F.lit("kept"))
        made = Wn.rolling_amounts(table.withColumnRenamed("_first", "note"), "user", "ts", "value", hours).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = plain(rows, hours)
    assert len(made) == len(rows)
    for r in made:
        assert r["note"] == "kept"
        for h in hours:
            total, median, count = want[r["event_id"], h]
            assert r[f"count_{h}h"] == count
            assert (r[f"sum_{h}h"] is None) == (total is None) and (total is None or math.isclose(r[f"sum_{h}h"], total, rel_tol=1e-12, abs_tol=1e-4))
            assert (r[f"median_{h}h"] is None) == (median is None) and (median is None or math.isclose(r[f"median_{h}h"], median, rel_tol=1e-12))


def test_values_that_are_no_numbers(spark):
    start = datetime.datetime(2024, 3, 1)
    values = [1.0, math.inf, 2.0, -math.inf, math.nan, 3.0, 4.0, 5.0]
    rows = [(i, 1, start + datetime.timedelta(hours=i), v) for i, v in enumerate(values)]
    made = {r["event_id"]: r for r in Wn.rolling_amounts(spark.createDataFrame(rows, "event_id int, user int, ts timestamp_ntz, value double"), "user", "ts", "value", [2]).collect()}
    sums = [made[i]["sum_2h"] for i in range(8)]
    assert sums[0] == 1 and sums[1] == math.inf and sums[2] == math.inf and sums[3] == -math.inf and math.isnan(sums[4]) and math.isnan(sums[5]) and sums[6:] == [7, 9]
    assert [made[i]["median_2h"] for i in (0, 6, 7)] == [1, 3.5, 4.5]


def test_no_rows(spark):
    assert Wn.rolling_amounts(spark.createDataFrame([], "event_id int, user int, ts timestamp_ntz, value double"), "user", "ts", "value", [1, 24]).collect() == []


def test_cost_does_not_follow_the_frame():
    """The steps of a median are the bits of the values' ranks, whatever the frame."""
    import time

    draw = np.random.default_rng(3)
    n = 40_000
    us, group, values = np.arange(n, dtype=np.int64), np.zeros(n, np.int64), draw.random(n)
    took = []
    for reach in (10, 20_000):
        start = time.perf_counter()
        rolling.frame_statistics(us, group, values, np.ones(n, bool), [reach] * 5, np.ones(n, bool))
        took.append(time.perf_counter() - start)
    assert took[1] < 5 * took[0]


def test_what_is_carried_along_goes_out_in_pieces(spark, monkeypatch):
    """A chunk's rows leave the task in small batches, with no second copy of their columns."""
    import pyarrow as pa

    caught = []
    table = spark.createDataFrame([], "event_id int, user int, ts timestamp_ntz, value double")
    monkeypatch.setattr(type(table), "mapInArrow", lambda self, run, schema: caught.append(run) or self)
    rolling.rolling_statistics(table.withColumn("_us", F.lit(1)).withColumn("_own", F.lit(True)), ["user"], "value", {"1h": 1})
    n = 20_000
    rows = pa.RecordBatch.from_pydict({
        "event_id": np.arange(n), "user": np.ones(n, np.int32), "ts": np.arange(n), "value": np.ones(n), "_us": np.arange(n), "_own": np.arange(n) % 3 > 0, "_first": np.arange(n) == 0,
    })
    out = list(caught[0](iter([rows])))
    assert max(b.num_rows for b in out) <= 1 << 12
    assert np.concatenate([b.column("event_id") for b in out]).tolist() == [i for i in range(n) if i % 3]
