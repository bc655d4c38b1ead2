"""Streams fed file by file, late events included, against the whole table at once."""

import datetime

import pandas as pd
import pytest
from pyspark.sql import types as T

from lodestat.sources.writers import scratch_folder
from lodestat.streaming import account_streams as A

KINDS = {"event_id": T.LongType(), "user_id": T.LongType(), "ts": T.TimestampType(), "kind": T.StringType(), "band": T.LongType(), "value": T.DoubleType()}
SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in KINDS.items()])
START = datetime.datetime(2024, 1, 1)


def event(number, user, minutes, kind="buy", band=1):
    return (number, user, START + datetime.timedelta(minutes=minutes), kind, band, float(number))


#: The second and third file bring events that come before events of the first; some times are equal.
FILES = [
    [event(1, 1, 0), event(2, 1, 50), event(3, 2, 10), event(4, 2, 10)],
    [event(5, 1, 25), event(6, 1, 55), event(7, 2, 5), event(8, 2, 10, "look")],
    [event(9, 1, 52, "look"), event(10, 1, 20), event(11, 2, 90), event(12, 2, 99), event(13, 1, 56, band=None)],
]


def expected(seconds):
    rows = pd.DataFrame([e for f in FILES for e in f], columns=[f.name for f in SCHEMA.fields]).sort_values(["user_id", "ts", "event_id"])
    out = {}
    for _, own in rows.groupby("user_id"):
        own = list(own.itertuples(index=False))
        for before, now in zip([None, *own], own, strict=False):
            same = before is not None and before.kind == now.kind and before.band == now.band and (now.ts - before.ts).total_seconds() <= seconds
            out[now.event_id] = int(same)
    return out


@pytest.fixture
def stream(spark):
    folder = scratch_folder(spark, "stream-test")
    for rows in FILES:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return lambda: A.read_events(spark, folder, SCHEMA, max_files=1)


@pytest.mark.parametrize("minutes", [3, 10, 30])
def test_late_events_find_their_places(stream, minutes):
    flags = A.multi_swipe(stream(), "ts", "user_id", "event_id", "kind", "band", minutes * 60, late="3 hours")
    got = {r["event_id"]: r["flag"] for r in A.run_updates(flags, "swipes", ["event_id"]).collect()}
    assert got == expected(minutes * 60)


def test_open_windows_and_sessions_come_out(stream):
    w = A.run_updates(A.window_amounts(stream(), "ts", ["user_id"], "value", "1 hour", late="3 hours"), "w", ["user_id", "start", "end"])
    assert {(r["user_id"], r["start"].hour): (r["n"], r["total"]) for r in w.collect()} == {(1, 0): (7, 46.0), (2, 0): (4, 22.0), (2, 1): (2, 23.0)}
    s = A.run_complete(A.sessions(stream(), "ts", "user_id", late="3 hours"), "s")
    assert sorted((r["user_id"], r["n"]) for r in s.collect()) == [(1, 1), (1, 2), (1, 4), (2, 2), (2, 4)]


def final(seconds, slice_minutes, late_minutes):
    """The expected flags of the slices that end before the watermark after the last file."""
    rows = {e[0]: e[2] for f in FILES for e in f}
    mark = max(rows.values()) - datetime.timedelta(minutes=late_minutes)
    end = lambda ts: START + datetime.timedelta(minutes=((ts - START).total_seconds() // 60 // slice_minutes + 1) * slice_minutes)
    return {i: f for i, f in expected(seconds).items() if end(rows[i]) < mark}


@pytest.mark.parametrize("minutes, slice_minutes, late", [(3, 5, 40), (10, 10, 40), (10, 30, 40), (30, 30, 60)])
def test_flags_come_once_after_the_watermark(spark, stream, minutes, slice_minutes, late):
    """Late files, slices about as short as the pause, and the events near a slice's end as context of the next."""
    flags = A.multi_swipe_once(stream(), "ts", "user_id", "event_id", "kind", "band", minutes * 60, slice_minutes * 60, f"{late} minutes")
    rows = A.run_stateful(flags, "once").collect()
    want = final(minutes * 60, slice_minutes, late)
    assert want and len(rows) == len({r.event_id for r in rows}) and {r.event_id: r.flag for r in rows} == want


def test_one_hot_account_repeats_and_nulls(spark):
    """20 000 events of one account in one micro-batch, each delivered twice, beside nulls in every column."""
    folder = scratch_folder(spark, "hot-stream")
    hot = spark.range(20_000).selectExpr("id AS event_id", "7L AS user_id", "timestamp_seconds(1704067200 + id * 37 % 200000) AS ts", "if(id % 5 = 0, null, 'buy') AS kind", "if(id % 7 = 0, null, id % 2) AS band", "1.0D AS value")
    odd = [(None, 7, START, "buy", 1, 1.0), (90_001, None, START, "buy", 1, 1.0), (90_002, None, START, "buy", 1, 1.0), (90_003, 7, None, "buy", 1, 1.0), (90_004, 8, START + datetime.timedelta(days=9), None, None, None)]
    hot.union(hot).union(spark.createDataFrame(odd, SCHEMA)).coalesce(2).write.mode("append").parquet(folder)
    flags = A.multi_swipe_once(A.read_events(spark, folder, SCHEMA), "ts", "user_id", "event_id", "kind", "band", 60, 3600, "1 hour")
    rows = A.run_stateful(flags, "hot").toPandas()
    want = hot.toPandas().sort_values(["ts", "event_id"])
    same = (want["kind"] == want["kind"].shift()) & (want["band"] == want["band"].shift()) & want["kind"].notna() & (want["ts"].diff().dt.total_seconds() <= 60)
    got = rows[rows["user_id"] == 7].set_index("event_id")["flag"]
    assert len(got) == 20_000 and got.to_dict() == dict(zip(want["event_id"], same.astype(int), strict=True)) and 0 < got.sum() < 20_000
    assert rows[rows["user_id"].isna()].set_index("event_id")["flag"].to_dict() == {90_001: 0, 90_002: 1}
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


@pytest.mark.parametrize("buckets", [1, 3])
def test_a_bucket_serves_many_accounts(spark, monkeypatch, buckets):
    """500 accounts, one of them null and one 0, are flagged each by itself from a few lists of state."""
    rows = spark.range(6000).selectExpr("id AS event_id", "if(id % 500 = 499, null, id % 500) AS user_id", "timestamp_seconds(1704067200 + id * 7919 % 9000) AS ts", "if(id % 3 = 0, 'buy', 'view') AS kind", "id % 2 AS band", "1.0D AS value")
    folder = scratch_folder(spark, "bucket-stream")
    rows.write.mode("append").parquet(folder)
    flags = A.multi_swipe_once(A.read_events(spark, folder, SCHEMA), "ts", "user_id", "event_id", "kind", "band", 900, 3600, "0 hours", buckets)
    got = A.run_stateful(flags, "buckets").toPandas().set_index("event_id")
    want = rows.toPandas().sort_values(["user_id", "ts", "event_id"])
    before = want.groupby("user_id", dropna=False)[["ts", "kind", "band"]].shift()
    want["flag"] = ((want["kind"] == before["kind"]) & (want["band"] == before["band"]) & ((want["ts"] - before["ts"]).dt.total_seconds() <= 900)).astype(int)
    want = want[want["ts"] < want["ts"].min().floor("h") + datetime.timedelta(hours=2)].set_index("event_id")
    assert got["flag"].to_dict() == want["flag"].to_dict() and 0 < got["flag"].sum() < len(got)
    assert (got["user_id"].sort_index().astype("Int64").isna() == want["user_id"].sort_index().isna()).all()
