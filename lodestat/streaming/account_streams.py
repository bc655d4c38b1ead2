"""Streaming forms of the account features, on Structured Streaming."""

from __future__ import annotations

import json
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lodestat.sources.writers import scratch_folder


def read_events(spark: SparkSession, path: str, schema: T.StructType, ts: str = "ts", max_files: int | None = None) -> DataFrame:
    """Parquet files as a stream, event time as a timestamp fit for watermarks; ``max_files`` sets the size of a micro-batch."""
    reader = spark.readStream.schema(schema)
    reader = reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).withColumn(ts, F.col(ts).cast("timestamp"))


def window_amounts(stream: DataFrame, ts: str, keys: list[str], amount: str, length: str, slide: str | None = None, late: str = "1 hour") -> DataFrame:
    """Sum and count per key and tumbling or sliding window; rows later than the watermark are dropped."""
    w = F.window(ts, length, slide) if slide else F.window(ts, length)
    sums = stream.withWatermark(ts, late).groupBy(w.alias("w"), *keys).agg(F.sum(amount).alias("total"), F.count(F.lit(1)).alias("n"))
    return sums.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "total", "n")


def sessions(stream: DataFrame, ts: str, account: str, gap: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Runs of an account's events with no pause of ``gap``."""
    s = stream.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), account).agg(F.count(F.lit(1)).alias("n"))
    return s.select(account, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def multi_swipe(stream: DataFrame, ts: str, account: str, event: str, kind: str, band: str, seconds: float, late: str = "1 hour", idle: str = "2 days") -> DataFrame:
    """Flag an event that repeats the account's previous event within some seconds; for update mode.

    Events may come late by up to ``late``. The state of an account is its events within that delay and the last
    one before, in order of time, equal times by event id. A batch puts its events in their places and gives the flags of these
    events and of those that follow them, so a flag that a late event changes comes out again: the newest row of an event holds.
    An account idle in event time for ``idle`` loses its state.
    """
    output = f"{event} long, {account} long, flag int"

    def flag(key: tuple, batches: Iterable[pd.DataFrame], held: GroupState) -> Iterable[pd.DataFrame]:
        if held.hasTimedOut:
            held.remove()
            return
        known = json.loads(held.get[0]) if held.exists else []
        seen = {e[1] for e in known}
        columns = ["_at", event, "_kind", "_band"]
        fresh = [tuple(e) for b in batches for e in b[columns].astype(object).itertuples(index=False, name=None) if e[1] not in seen]
        new = {int(e[1]) for e in fresh}
        line = sorted({(float(at), int(i), k, None if pd.isna(v) else int(v)) for at, i, k, v in [*map(tuple, known), *fresh]}, key=lambda e: e[:2])
        flags = []
        for i, (at, number, k, v) in enumerate(line):
            before = line[i - 1] if i else None
            if number in new or (before and before[1] in new):
                same = before is not None and k is not None and v is not None and (before[2], before[3]) == (k, v)
                flags.append((number, key[0], int(same and at - before[0] <= seconds)))
        now = held.getCurrentWatermarkMs()
        passed = sum(e[0] * 1000 < now for e in line)
        held.update((json.dumps(line[max(0, passed - 1) :]),))
        held.setTimeoutTimestamp(max(now + 1, int(line[-1][0] * 1000) + int(pd.Timedelta(idle).total_seconds() * 1000)))
        yield pd.DataFrame(flags, columns=[event, account, "flag"]).astype({event: "int64", "flag": "int32"})

    prepared = stream.withWatermark(ts, late).select(
        event, account, ts, (F.unix_micros(ts) / 1e6).alias("_at"), F.col(kind).alias("_kind"), F.col(band).cast("long").alias("_band")
    )
    return prepared.groupBy(account).applyInPandasWithState(flag, output, "line string", "update", GroupStateTimeout.EventTimeTimeout)


class _SwipeSlice(StatefulProcessor):
    """Holds the events of a bucket of accounts and a time slice until the watermark has passed the slice's end, then flags them and forgets them."""

    def __init__(self, names: tuple[str, str], seconds: float):
        self.names, self.seconds = names, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.events = handle.getListState("events", "account long, none boolean, number long, at long, kind string, band long, own boolean")

    def handleInputRows(self, key, rows, timerValues):
        for part in rows:
            # (names may not start with an underscore here)
            cells = part[["swipe_account", "swipe_none", "swipe_number", "swipe_at", "swipe_kind", "swipe_band", "swipe_own"]].astype(object)
            cells = cells.where(cells.notna(), None)
            self.events.appendList([(int(a), bool(none), int(n), int(at), k, None if b is None else int(b), bool(own)) for a, none, n, at, k, b, own in cells.itertuples(index=False, name=None)])
            self.handle.registerTimer(int(part["swipe_end"].iloc[0]))  # the same in every row; set again without effect
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        columns = ["account", "none", "number", "at", "kind", "band", "own"]
        held = pd.DataFrame(list(self.events.get()), columns=columns).astype({"band": "Int64"}).drop_duplicates()
        self.events.clear()
        held = held.sort_values(["none", "account", "at", "number"], ignore_index=True)
        same = (held["account"] == held["account"].shift()) & (held["none"] == held["none"].shift())
        same &= (held["kind"] == held["kind"].shift()) & (held["band"] == held["band"].shift()).fillna(False).astype(bool)
        flag = same & held["kind"].notna() & (held["at"] - held["at"].shift() <= self.seconds * 1e6)
        event, account = self.names
        out = pd.DataFrame({event: held["number"].astype("int64"), account: held["account"].astype("Int64").mask(held["none"].astype(bool)), "flag": flag.astype("int32")})[held["own"].astype(bool)]
        if len(out):
            yield out

    def close(self) -> None:
        pass


def multi_swipe_once(stream: DataFrame, ts: str, account: str, event: str, kind: str, band: str, seconds: float, slice_seconds: int = 86_400, late: str = "1 hour", buckets: int = 64) -> DataFrame:
    """The flags of ``multi_swipe``, each given out once and for good; for append mode and a RocksDB state store (``run_stateful``).

    Time is cut into slices of ``slice_seconds`` (at least ``seconds``). An event goes to its slice and, if it stands within ``seconds`` of
    the end, to the next one as context: no flag looks further back. State is a list of events for a slice and one of ``buckets`` parts of the accounts, by a hash, to which a
    micro-batch only appends; a timer at the slice's end sorts the list once, gives its flags and clears it. So a call of Python serves
    many accounts, a key more makes no list more (``buckets`` may not change between runs on one state), and an account with a
    third of all events is spread over its slices, state lives for a slice and the delay ``late``, and events may
    come in any order within that delay. Repeats of an event count once; equal times go by event id; a null account is an account;
    events without id or time are left out, and a null kind or band equals nothing. Events of slices that the watermark hasn't passed stay in the state for the next run.
    """
    if slice_seconds < seconds:
        raise ValueError("a slice must be as long as the pause of a flag")
    at = F.unix_micros(ts)
    length, reach = int(slice_seconds * 1_000_000), int(seconds * 1_000_000)
    here = F.floor(F.col("swipe_at") / length)
    prepared = stream.withWatermark(ts, late).where(F.col(event).isNotNull() & F.col(ts).isNotNull())
    prepared = prepared.select(
        # keys without nulls: a null in the key of a timer would end the reading of expired timers
        F.coalesce(F.col(account).cast("long"), F.lit(0)).alias("swipe_account"), F.col(account).isNull().alias("swipe_none"), ts, F.col(event).cast("long").alias("swipe_number"), at.alias("swipe_at"), F.col(kind).alias("swipe_kind"), F.col(band).cast("long").alias("swipe_band")
    )
    prepared = prepared.withColumn("swipe_bucket", F.pmod(F.xxhash64("swipe_account", "swipe_none"), F.lit(buckets)))
    into_next = F.col("swipe_at") + reach >= (here + 1) * length
    prepared = prepared.withColumn("swipe_places", F.when(into_next, F.array(here, here + 1)).otherwise(F.array(here)))
    prepared = prepared.select("*", F.posexplode("swipe_places").alias("swipe_copy", "swipe_slice")).drop("swipe_places")
    prepared = prepared.select("*", (F.col("swipe_copy") == 0).alias("swipe_own"), F.floor((F.col("swipe_slice") + 1) * length / 1000).alias("swipe_end")).drop("swipe_copy")
    return prepared.groupBy("swipe_bucket", "swipe_slice").transformWithStateInPandas(
        _SwipeSlice((event, account), seconds), f"{event} long, {account} long, flag int", "append", "EventTime"
    )


def posterior(stream: DataFrame, arm: str, success: Column, alpha: float = 1.0, beta: float = 1.0) -> DataFrame:
    """Running Beta parameters per arm."""
    counts = stream.groupBy(arm).agg(F.count_if(success).alias("s"), F.count(F.lit(1)).alias("n"))
    return counts.select(arm, (F.col("s") + alpha).alias("a"), (F.col("n") - F.col("s") + beta).alias("b"))


def dedupe(stream: DataFrame, ts: str, ids: list[str], late: str = "1 hour") -> DataFrame:
    """Drop repeats of an id that arrive within the watermark delay."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(ids)


def run_available(stream: DataFrame, label: str) -> DataFrame:
    """Process what is there into Parquet (append mode) and read the result."""
    folder = scratch_folder(stream.sparkSession, label)
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True).start(f"{folder}/rows")
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/rows")


def run_stateful(stream: DataFrame, label: str) -> DataFrame:
    """``run_available`` with the state store that list state and timers need; the session's own setting comes back after."""
    conf, name = stream.sparkSession.conf, "spark.sql.streaming.stateStore.providerClass"
    before = conf.get(name)
    conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        return run_available(stream, label)
    finally:
        conf.set(name, before)


def run_updates(stream: DataFrame, label: str, keys: list[str]) -> DataFrame:
    """Process what is there in update mode; the newest row of every key is the result, open windows included."""
    rows = _batches(stream, label, "update")
    rest = [c for c in stream.columns if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_r"))
    return last.select(*keys, "_r.*").select(*stream.columns)


def run_complete(stream: DataFrame, label: str) -> DataFrame:
    """Process what is there in complete mode; the last batch is the result, open sessions included."""
    rows = _batches(stream, label, "complete")
    return rows.filter(F.col("_batch") == rows.agg(F.max("_batch")).scalar()).select(*stream.columns)


def _batches(stream: DataFrame, label: str, mode: str) -> DataFrame:
    folder = scratch_folder(stream.sparkSession, label)
    numbers: list[int] = []

    def keep(batch: DataFrame, number: int) -> None:
        numbers.append(number)
        batch.withColumn("_batch", F.lit(number)).write.mode("overwrite").parquet(f"{folder}/rows/{number}")

    query = (
        stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state").foreachBatch(keep)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    schema = T.StructType([*stream.schema.fields, T.StructField("_batch", T.IntegerType())])
    if not numbers:
        return stream.sparkSession.createDataFrame([], schema)
    return stream.sparkSession.read.schema(schema).parquet(*(f"{folder}/rows/{n}" for n in numbers))
