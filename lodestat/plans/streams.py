"""Streams over the events table; each must equal its batch counterpart."""

from pyspark.sql import functions as F

from lodestat.plans.registry import plan, r6
from lodestat.streaming import account_streams as A


def _events(t):
    return A.read_events(t.spark, f"{t.folder}/events*.parquet", t.events.schema)


def _plain(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@plan(
    "stream_window_amounts",
    """with w as (select user_id, event_type, date_trunc('day', ts)::timestamp as start, value from events)
    select user_id, event_type, start, start + interval 1 day as "end", round(sum(value), 4) as total, count(*) as n from w group by 1, 2, 3""",
)
def stream_window_amounts(t):
    w = A.window_amounts(_events(t), "ts", ["user_id", "event_type"], "value", "1 day")
    return _plain(A.run_updates(w, "windows", ["user_id", "event_type", "start", "end"]), "start", "end").withColumn("total", r6("total", 4))


@plan(
    "stream_window_sliding",
    """with w as (select event_type, date_trunc('day', ts)::timestamp + to_hours((6 * (hour(ts) // 6) - 6 * k)::integer) as start, value from events, range(0, 4) r(k))
    select event_type, start, start + interval 1 day as "end", round(sum(value), 4) as total, count(*) as n from w group by 1, 2""",
)
def stream_window_sliding(t):
    w = A.window_amounts(_events(t), "ts", ["event_type"], "value", "1 day", "6 hours")
    return _plain(A.run_updates(w, "sliding", ["event_type", "start", "end"]), "start", "end").withColumn("total", r6("total", 4))


@plan(
    "stream_session_activity",
    """with l as (select user_id, ts, case when ts - lag(ts) over (partition by user_id order by ts) < interval 10 minutes then 0 else 1 end as fresh from events),
    s as (select user_id, ts, sum(fresh) over (partition by user_id order by ts) as s from l)
    select user_id, min(ts) as start, max(ts) + interval 10 minutes as "end", count(*) as n from s group by user_id, s""",
)
def stream_session_activity(t):
    return _plain(A.run_complete(A.sessions(_events(t), "ts", "user_id"), "sessions"), "start", "end")


@plan(
    "stream_multi_swipe",
    """with e as (select *, floor(value / 20)::bigint as band from events) select event_id, user_id,
    coalesce(event_type = lag(event_type) over w and band = lag(band) over w and ts - lag(ts) over w <= interval 4 hours, false)::integer as flag from e window w as (partition by user_id order by ts, event_id)""",
)
def stream_multi_swipe(t):
    s = _events(t).withColumn("band", F.floor(F.col("value") / 20))
    return A.run_updates(A.multi_swipe(s, "ts", "user_id", "event_id", "event_type", "band", 4 * 3600), "swipes", ["event_id"])


@plan(
    "stream_multi_swipe_once",
    """with e as (select *, floor(value / 20)::bigint as band from events), f as (select event_id, user_id, ts,
    coalesce(event_type = lag(event_type) over w and band = lag(band) over w and ts - lag(ts) over w <= interval 4 hours, false)::integer as flag from e window w as (partition by user_id order by ts, event_id))
    select event_id, user_id, flag from f where date_trunc('day', ts)::timestamp + interval 1 day < (select max(ts) from events) - interval 1 hour""",
)
def stream_multi_swipe_once(t):
    """The flags of the days that the watermark, an hour behind the newest event, has passed."""
    s = _events(t).withColumn("band", F.floor(F.col("value") / 20))
    return A.run_stateful(A.multi_swipe_once(s, "ts", "user_id", "event_id", "event_type", "band", 4 * 3600), "swipes-once")


@plan(
    "stream_posterior",
    "select event_type, count(*) filter (value > 50) + 1.0::double as a, count(*) filter (value <= 50) + 1.0::double as b from events group by 1",
)
def stream_posterior(t):
    return A.run_updates(A.posterior(_events(t), "event_type", F.col("value") > 50), "posterior", ["event_type"])


@plan("stream_dedupe", "select event_id, user_id, value from events")
def stream_dedupe(t):
    twice = _events(t).union(_events(t))
    return A.run_available(A.dedupe(twice, "ts", ["event_id"]), "dedupe").select("event_id", "user_id", "value")
