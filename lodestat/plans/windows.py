"""Window features, ranks, samples."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestat.functions.special import central_mass
from lodestat.operators import ranking as R
from lodestat.operators import sampling as S
from lodestat.operators import windows as Wn
from lodestat.operators.aggregates import with_midranks
from lodestat.operators.ordered import ntile_from_rank, previous_row, row_numbers, running_totals
from lodestat.operators.quantiles import attach
from lodestat.plans.registry import plan, r6
from lodestat.session import checkpointed

PERIODS = [1, 3, 6, 12, 24, 72, 168]


def _frame(hours: int) -> str:
    return f"range between interval '{hours * 3600 * 1000000 - 1} microseconds' preceding and current row"


def _amount_sql(periods, partition, prefix=""):
    cells = []
    for p in periods:
        w = f"over (partition by {partition} order by ts {_frame(p)})"
        cells += [
            f"round(sum(value) {w}, 6) as {prefix}sum_{p}h",
            f"round(median(value) {w}, 6) as {prefix}median_{p}h",
            f"count(value) {w} as {prefix}count_{p}h",
        ]
    return ", ".join(cells)


def _rounded(df, keep):
    return df.select(*keep, *[r6(c).alias(c) if ("sum_" in c or "median_" in c) else F.col(c) for c in df.columns if "_" in c and c.endswith("h")])


@plan("rolling_amount_features", f"select event_id, user_id, {_amount_sql(PERIODS, 'user_id')} from events")
def rolling_amount_features(t):
    ev = t.events.select("event_id", "user_id", "ts", "value")
    return _rounded(Wn.rolling_amounts(ev, "user_id", "ts", "value", PERIODS), ["event_id", "user_id"])


@plan(
    "rolling_amount_features_pairs",
    f"""with e as (select *, ((props->>'k')::integer % 4)::integer as k, case when value > 50 then 'hi' else 'lo' end as band from events)
    select event_id, {_amount_sql(PERIODS, 'user_id')}, {_amount_sql(PERIODS, 'user_id, event_type, k', 'event_type_k_')},
    {_amount_sql(PERIODS, 'user_id, event_type, band', 'event_type_band_')}, {_amount_sql(PERIODS, 'user_id, k, band', 'k_band_')} from e""",
)
def rolling_amount_features_pairs(t):
    ev = t.events.select(
        "event_id", "user_id", "ts", "value", "event_type",
        (F.get_json_object("props", "$.k").cast("int") % 4).alias("k"),
        F.when(F.col("value") > 50, "hi").otherwise("lo").alias("band"),
    )
    out = Wn.rolling_amounts_pairs(ev, "user_id", "ts", "value", PERIODS, ["event_type", "k", "band"])
    return _rounded(out, ["event_id"])


def _angles_sql(days):
    cells = []
    for d in days:
        w = f"over (partition by user_id order by ts {_frame(24 * d)})"
        cells += [f"round(sum(sin(a)) {w}, 5) + 0.0 as sin_{d}d", f"round(sum(cos(a)) {w}, 5) + 0.0 as cos_{d}d", f"count(*) {w} as n_{d}d"]
    return ", ".join(cells)


@plan(
    "rolling_time_stats",
    f"""with e as (select *, (hour(ts) * 3600 + minute(ts) * 60 + second(ts)) * (2 * pi() / 86400) as a from events)
    select event_id, {_angles_sql([7, 14, 30])} from e""",
)
def rolling_time_stats(t):
    a = Wn.rolling_angles(t.events.select("event_id", "user_id", "ts"), "user_id", "ts", [7, 14, 30])
    cells = []
    for d in (7, 14, 30):
        cells += [r6(f"sin_{d}d", 5).alias(f"sin_{d}d"), r6(f"cos_{d}d", 5).alias(f"cos_{d}d"), f"n_{d}d"]
    return a.select("event_id", *cells)


@plan("rolling_time_ci")
def rolling_time_ci(t):
    a = Wn.rolling_angles(t.events.select("event_id", "user_id", "ts"), "user_id", "ts", [7, 14, 30])
    a = a.withColumns(
        {f"mass_{d}d": central_mass(F.col(f"resultant_{d}d"), F.col("angle") - F.col(f"mean_{d}d")) for d in (7, 14, 30)}
    )
    cells = []
    for d in (7, 14, 30):
        for level in (90, 95):
            inside = (F.col(f"n_{d}d") > 1) & (F.col(f"mass_{d}d") <= level / 100)
            cells.append(inside.cast("int").alias(f"within_{d}d_{level}"))
    return a.select("event_id", *cells)


PREV = {"prev_type": "event_type", "prev_value": "value", "prev_ts": "ts", "prev_band": "band"}


def _with_prev(t):
    ev = t.events.select(
        "event_id", "user_id", "ts", "event_type", F.floor(F.col("value") / 20).alias("band"), "value"
    )
    return previous_row(ev, "ts", PREV, ["user_id"])


LAG_SQL = """with e as (select *, floor(value / 20)::bigint as band from events), l as (select *, lag(event_type) over w as prev_type,
    lag(value) over w as prev_value, lag(ts) over w as prev_ts, lag(band) over w as prev_band from e
    window w as (partition by user_id order by ts))"""


@plan(
    "lag_features",
    LAG_SQL + """ select event_id, coalesce(prev_type, 'none') as prev_type, coalesce(prev_value, -1) as prev_value,
    coalesce(prev_band, -1) as prev_band, prev_ts from l""",
)
def lag_features(t):
    p = _with_prev(t)
    return p.select(
        "event_id", F.coalesce("prev_type", F.lit("none")).alias("prev_type"),
        F.coalesce("prev_value", F.lit(-1.0)).alias("prev_value"), F.coalesce("prev_band", F.lit(-1)).alias("prev_band"), "prev_ts",
    )


@plan(
    "flag_reversal",
    LAG_SQL + """ select event_id, coalesce(event_type = 'click' and prev_type = 'view' and band = prev_band, false)::integer as reversal from l""",
)
def flag_reversal(t):
    hit = (F.col("event_type") == "click") & (F.col("prev_type") == "view") & (F.col("band") == F.col("prev_band"))
    return _with_prev(t).select("event_id", F.coalesce(hit, F.lit(False)).cast("int").alias("reversal"))


@plan(
    "flag_multi_swipe",
    LAG_SQL + """ select event_id, coalesce(event_type = prev_type and band = prev_band and ts - prev_ts <= interval 4 hours, false)::integer as multi_swipe,
    round(coalesce(epoch_us(ts) - epoch_us(prev_ts), -1000000) / 1e6, 6) as seconds_since from l""",
)
def flag_multi_swipe(t):
    p = _with_prev(t)
    gap = Wn.micros("ts") - Wn.micros("prev_ts")
    hit = (F.col("event_type") == F.col("prev_type")) & (F.col("band") == F.col("prev_band")) & (gap <= 4 * Wn.HOUR)
    return p.select(
        "event_id",
        F.coalesce(hit, F.lit(False)).cast("int").alias("multi_swipe"),
        r6(F.coalesce(gap, F.lit(-1_000_000)) / 1e6).alias("seconds_since"),
    )


@plan(
    "rank_midrank",
    """select event_id, rank() over (order by value) + (count(*) over (partition by value) - 1) / 2 as value_rank from events""",
)
def rank_midrank(t):
    return with_midranks(t.events.select("event_id", "value"), ["value"]).select("event_id", "value_rank")


RFM_BASE = """with c as (select o_custkey, datediff('day', max(o_orderdate), timestamp '2001-12-31')::bigint as recency, count(*) as frequency,
    round(sum(o_totalprice), 2) as monetary from orders group by 1)"""


def customer_rfm(t):
    end = F.lit("2001-12-31").cast("date")
    return t.orders.groupBy("o_custkey").agg(
        F.date_diff(end, F.max("o_orderdate").cast("date")).cast("long").alias("recency"),
        F.count(F.lit(1)).alias("frequency"),
        F.round(F.sum("o_totalprice"), 2).alias("monetary"),
    )


def rfm_scores(c):
    """Quartile scores of recency (reversed), frequency and money; each ranked on its own two columns."""
    c = checkpointed(c)
    total = c.count()
    out = c
    for value, name, down in (("recency", "r", True), ("frequency", "f", False), ("monetary", "m", False)):
        ranked = row_numbers(c.select("o_custkey", value), value, "o_custkey", name="_i", descending=down)
        score = ntile_from_rank(F.col("_i"), F.lit(total), 4).alias(name)
        out = out.join(ranked.select("o_custkey", score), "o_custkey")
    return out


RFM_SCORES = RFM_BASE + """, s as (select *, ntile(4) over (order by recency desc, o_custkey)::integer as r,
    ntile(4) over (order by frequency, o_custkey)::integer as f, ntile(4) over (order by monetary, o_custkey)::integer as m from c)"""


@plan("rank_quartile_scores", RFM_SCORES + " select o_custkey, r, f, m from s")
def rank_quartile_scores(t):
    return rfm_scores(customer_rfm(t)).select("o_custkey", "r", "f", "m")


SCORE_SQL = """with e as (select *, round(value / 10)::double as score, (event_type = 'purchase') as y from events)"""


def scored(t):
    return t.events.select(
        "event_id", "user_id", "ts", "value", F.round(F.col("value") / 10).alias("score"), (F.col("event_type") == "purchase").alias("y")
    )


@plan(
    "cumulative_gains",
    SCORE_SQL + """, w as (select score, count_if(y)::double as pos, count_if(not y) * 20.0::double as neg from e group by 1)
    select score, round(sum(pos + neg) over (order by score desc) / sum(pos + neg) over (), 6) as weight_share,
    round(sum(pos) over (order by score desc) / sum(pos) over (), 6) as captured from w""",
)
def cumulative_gains(t):
    g = R.gains(scored(t), "score", F.col("y"))
    return g.select("score", r6("weight_share").alias("weight_share"), r6("captured").alias("captured"))


def daily(t):
    """Daily totals: at most one row per calendar day, whatever the size of the events."""
    return t.events.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.round(F.sum("value"), 4).alias("total"))


def monthly(t):
    """Monthly totals per customer: at most one row per customer and calendar month."""
    return t.orders.groupBy("o_custkey", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("total")
    )


# a calendar series is short (days or months), so one ordered task holds it
def calendar():
    return Window.partitionBy(F.lit(0)).orderBy("day")


def panel():
    return Window.partitionBy("o_custkey").orderBy("month")


DAILY = "with d as (select date_trunc('day', ts)::timestamp as day, round(sum(value), 4) as total from events group by 1)"
MONTHLY = "with m as (select o_custkey, date_trunc('month', o_orderdate)::timestamp as month, round(sum(o_totalprice), 2) as total from orders group by 1, 2)"


@plan(
    "diff_lag",
    DAILY + """, x as (select day, total, total - lag(total) over (order by day) as first_diff, total - lag(total, 7) over (order by day) as season_diff from d)
    select day, round(first_diff, 4) as first_diff, round(season_diff, 4) as season_diff,
    round(first_diff - lag(first_diff, 7) over (order by day), 4) as both_diff from x""",
)
def diff_lag(t):
    d = daily(t)
    d = d.withColumn("first_diff", F.col("total") - F.lag("total").over(calendar()))
    d = d.withColumn("season_diff", F.col("total") - F.lag("total", 7).over(calendar()))
    d = d.withColumn("both_diff", F.col("first_diff") - F.lag("first_diff", 7).over(calendar()))
    return d.select("day", *[r6(c, 4).alias(c) for c in ("first_diff", "season_diff", "both_diff")])


@plan(
    "ratio_to_previous",
    MONTHLY + """ select o_custkey, month, round(total / lag(total) over (partition by o_custkey order by month), 6) as ratio,
    first_value(total) over (partition by o_custkey order by month) as baseline from m""",
)
def ratio_to_previous(t):
    m = monthly(t)
    return m.select(
        "o_custkey", "month", r6(F.col("total") / F.lag("total").over(panel())).alias("ratio"), F.first("total").over(panel()).alias("baseline")
    )


@plan(
    "ratio_to_level",
    MONTHLY + """, c as (select o_custkey, month, total - 100000 as net from m),
    z as (select *, count(*) filter (net = 0) over (partition by o_custkey order by month) as zeros from c)
    select o_custkey, month, case when zeros > 0 then 0.0 else round(net, 2) end as level from z""",
)
def ratio_to_level(t):
    # amounts against a target change sign, and so do their ratios
    m = monthly(t).withColumn("net", F.col("total") - 100000)
    ratio = m.select(
        "o_custkey", "month", F.coalesce(F.try_divide("net", F.lag("net").over(panel())), F.lit(1.0)).alias("ratio"),
        F.first("net").over(panel()).alias("baseline"),
    )
    # a running product from logarithms, the number of negative factors, and whether a zero came by
    size = F.exp(F.sum(F.log(F.when(F.col("ratio") != 0, F.abs("ratio")))).over(panel()))
    minus = F.sum((F.col("ratio") < 0).cast("int")).over(panel()) % 2
    gone = F.max((F.col("ratio") == 0).cast("int")).over(panel())
    product = F.when(gone == 1, 0.0).otherwise(F.when(minus == 1, -1.0).otherwise(1.0) * F.coalesce(size, F.lit(1.0)))
    return ratio.select("o_custkey", "month", r6(F.col("baseline") * product, 2).alias("level"))


@plan(
    "sliding_supervised",
    MONTHLY + """, w as (select o_custkey, month, total as x1, lead(total, 1) over p as x2, lead(total, 2) over p as x3, lead(total, 3) over p as y1,
    lead(total, 4) over p as y2, (lead(total, 3) over p) is null as is_last from m window p as (partition by o_custkey order by month))
    select o_custkey, month, x1, x2, x3, y1, y2, case when y2 is null then 'predict' else 'train' end as part
    from w where y2 is not null or (is_last and x3 is not null)""",
)
def sliding_supervised(t):
    length, horizon = 3, 2
    ahead = panel().rowsBetween(0, length + horizon - 1)
    w = monthly(t).withColumn("window", F.collect_list("total").over(ahead))
    size = F.size("window")
    w = w.filter((size == length + horizon) | (size == length))
    names = ["x1", "x2", "x3", "y1", "y2"]
    return w.select(
        "o_custkey", "month", *[F.try_element_at("window", F.lit(i + 1)).alias(n) for i, n in enumerate(names)],
        F.when(size == length + horizon, "train").otherwise("predict").alias("part"),
    )


@plan(
    "moving_average_rows",
    DAILY + """ select day, round(case when count(*) over w5 = 5 then avg(total) over w5 end, 4) as ma5, round(case when count(*) over w7 = 7 then avg(total) over w7 end, 4) as ma7
    from d window w5 as (order by day rows between 4 preceding and current row), w7 as (order by day rows between 6 preceding and current row)""",
)
def moving_average_rows(t):
    def mean(n):
        w = calendar().rowsBetween(-(n - 1), 0)
        return r6(F.when(F.count(F.lit(1)).over(w) == n, F.avg("total").over(w)), 4).alias(f"ma{n}")

    return daily(t).select("day", mean(5), mean(7))


@plan(
    "last_n_per_group",
    MONTHLY + " select o_custkey, month, total from m qualify row_number() over (partition by o_custkey order by month desc) <= 6",
)
def last_n_per_group(t):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("month"))
    return monthly(t).withColumn("_i", F.row_number().over(w)).filter("_i <= 6").drop("_i")


def _dense_rank_desc(df, value, out):
    distinct = df.select(value).distinct().withColumn("_one", F.lit(1))
    ranks = running_totals(distinct, value, ["_one"], descending=True).select(value, F.col("cum__one").cast("long").alias(out))
    return attach(df, ranks, [value])


@plan(
    "rank_dense_compare",
    """with c as (select c_custkey, c_acctbal as a, coalesce(count(o_orderkey), 0) as b from customer left join orders on c_custkey = o_custkey group by 1, 2),
    r as (select *, dense_rank() over (order by a desc) as rank_a, dense_rank() over (order by b desc) as rank_b from c)
    select c_custkey, rank_a, rank_b, rank_b - rank_a as change from r""",
)
def rank_dense_compare(t):
    n = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("b"))
    c = t.customer.select("c_custkey", F.col("c_acctbal").alias("a")).join(n, "c_custkey", "left").na.fill(0, ["b"])
    c = _dense_rank_desc(_dense_rank_desc(c, "a", "rank_a"), "b", "rank_b")
    return c.select("c_custkey", "rank_a", "rank_b", (F.col("rank_b") - F.col("rank_a")).alias("change"))


@plan(
    "rank_shift_segments",
    RFM_BASE + """, r as (select o_custkey, rank() over (order by frequency desc) as a, rank() over (order by monetary desc) as b, count(*) over () as n from c)
    select o_custkey, case when a <= 0.1 * n and b <= 0.1 * n then 'top_both' when a > 0.9 * n and b > 0.9 * n then 'bottom_both'
    when a <= 0.25 * n and b > 0.75 * n then 'fell' when b <= 0.25 * n and a > 0.75 * n then 'rose' end as segment from r
    where (a <= 0.1 * n and b <= 0.1 * n) or (a > 0.9 * n and b > 0.9 * n) or (a <= 0.25 * n and b > 0.75 * n) or (b <= 0.25 * n and a > 0.75 * n)""",
)
def rank_shift_segments(t):
    c = customer_rfm(t)
    n = c.agg(F.count(F.lit(1))).scalar()
    for value, out in (("frequency", "a"), ("monetary", "b")):
        counts = c.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
        ranks = running_totals(counts, value, ["_n"], descending=True).select(value, (F.col("cum__n") - F.col("_n") + 1).alias(out))
        c = attach(c, ranks, [value])
    a, b = F.col("a"), F.col("b")
    segment = (
        F.when((a <= 0.1 * n) & (b <= 0.1 * n), "top_both")
        .when((a > 0.9 * n) & (b > 0.9 * n), "bottom_both")
        .when((a <= 0.25 * n) & (b > 0.75 * n), "fell")
        .when((b <= 0.25 * n) & (a > 0.75 * n), "rose")
    )
    return c.withColumn("segment", segment).filter("segment is not null").select("o_custkey", "segment")


@plan("row_numbering", "select o_orderkey, row_number() over (order by o_orderkey) as row_id, ((row_number() over (order by o_orderkey) - 1) // 1000)::bigint as chunk from orders")
def row_numbering(t):
    rows = running_totals(t.orders.select("o_orderkey").withColumn("_one", F.lit(1)), "o_orderkey", ["_one"])
    return rows.select("o_orderkey", F.col("cum__one").alias("row_id"), F.floor((F.col("cum__one") - 1) / 1000).alias("chunk"))


@plan(
    "ntile_income_bins",
    """with b as (select case when c_acctbal <= 1500 then 1 when c_acctbal <= 3000 then 2 when c_acctbal <= 4500 then 3 when c_acctbal <= 6000 then 4 else 5 end as bin from customer)
    select bin, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share from b group by 1""",
)
def ntile_income_bins(t):
    from lodestat.functions.bins import cut_index
    from lodestat.operators.aggregates import value_counts

    b = t.customer.select((cut_index(F.col("c_acctbal"), [1500, 3000, 4500, 6000]) + 1).alias("bin"))
    return value_counts(b, "bin").withColumn("share", r6("share"))


# ---- sorts, limits, samples


@plan("sort_multi", "select user_id, ts, event_id from events order by user_id, ts")
def sort_multi(t):
    return t.events.select("user_id", "ts", "event_id").orderBy("user_id", "ts")


@plan(
    "topk_categories",
    """with e as (select coalesce(nullif(p_brand, 'Brand#3'), 'Unknown') as brand, p_retailprice > 1500 as truth, p_size > 25 as guess from part),
    c as (select case when truth then 'false negative' else 'false positive' end as error, brand, count(*) as n from e where truth <> guess group by 1, 2)
    select error, brand, n from c qualify row_number() over (partition by error order by n desc, brand) <= 5""",
)
def topk_categories(t):
    brand = F.coalesce(F.nullif(F.col("p_brand"), F.lit("Brand#3")), F.lit("Unknown")).alias("brand")
    truth, guess = F.col("p_retailprice") > 1500, F.col("p_size") > 25
    error = F.when(truth & ~guess, "false negative").when(~truth & guess, "false positive").alias("error")
    counts = t.part.groupBy(error, brand).agg(F.count(F.lit(1)).alias("n")).where("error IS NOT NULL")
    top = Window.partitionBy("error").orderBy(F.desc("n"), "brand")  # a row per brand
    return counts.withColumn("_i", F.row_number().over(top)).where("_i <= 5").drop("_i")


@plan(
    "topk_per_group",
    """with s as (select l_returnflag, l_partkey, sum(l_quantity) as qty from lineitem group by 1, 2)
    select l_returnflag, l_partkey, qty from s qualify row_number() over (partition by l_returnflag order by qty desc, l_partkey) <= 15""",
)
def topk_per_group(t):
    s = t.lineitem.groupBy("l_returnflag", "l_partkey").agg(F.sum("l_quantity").alias("qty"))
    w = Window.partitionBy("l_returnflag").orderBy(F.desc("qty"), "l_partkey")
    return s.withColumn("_i", F.row_number().over(w)).filter("_i <= 15").drop("_i")


@plan("topk_nlargest", "select p_size, count(*) as n from part group by 1 order by n desc, p_size limit 7")
def topk_nlargest(t):
    return t.part.groupBy("p_size").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "p_size").limit(7)


@plan("sample_n", "select o_orderkey, o_totalprice from orders order by md5(o_orderkey::varchar || '|42') limit 500")
def sample_n(t):
    return S.sample_rows(t.orders.select("o_orderkey", "o_totalprice"), ["o_orderkey"], 500)


@plan(
    "sample_one_per_value",
    "\nunion all ".join(
        f"""select '{c}' as "column", {c}::varchar as value, arg_min(p_partkey, md5(p_partkey::varchar || '|42')) as p_partkey from part group by {c}"""
        for c in ("p_brand", "p_type")
    ),
)
def sample_one_per_value(t):
    return S.one_per_value(t.part, ["p_brand", "p_type"], ["p_partkey"]).select("column", "value", "p_partkey")


@plan(
    "sample_cap_per_class",
    "select doc_id, lang from documents qualify row_number() over (partition by lang order by md5(doc_id::varchar || '|42')) <= 50",
)
def sample_cap_per_class(t):
    return S.cap_per_class(t.documents.select("doc_id", "lang"), "lang", ["doc_id"], 50)


@plan(
    "sample_even_spaced",
    """with r as (select event_id, row_number() over (order by event_id) - 1 as i from events), n as (select count(*) as n from events),
    p as (select distinct floor(k * (n - 1) / 99)::bigint as i from range(100) x(k), n) select event_id from r where i in (select i from p)""",
)
def sample_even_spaced(t):
    return S.evenly_spaced(t.events.select("event_id"), "event_id", count=100)
