"""Time series and customer value."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestat.operators import customer as Cu
from lodestat.operators import series as Se
from lodestat.operators import splits as Sp
from lodestat.operators.quantiles import attach, exact_quantiles
from lodestat.plans.registry import plan, r6
from lodestat.plans.windows import DAILY, RFM_SCORES, customer_rfm, daily, rfm_scores

TWO = """with d as (select date_trunc('day', ts)::timestamp as day, round(sum(value) filter (event_type = 'view'), 4) as bus, round(sum(value) filter (event_type <> 'view'), 4) as rail from events group by 1)"""


def two_series(t):
    view = F.col("event_type") == "view"
    return t.events.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(
        F.round(F.sum(F.when(view, F.col("value"))), 4).alias("bus"), F.round(F.sum(F.when(~view, F.col("value"))), 4).alias("rail")
    )


@plan(
    "resample",
    """select date_trunc('quarter', o_orderdate)::timestamp as period, round(avg(o_totalprice), 7) as mean, round(var_samp(o_totalprice), 0) as variance,
    round(median(o_totalprice), 4) as median from orders group by 1""",
)
def resample(t):
    o = t.orders.withColumn("period", F.date_trunc("quarter", "o_orderdate").cast("timestamp_ntz"))
    r = Se.resample(t.orders, "o_orderdate", "o_totalprice", "quarter", ["mean", "variance"])
    medians = exact_quantiles(o, ["o_totalprice"], {"median": 0.5}, ["period"]).select("period", "median")
    both = attach(r, medians, ["period"])
    return both.select("period", r6("mean", 7).alias("mean"), r6("variance", 0).alias("variance"), r6("median", 4).alias("median"))


@plan(
    "calendar_spine",
    """with d as (select day, count(*) as n from (select case when day(ts) % 4 <> 0 then date_trunc('day', ts)::timestamp end as day from events) where day is not null group by 1),
    s as (select unnest(generate_series(min(day), max(day), interval 1 day))::timestamp as day from d) select day, coalesce(n, 0) as n from s left join d using (day)""",
)
def calendar_spine(t):
    # days divisible by four become null: the gaps that the calendar fills
    day = F.when(F.dayofmonth("ts") % 4 != 0, F.date_trunc("day", "ts").cast("timestamp_ntz")).alias("day")
    d = t.events.select(day).filter("day IS NOT NULL").groupBy("day")
    return Se.fill_calendar(d.agg(F.count(F.lit(1)).alias("n")), "day").na.fill(0)


ACF = DAILY + """, c as (select row_number() over (order by day) as i, total - avg(total) over () as x from d),
    a as (select k::integer as lag, sum(p.x * q.x) / (select sum(x * x) from c) as acf from range(0, 11) r(k) join c p on true join c q on q.i = p.i - k group by 1)"""


@plan("acf", ACF + " select lag, round(acf, 6) as acf from a")
def acf(t):
    return Se.autocorrelation(daily(t), "day", "total", 10).withColumn("acf", r6("acf"))


def _pacf_sql(lags):
    """Durbin-Levinson, one step for each lag: f{k}_{j} is coefficient j of the autoregression of order k."""
    steps = [ACF + ", r as (select list(acf order by lag) as r from a), p1 as (select r, r[2] as f1_1 from r)"]
    for k in range(2, lags + 1):
        top = " - ".join([f"r[{k + 1}]", *(f"f{k - 1}_{j} * r[{k - j + 1}]" for j in range(1, k))])
        bottom = " - ".join(["1", *(f"f{k - 1}_{j} * r[{j + 1}]" for j in range(1, k))])
        others = ", ".join(f"f{k - 1}_{j} - f{k}_{k} * f{k - 1}_{k - j} as f{k}_{j}" for j in range(1, k))
        steps.append(f"p{k} as (select *, ({top}) / ({bottom}) as f{k}_{k}, {others} from p{k - 1})")
    rows = " union all ".join(f"select {k}::integer as lag, round(f{k}_{k}, 6) as pacf from p{lags}" for k in range(1, lags + 1))
    return ", ".join(steps) + f" select 0::integer as lag, 1.0::double as pacf union all {rows}"


@plan("pacf", _pacf_sql(10))
def pacf(t):
    return Se.partial_autocorrelation(daily(t), "day", "total", 10).withColumn("pacf", r6("pacf"))


@plan(
    "ccf",
    TWO + """, c as (select row_number() over (order by day) as i, bus - avg(bus) over () as x, rail - avg(rail) over () as y from d), s as (select sqrt(sum(x * x) * sum(y * y)) as s, 1.959963984540054 / sqrt(count(*)) as band from c)
    select k::integer as lag, round(sum(p.x * q.y) / max(s), 6) as ccf, round(max(band), 6) as band from range(-7, 8) r(k) join c p on true join c q on q.i = p.i - k cross join s group by 1""",
)
def ccf(t):
    c = Se.cross_correlation(two_series(t), "day", "bus", "rail", 7)
    return c.select("lag", r6("ccf").alias("ccf"), r6("band").alias("band"))


@plan(
    "ljung_box",
    ACF + """, n as (select count(*) as n from d) select lag, round(n * (n + 2) * sum(acf * acf / (n - lag)) over (order by lag), 5) as q from a, n where lag > 0""",
)
def ljung_box(t):
    return Se.ljung_box(daily(t), "day", "total", 10).select("lag", r6("q", 5).alias("q"))


@plan("granger_f")
def granger_f(t):
    return Se.granger(two_series(t), "day", "rail", "bus", 3)


DECOMPOSED = DAILY + """, i as (select *, row_number() over (order by day) - 1 as t from d), m as (select *, t % 7 as phase, case when count(*) over w = 7 then avg(total) over w end as trend from i window w as (order by day rows between 3 preceding and 3 following)),
    p as (select phase, avg(total - trend) as m from m group by 1), s as (select phase, m - avg(m) over () as seasonal from p), z as (select day, total, trend, seasonal, total - trend - seasonal as residual from m join s using (phase))"""


@plan("stl_classical", DECOMPOSED + " select day, round(trend, 4) as trend, round(seasonal, 4) as seasonal, round(residual, 4) as residual from z")
def stl_classical(t):
    d = Se.decompose(daily(t), "day", "total", 7)
    return d.select("day", r6("trend", 4).alias("trend"), r6("seasonal", 4).alias("seasonal"), r6("residual", 4).alias("residual"))


@plan(
    "stl_classical_even",
    """with d as (select date_trunc('month', o_orderdate)::timestamp as month, round(sum(o_totalprice) / 1000, 6) as total from orders group by 1), i as (select *, row_number() over (order by month) - 1 as t from d),
    m as (select *, t % 12 as phase, case when count(*) over w = 13 then (sum(total) over w - (lag(total, 6) over o + lead(total, 6) over o) / 2) / 12 end as trend from i
        window w as (order by month rows between 6 preceding and 6 following), o as (order by month)),
    p as (select phase, avg(total - trend) as m from m group by 1), s as (select phase, m - avg(m) over () as seasonal from p)
    select month, round(trend, 3) as trend, round(seasonal, 3) as seasonal, round(total - trend - seasonal, 3) as residual from m join s using (phase)""",
)
def stl_classical_even(t):
    month = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz").alias("month")
    d = Se.decompose(t.orders.groupBy(month).agg(F.round(F.sum("o_totalprice") / 1000, 6).alias("total")), "month", "total", 12)
    return d.select("month", *[r6(c, 3).alias(c) for c in ("trend", "seasonal", "residual")])


@plan(
    "outlier_iqr_resid",
    DECOMPOSED + """, q as (select quantile_cont(residual, 0.25) as a, quantile_cont(residual, 0.75) as b from z)
    select count(*) as n, coalesce(strftime(min(day), '%Y-%m-%d'), 'none') as first_day, coalesce(strftime(max(day), '%Y-%m-%d'), 'none') as last_day from z, q where residual > b + 0.5 * (b - a) or residual < a - 0.5 * (b - a)""",
)
def outlier_iqr_resid(t):
    out = Se.residual_outliers(Se.decompose(daily(t), "day", "total", 7), factor=0.5)
    text = lambda c: F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit("none"))
    return out.agg(F.count(F.lit(1)).alias("n"), text(F.min("day")).alias("first_day"), text(F.max("day")).alias("last_day"))


@plan(
    "fourier_features",
    DAILY + """, a as (select day, row_number() over (order by day) - 1 as t, 'in' as part from d union all select (select max(day) from d) + to_days(h::integer), (select count(*) from d) + h - 1, 'out' from range(1, 8) r(h))
    select day, t, part, """
    + ", ".join(f"round({f}(t * (2 * pi() * {k} / 7)), 6) + 0.0 as {f}_{k}" for k in (1, 2) for f in ("sin", "cos"))
    + " from a",
)
def fourier_features(t):
    d = daily(t)
    inside = Se.with_index(d, "day").select("day", "t", F.lit("in").alias("part"))
    ahead = Se.horizon_rows(d, "day", 7).select("day", (F.col("n") + F.col("h") - 1).alias("t"), F.lit("out").alias("part"))
    both = inside.unionByName(ahead)
    return both.select("day", "t", "part", *[(r6(c) + 0.0).alias(n) for n, c in Se.fourier_terms(F.col("t"), 7, 2).items()])


NAIVE = DAILY + """, i as (select *, row_number() over (order by day) - 1 as t, count(*) over () as n from d), h as (select unnest(range(1, 8)) as h),
    p as (select t % 7 as phase, arg_max(total, t) as l, avg(total) as m from i group by 1), e as (select arg_max(total, t) as last, arg_min(total, t) as first, max(t) as span, max(n) as n, max(day) as day from i)"""


@plan(
    "naive_forecast",
    NAIVE + """ select h::integer as h, day + to_days(h::integer) as day, round(l, 4) as last, round(m, 4) as mean, round(e.last + h * (e.last - e.first) / span, 4) as drift from h, e join p on phase = (n + h - 1) % 7""",
)
def naive_forecast(t):
    d = daily(t)
    made = [
        Se.naive_forecast(d, "day", "total", 7, 7, s).select("h", "day", r6("forecast", 4).alias(s)) for s in ("last", "mean", "drift")
    ]
    return made[0].join(made[1], ["h", "day"]).join(made[2], ["h", "day"])


@plan(
    "detrend_deseasonalize",
    DAILY + """, i as (select *, row_number() over (order by day) - 1 as t from d), l as (select regr_slope(total, t) as b, regr_intercept(total, t) as a from i), f as (select day, total, t, a + b * t as trend, total - a - b * t as flat from i, l),
    p as (select t % 7 as phase, avg(flat) as seasonal from f group by 1) select day, round(trend, 4) as trend, round(seasonal, 4) as seasonal, round(flat - seasonal, 4) + 0.0 as rest, round(trend + seasonal + flat - seasonal, 4) as restored from f join p on t % 7 = phase""",
)
def detrend_deseasonalize(t):
    d = Se.detrend_deseason(daily(t), "day", "total", 7)
    back = F.col("trend") + F.col("seasonal") + F.col("rest")
    return d.select("day", *[(r6(c, 4) + 0.0).alias(c) for c in ("trend", "seasonal", "rest")], r6(back, 4).alias("restored"))


USER_DAILY = "with d as (select user_id, date_trunc('day', ts)::timestamp as day, round(sum(value), 4) as total from events group by 1, 2)"


def user_daily(t, key="user_id"):
    return t.events.groupBy(key, F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(F.round(F.sum("value"), 4).alias("total"))


@plan(
    "ses_forecast",
    USER_DAILY + """, b as (select *, row_number() over (partition by user_id order by day desc) - 1 as back, count(*) over (partition by user_id) as n from d)
    select user_id, round(sum(case when back = n - 1 then pow(0.7::double, back) else 0.3 * pow(0.7::double, back) end * total), 4) as forecast, count(*) as n from b group by 1""",
)
def ses_forecast(t):
    s = Se.exponential_smoothing(user_daily(t), "day", "total", 0.3, ["user_id"])
    return s.withColumn("forecast", r6("forecast", 4))


@plan("ar_ols_forecast")
def ar_ols_forecast(t):
    return Se.autoregression_forecast(user_daily(t, "event_type"), "day", "total", "event_type", lags=2, horizon=7)


# a dummy for weekends is two means taken out, which leaves a two by two system
VAR_SQL = TWO.replace("with d as", "with recursive d as") + """, l as (select *, lag(bus) over o as b1, lag(rail) over o as r1, dayofweek(day) in (0, 6) as g from d window o as (order by day)),
    x as (select * from l where bus is not null and rail is not null and b1 is not null and r1 is not null),
    m as (select g, avg(bus) as mb, avg(rail) as mr, avg(b1) as m1, avg(r1) as m2 from x group by 1),
    c as (select bus - mb as yb, rail - mr as yr, b1 - m1 as x1, r1 - m2 as x2 from x join m using (g)),
    s as (select sum(x1 * x1) as a, sum(x2 * x2) as b, sum(x1 * x2) as c, sum(x1 * yb) as p1, sum(x2 * yb) as p2, sum(x1 * yr) as q1, sum(x2 * yr) as q2 from c),
    k as (select (p1 * b - p2 * c) / (a * b - c * c) as b1, (p2 * a - p1 * c) / (a * b - c * c) as b2, (q1 * b - q2 * c) / (a * b - c * c) as r1, (q2 * a - q1 * c) / (a * b - c * c) as r2 from s),
    f as (select 0 as h, day, bus, rail from d where day = (select max(day) from d) union all
        select h + 1, f.day + interval 1 day, mb + k.b1 * (bus - m1) + k.b2 * (rail - m2), mr + k.r1 * (bus - m1) + k.r2 * (rail - m2)
        from f, k, m where m.g = (dayofweek(f.day + interval 1 day) in (0, 6)) and h < 7)"""


def weekend(day):
    return F.dayofweek(day).isin(1, 7)


@plan("var_forecast", VAR_SQL + " select h, day, round(bus, 3) as bus, round(rail, 3) as rail from f where h > 0")
def var_forecast(t):
    made = Se.vector_autoregression(two_series(t), "day", ["bus", "rail"], 1, 7, exogenous={"weekend": weekend})
    wide = made.groupBy("h", "day").pivot("variable", ["bus", "rail"]).agg(F.max("forecast"))
    return wide.select("h", "day", r6("bus", 3).alias("bus"), r6("rail", 3).alias("rail"))


@plan("var_order_forecast")
def var_order_forecast(t):
    """Views and other events of every user group, lags up to 5 by BIC, a line and day dummies."""
    view = F.col("event_type") == "view"
    group = (F.col("user_id") % 4).alias("user_group")
    days = t.events.groupBy(group, F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(
        F.coalesce(F.sum(F.when(view, F.col("value"))), F.lit(0.0)).alias("views"), F.coalesce(F.sum(F.when(~view, F.col("value"))), F.lit(0.0)).alias("others")
    )
    dummies = {f"day{i}": lambda day, i=i: F.dayofweek(day) == i for i in range(2, 8)}
    made = Se.vector_autoregression(days, "day", ["views", "others"], 5, 7, ["user_group"], dummies, trend="ct")
    return made.withColumn("forecast", r6("forecast", 4))


@plan(
    "counterfactual_splice",
    DAILY + """, b as (select *, row_number() over (order by day) - 1 as t, count(*) over () as n from d where day < timestamp '2024-01-15'), p as (select t % 7 as phase, arg_max(total, t) as l, max(n) as n from b group by 1),
    f as (select timestamp '2024-01-14' + to_days(h::integer) as day, l as forecast from range(1, 8) r(h) join p on phase = (14 + h - 1) % 7)
    select day, round(total, 4) as original, round(coalesce(forecast, total), 4) as spliced from d left join f using (day)""",
)
def counterfactual_splice(t):
    d = daily(t)
    start = F.lit("2024-01-15").cast("timestamp_ntz")
    f = Se.naive_forecast(d.filter(F.col("day") < start), "day", "total", 7, 7, "last").select("day", "forecast")
    joined = d.join(f, "day", "left")
    return joined.select("day", r6("total", 4).alias("original"), r6(F.coalesce("forecast", "total"), 4).alias("spliced"))


CV = DAILY + """, i as (select *, row_number() over (order by day) - 1 as t from d), k as (select count(*) as n from d), s as (select unnest(range(0, (n - 17) // 3 + 1)) as split from k),
    tr as (select split, t - split * 3 as u, total from i join s on t >= split * 3 and t < split * 3 + 14), p as (select split, u % 7 as phase, arg_max(total, u) as l from tr group by 1, 2),
    te as (select split, t - split * 3 - 13 as h, total from i join s on t >= split * 3 + 14 and t < split * 3 + 17), e as (select split, h, total - l as error, total from te join p using (split) where phase = (14 + h - 1) % 7)"""


def _cv_errors(t):
    d = daily(t)
    rows = Sp.sliding_windows(d, "day", window=14, horizon=3, step=3)
    train = rows.filter("part = 'train'").select("split", "day", "total")
    test = rows.filter("part = 'test'").select("split", "day", F.col("total").alias("actual"))
    f = Se.naive_forecast(train, "day", "total", 7, 3, "last", keys=["split"])
    return f.join(test, ["split", "day"]).withColumn("error", F.col("actual") - F.col("forecast"))


@plan("forecast_cv_score", CV + " select split, round(avg(abs(error)), 4) as mae, round(avg(abs(error / total)), 6) as mape from e group by 1")
def forecast_cv_score(t):
    e = _cv_errors(t)
    return e.groupBy("split").agg(
        r6(F.avg(F.abs("error")), 4).alias("mae"), r6(F.avg(F.abs(F.col("error") / F.col("actual")))).alias("mape")
    )


@plan(
    "forecast_cv_mean",
    CV + """, w as (select split, avg(abs(error)) as mae, avg(abs(error / total)) as mape from e group by 1)
    select count(*) as splits, round(avg(mae), 4) as mae, round(avg(mape), 6) as mape from w""",
)
def forecast_cv_mean(t):
    scores = _cv_errors(t).groupBy("split").agg(F.avg(F.abs("error")).alias("mae"), F.avg(F.abs(F.col("error") / F.col("actual"))).alias("mape"))
    return scores.agg(F.count(F.lit(1)).alias("splits"), r6(F.avg("mae"), 4).alias("mae"), r6(F.avg("mape")).alias("mape"))


@plan(
    "prediction_interval",
    CV + " select h::integer as h, round(1.959963984540054 * stddev_samp(error), 4) as half_width, count(*) as n from e group by 1",
)
def prediction_interval(t):
    return Se.residual_band(_cv_errors(t), "h", "error").withColumn("half_width", r6("half_width", 4))


@plan(
    "density_adjustment",
    """with y as (select c_nationkey as id, year(o_orderdate)::integer as year, count(*) as pop, sum(o_totalprice) / 1e6 as density from orders join customer on o_custkey = c_custkey group by 1, 2)
    select a.id, a.year, round(case when a.year between 1999 and 2001 then a.density * b.pop / c.pop else a.density end, 6) as adjusted from y a left join y b on b.id = a.id and b.year = a.year - 2 join y c on c.id = a.id and c.year = 2001""",
)
def density_adjustment(t):
    owner = t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("id"))
    y = t.orders.join(owner, "o_custkey").groupBy("id", F.year("o_orderdate").alias("year")).agg(
        F.count(F.lit(1)).alias("pop"), (F.sum("o_totalprice") / 1e6).alias("density")
    )
    # one row per nation and year: one join on (id, year - 2), one on the base year
    past = y.select("id", (F.col("year") + 2).alias("year"), F.col("pop").alias("past"))
    base = y.filter("year = 2001").select("id", F.col("pop").alias("base"))
    j = y.join(past, ["id", "year"], "left").join(base, "id")
    adjusted = F.when(F.col("year").between(1999, 2001), F.col("density") * F.col("past") / F.col("base")).otherwise(F.col("density"))
    return j.select("id", "year", r6(adjusted).alias("adjusted"))


@plan(
    "vehicle_allocation",
    """with d as (select date_trunc('day', ts)::timestamp as day, count(*) * 3.0::double as bus, count(*) * 40.0::double as rail from events group by 1),
    c as (select day, rail, x as b40, greatest(0, ceil((bus - x * 240) / 420))::integer as b60 from d, unnest(range(0, ceil(bus / 240)::bigint + 1)) r(x)),
    f as (select *, b40 * 500 + b60 * 800 as cost, row_number() over (partition by day order by b40 * 500 + b60 * 800, b40) as i from c where b40 >= 0.3 * (b40 + b60))
    select day, b40::integer as buses_40, b60 as buses_60, ceil(rail / 900)::integer as railcars, (cost + ceil(rail / 900) * 1200)::double as cost from f where i = 1""",
)
def vehicle_allocation(t):
    d = t.events.groupBy(F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).agg(
        (F.count(F.lit(1)) * 3.0).alias("bus"), (F.count(F.lit(1)) * 40.0).alias("rail")
    )
    return Se.cheapest_fleet(
        d, "day", "bus", "rail", cost_40=500.0, cost_60=800.0, cost_rail=1200.0, capacity_40=40, capacity_60=70, capacity_rail=100,
        trips_bus=6, trips_rail=9, share_40=0.3,
    )


# ---- customer value

RFM = """with d as (select o_custkey, o_orderdate::date as day, sum(o_totalprice) as spent from orders where o_orderdate <= timestamp '2000-12-31' group by 1, 2),
    c as (select o_custkey, count(*) - 1 as frequency, min(day) as a, max(day) as b, sum(spent) as s, arg_min(spent, day) as f from d group by 1),
    r as (select o_custkey, frequency, datediff('day', a, b)::integer as recency, datediff('day', a, date '2000-12-31')::integer as "T", case when frequency > 0 then (s - f) / frequency else 0 end as monetary_value, datediff('day', b, date '2000-12-31')::integer as days_since_last from c)"""


def _rfm(t):
    return Cu.rfm_summary(t.orders, "o_custkey", "o_orderdate", "o_totalprice", "2000-12-31")


@plan("rfm_summary", RFM + ' select o_custkey, frequency, recency, "T", round(monetary_value, 6) as monetary_value, days_since_last from r')
def rfm_summary(t):
    return _rfm(t).withColumn("monetary_value", r6("monetary_value"))


@plan(
    "rfm_train_test",
    RFM + """, h as (select o_custkey, count(*) as n, avg(spent) as m from (select o_custkey, o_orderdate::date as day, sum(o_totalprice) as spent from orders where o_orderdate > timestamp '2000-12-31' and o_orderdate <= timestamp '2001-06-30' group by 1, 2) group by 1)
    select o_custkey, frequency, recency, "T", round(monetary_value, 6) as monetary_value, days_since_last, coalesce(n, 0) as test_frequency, round(coalesce(m, 0), 6) as test_monetary_value from r left join h using (o_custkey)""",
)
def rfm_train_test(t):
    r = Cu.rfm_train_test(t.orders, "o_custkey", "o_orderdate", "o_totalprice", "2000-12-31", "2001-06-30")
    return r.withColumns({"monetary_value": r6("monetary_value"), "test_monetary_value": r6("test_monetary_value")})


@plan(
    "rfm_segments",
    RFM_SCORES + """, g as (select o_custkey, r * 100 + f * 10 + m as score, case when r >= 3 and f >= 3 and m >= 3 then 'Premium' when f >= 3 and r >= 2 then 'Repeat' when m = 4 then 'Top Spender' when r = 1 and f >= 2 then 'At Risk' when r <= 2 and f <= 2 then 'Inactive' else 'Other' end as segment from s)
    select segment, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share, min(score)::integer as low, max(score)::integer as high from g group by 1""",
)
def rfm_segments(t):
    r, f, m = F.col("r"), F.col("f"), F.col("m")
    rules = {
        "Premium": (r >= 3) & (f >= 3) & (m >= 3),
        "Repeat": (f >= 3) & (r >= 2),
        "Top Spender": m == 4,
        "At Risk": (r == 1) & (f >= 2),
        "Inactive": (r <= 2) & (f <= 2),
    }
    scores = rfm_scores(customer_rfm(t)).withColumn("score", r * 100 + f * 10 + m)
    named = Cu.name_segments(scores, rules)
    counts = named.groupBy("segment").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"), F.max("score").alias("high"))
    whole = Window.partitionBy(F.lit(0))  # one row per segment
    return counts.withColumn("share", r6(F.col("n") / F.sum("n").over(whole)))


@plan(
    "gamma_gamma_spend",
    RFM + " select o_custkey, round(6.25 * (15.4 + frequency * monetary_value) / (6.25 * frequency + 3.74 - 1), 4) as expected_spend from r",
)
def gamma_gamma_spend(t):
    spend = Cu.gamma_gamma_spend(F.col("frequency"), F.col("monetary_value"), 6.25, 3.74, 15.4)
    return _rfm(t).select("o_custkey", r6(spend, 4).alias("expected_spend"))


@plan(
    "clv_discounted",
    RFM + """, e as (select *, 6.25 * (15.4 + frequency * monetary_value) / (6.25 * frequency + 3.74 - 1) as spend, frequency / greatest("T", 1) * 30 as rate from r)
    select o_custkey, round(sum((rate * pow(k, 0.9::double) - rate * pow(k - 1, 0.9::double)) * spend / pow(1.01::double, k)), 3) as clv from e, range(1, 13) x(k) group by 1""",
)
def clv_discounted(t):
    spend = Cu.gamma_gamma_spend(F.col("frequency"), F.col("monetary_value"), 6.25, 3.74, 15.4)
    curve = F.col("frequency") / F.greatest(F.col("T"), F.lit(1)) * 30 * F.pow(F.col("month"), F.lit(0.9))
    return Cu.discounted_value(_rfm(t), "o_custkey", curve, spend, 12, 0.01).withColumn("clv", r6("clv", 3))
