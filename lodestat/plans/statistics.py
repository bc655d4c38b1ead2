"""Drift, ranking measures and statistical tests."""

from pyspark.sql import functions as F

from lodestat.operators import drift as Dr
from lodestat.operators import hypothesis_tests as H
from lodestat.operators import ranking as R
from lodestat.operators.ordered import ntile_from_rank, row_numbers
from lodestat.plans.joins import halves
from lodestat.plans.registry import plan, r6
from lodestat.plans.windows import SCORE_SQL, scored

HALF = "timestamp '2024-01-16'"


def late():
    return F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")


# the error function by its power series, for SQL engines without one
ERF = "(2 / sqrt(pi()) * list_sum(list_transform(range(0, 80), lambda k: pow(-1, k) * pow({x}, 2 * k + 1) / (gamma(k + 1) * (2 * k + 1)))))"


@plan(
    "psi",
    f"""with b as (select value as v from events where ts < {HALF}), m as (select value as v from events where ts >= {HALF}),
    s as (select count(*)::double as n, min(v) as lo, max(v) as hi, stddev_pop(v) as sd, avg(v) as mu from b),
    g as (select avg(pow((v - mu) / sd, 3)) as g1 from b, s),
    k as (select lo, ceil((hi - lo) / ((hi - lo) / (1 + log2(n) + log2(1 + abs(g1) / sqrt(6 * (n - 2) / ((n + 1) * (n + 3)))))))::bigint as k, hi from s, g),
    x as (select greatest(0, least(k - 1, floor((v - lo) / ((hi - lo) / k))::bigint)) as bin, side from (select v, 0 as side from b union all select v, 1 from m), k),
    c as (select r.bin, count(*) filter (side = 0) as b, count(*) filter (side = 1) as m from (select unnest(range(0, k)) as bin from k) r left join x on r.bin = x.bin group by 1),
    p as (select case when b = 0 then 1e-6 else b / sum(b) over () end as q, case when m = 0 then 1e-6 else m / sum(m) over () end as p from c),
    z as (select q / sum(q) over () as q, p / sum(p) over () as p from p)
    select round(sum((p - q) * ln(p / q)), 6) as psi, count(*) as bins from z""",
)
def psi(t):
    b, m = halves(t, "value")
    return Dr.psi(b, m, "value").withColumn("psi", r6("psi"))


SOMERS = SCORE_SQL + """, w as (select score, sum({w}) filter (y) as p, sum({w}) filter (not y) as n from e group by 1),
    v as (select score, coalesce(p, 0) as p, coalesce(n, 0) as n from w),
    q as (select sum(a.p * b.n * sign(a.score - b.score)) as s from v a, v b), k as (select sum(p) * sum(n) as k from v)
    select round(s / k, 6) as somers_d from q, k"""


@plan("somers_d", SOMERS.format(w="1.0::double"))
def somers_d(t):
    return R.somers_d(scored(t), "score", F.col("y")).withColumn("somers_d", r6("somers_d"))


@plan("somers_d_weighted", SOMERS.format(w="(1 + event_id % 5)::double"))
def somers_d_weighted(t):
    return R.somers_d(scored(t), "score", F.col("y"), 1 + F.col("event_id") % 5).withColumn("somers_d", r6("somers_d"))


EDGES = ", ".join(f"{i / 20}" for i in range(1, 20))


@plan(
    "wsri",
    SCORE_SQL + f""", b as (select * from e where ts < {HALF}), m as (select * from e where ts >= {HALF}),
    q as (select list_distinct(quantile_cont(score, [{EDGES}])) as edges from b),
    bb as (select *, len(list_filter(edges, lambda x: x < score)) as bin from b, q), mm as (select *, len(list_filter(edges, lambda x: x < score)) as bin from m, q),
    w as (select x.bin, coalesce(y.n, 0) / x.n as w from (select bin, count(*) as n from bb group by 1) x left join (select bin, count(*) as n from mm group by 1) y on x.bin = y.bin),
    vb as (select score, sum(case when y then w else 0 end) as p, sum(case when y then 0 else w end) as n from bb join w using (bin) group by 1),
    vm as (select score, count_if(y)::double as p, count_if(not y)::double as n from mm group by 1),
    db as (select sum(a.p * c.n * sign(a.score - c.score)) / ((select sum(p) from vb) * (select sum(n) from vb)) as d from vb a, vb c),
    dm as (select sum(a.p * c.n * sign(a.score - c.score)) / ((select sum(p) from vm) * (select sum(n) from vm)) as d from vm a, vm c)
    select round(dm.d, 6) as monitoring_d, round(db.d, 6) as benchmark_d, round(dm.d / db.d, 4) as wsri from dm, db""",
)
def wsri(t):
    rows = scored(t)
    out = Dr.wsri(rows.filter(~late()), rows.filter(late()), "score", F.col("y"), 20)
    return out.select(r6("monitoring_d").alias("monitoring_d"), r6("benchmark_d").alias("benchmark_d"), r6("wsri", 4).alias("wsri"))


@plan(
    "ztest_two_proportions",
    f"""with g as (select l_returnflag as metric, count(*) filter (l_linestatus = 'F') as n1, count(*) filter (l_linestatus = 'F' and l_quantity > 25) as s1,
    count(*) filter (l_linestatus <> 'F') as n0, count(*) filter (l_linestatus <> 'F' and l_quantity > 25) as s0 from lineitem group by 1),
    p as (select metric, s1 / n1 as p1, s0 / n0 as p0, (s1 + s0) / (n1 + n0) as pool, n1, n0 from g),
    z as (select metric, p1, p0, p1 - p0 as diff, (p1 - p0) / sqrt(pool * (1 - pool) * (1 / n1 + 1 / n0)) as z, 2 * asin(sqrt(p1)) - 2 * asin(sqrt(p0)) as effect from p)
    select metric, round(p1, 6) as p1, round(p0, 6) as p0, round(diff, 6) + 0.0 as diff, round(z, 6) + 0.0 as z, round(effect, 6) + 0.0 as effect,
    round(1 - {ERF.format(x='(abs(z) / sqrt(2))')}, 6) as p_value, case when 1 - {ERF.format(x='(abs(z) / sqrt(2))')} < 0.05 then 'yes' else 'no' end as significant,
    case when abs(effect) < 0.2 then 'small' when abs(effect) < 0.5 then 'medium' else 'large' end as reading from z""",
)
def ztest_two_proportions(t):
    treated, hit = F.col("l_linestatus") == "F", F.col("l_quantity") > 25
    g = t.lineitem.groupBy(F.col("l_returnflag").alias("metric")).agg(
        F.count_if(treated).alias("n1"), F.count_if(treated & hit).alias("s1"),
        F.count_if(~treated).alias("n0"), F.count_if(~treated & hit).alias("s0"),
    )
    z = H.z_test_proportions(g)
    return z.withColumns({c: r6(c) for c in ("p1", "p0", "diff", "z", "effect", "p_value")})


POOLED = f"""with e as (select value as v, ts >= {HALF} as second from events),
    n as (select count(*) filter (not second)::double as n1, count(*) filter (second)::double as n2 from e),
    r as (select *, rank() over (order by v) + (count(*) over (partition by v) - 1) / 2 as r, rank() over (partition by second order by v) + (count(*) over (partition by second, v) - 1) / 2 as own from e)"""


@plan(
    "brunner_munzel",
    POOLED + """, s as (select second, avg(r) as m, var_samp(r - own) as v from r group by 1), w as (select max(m) filter (not second) as m1, max(m) filter (second) as m2, max(v) filter (not second) as v1, max(v) filter (second) as v2 from s)
    select round(n1 * n2 * (m2 - m1) / ((n1 + n2) * sqrt(n1 * v1 + n2 * v2)), 5) as statistic, round(pow(n1 * v1 + n2 * v2, 2) / (pow(n1 * v1, 2) / (n1 - 1) + pow(n2 * v2, 2) / (n2 - 1)), 2) as df,
    round((m2 - (n2 + 1) / 2) / n1, 6) as effect from w, n""",
)
def brunner_munzel(t):
    b = H.brunner_munzel(t.events, "value", late())
    return b.select(r6("statistic", 5).alias("statistic"), r6("df", 2).alias("df"), r6("effect").alias("effect"))


@plan("brunner_munzel_p")
def brunner_munzel_p(t):
    return H.brunner_munzel(t.events, "value", late()).select("statistic", "p_value")


@plan(
    "mann_whitney_u",
    POOLED + f""", u as (select sum(r) filter (not second) - n1 * (n1 + 1) / 2 as u1, n1, n2 from r, n group by n1, n2), t as (select sum(pow(c, 3) - c) as ties from (select count(*)::double as c from e group by v)),
    z as (select u1, n1 * n2 - u1 as u2, (greatest(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5) / sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))) as z from u, t)
    select u1, u2, round(z, 5) + 0.0 as z, round(least(1, 1 - {ERF.format(x='(z / sqrt(2))')}), 5) as p_value from z""",
)
def mann_whitney_u(t):
    m = H.mann_whitney(t.events, "value", late())
    return m.select("u1", "u2", r6("z", 5).alias("z"), r6("p_value", 5).alias("p_value"))


@plan(
    "wmw_sample_size",
    f"""with e as (select p_size % 5 as level, p_partkey % 3 = 0 as treated from part), c as (select level, count(*) filter (not treated) / sum(count(*) filter (not treated)) over () as c,
    count(*) filter (treated) / sum(count(*) filter (treated)) over () as x from e group by 1), r as (select *, sum(x) over (order by level) - x as below from c),
    s as (select sum(pow(0.5 * c + 0.5 * x, 3)) as cubes, sum(c * below + 0.5 * c * x) as effect from r)
    select round(effect, 6) as effect, round(pow(1.959963984540054 + 0.8416212335729143, 2) * (1 - cubes) / 3 / pow(effect - 0.5, 2), 2) as n_total from s""",
)
def wmw_sample_size(t):
    e = t.part.select((F.col("p_size") % 5).alias("level"), (F.col("p_partkey") % 3 == 0).alias("treated"))
    counts = e.groupBy("level").agg(F.count_if(~F.col("treated")).alias("c"), F.count_if("treated").alias("x"))
    n = counts.agg(F.struct(F.sum("c").alias("c"), F.sum("x").alias("x")).alias("n")).scalar()
    shares = counts.select("level", (F.col("c") / n["c"]).alias("c"), (F.col("x") / n["x"]).alias("x"))
    s = H.ordinal_sample_size(shares, "level", "c", "x", 0.5)
    return s.select(r6("effect").alias("effect"), r6("n_total", 2).alias("n_total"))


@plan(
    "chi2_independence",
    """with c as (select l_returnflag as a, l_linenumber as b, count(*)::double as o from lineitem group by 1, 2), m as (select *, sum(o) over (partition by a) * sum(o) over (partition by b) / sum(o) over () as e, sum(o) over () as n from c),
    k as (select count(distinct a)::double as r, count(distinct b)::double as c from c), s as (select 2 * sum(o * ln(o / e)) as g, sum(pow(o - e, 2) / e) as x, max(n) as n from m)
    select round(g, 6) as statistic, ((r - 1) * (c - 1))::integer as df, round(sqrt(greatest(0, x / n - (r - 1) * (c - 1) / (n - 1)) / least(r - pow(r - 1, 2) / (n - 1) - 1, c - pow(c - 1, 2) / (n - 1) - 1)), 6) as cramers_v from s, k""",
)
def chi2_independence(t):
    c = H.independence(t.lineitem, "l_returnflag", "l_linenumber")
    return c.select(r6("statistic").alias("statistic"), "df", r6("cramers_v").alias("cramers_v"))


@plan("fligner_killeen")
def fligner_killeen(t):
    ev = t.events.select("value", F.when(late(), "late").otherwise("early").alias("half"))
    return H.fligner_killeen(ev, "value", "half")


FLAGS = {"large": "value > 50", "click": "event_type = 'click'", "night": "hour(ts) < 6"}


@plan(
    "nb_conditional_table",
    "\nunion all ".join(
        f"""select '{n}' as flag, round(avg(y) filter (f), 6) as given_one, round(avg(y) filter (not f), 6) as given_zero,
        round((avg(y) filter (f) / avg(y) filter (not f) - 1) * 100, 6) + 0.0 as change_pct from (select {c} as f, (event_id % 10 < 2 or value > 80)::integer as y from events)"""
        for n, c in FLAGS.items()
    ),
)
def nb_conditional_table(t):
    from lodestat.operators.cleaning import unpivot_row

    y = F.expr("cast(event_id % 10 < 2 or value > 80 as double)")
    row = t.events.agg(
        *[F.avg(F.when(F.expr(c), y)).alias(f"{n}__given_one") for n, c in FLAGS.items()],
        *[F.avg(F.when(~F.expr(c), y)).alias(f"{n}__given_zero") for n, c in FLAGS.items()],
    )
    table = unpivot_row(row, list(FLAGS), ["given_one", "given_zero"], "flag")
    change = r6((F.col("given_one") / F.col("given_zero") - 1) * 100)
    return table.withColumn("change_pct", change).withColumns({"given_one": r6("given_one"), "given_zero": r6("given_zero")})


POSTERIOR_SQL = """with c as (select event_type, count(*) filter (value > 50) + 1.0::double as a, count(*) filter (value <= 50) + 1.0::double as b from events group by 1)"""


def _posterior(t):
    return H.beta_posterior(t.events, "event_type", F.col("value") > 50)


@plan(
    "beta_posterior",
    POSTERIOR_SQL + """ select event_type, a, b, round(a / (a + b), 6) as mean, round(a * b / (pow(a + b, 2) * (a + b + 1)), 8) as variance, round(case when a > 1 and b > 1 then (a - 1) / (a + b - 2) end, 6) as mode from c""",
)
def beta_posterior(t):
    return _posterior(t).withColumns({"mean": r6("mean"), "variance": r6("variance", 8), "mode": r6("mode")})


@plan("beta_posterior_interval")
def beta_posterior_interval(t):
    return H.with_interval(_posterior(t))


@plan(
    "beta_binomial_pmf",
    POSTERIOR_SQL + """ select event_type, k::integer as k, round(exp(lgamma(21) - lgamma(k + 1) - lgamma(21 - k) + lgamma(k + a) + lgamma(20 - k + b) - lgamma(a + b + 20) + lgamma(a + b) - lgamma(a) - lgamma(b)), 6) as probability from c, range(0, 21) r(k)""",
)
def beta_binomial_pmf(t):
    return H.beta_binomial(_posterior(t), "event_type", 20).withColumn("probability", r6("probability"))


@plan(
    "beta_kl",
    # at whole parameters the digamma function is a harmonic number less a constant, which cancels out; the prior's own terms are 0
    POSTERIOR_SQL + """, h as (select i::double as n, coalesce(sum(1 / i::double) over (order by i rows between unbounded preceding and 1 preceding), 0) as d from range(1, (select max(a + b)::bigint + 1 from c)) r(i))
    select event_type, round(lgamma(a + b) - lgamma(a) - lgamma(b) + (a - 1) * x.d + (b - 1) * y.d + (2 - a - b) * z.d, 6) as kl from c join h x on x.n = a join h y on y.n = b join h z on z.n = a + b""",
)
def beta_kl(t):
    return H.beta_divergence(_posterior(t), "event_type").withColumn("kl", r6("kl"))


MUS, SIGMAS = [30.0, 40.0, 50.0, 60.0], [30.0, 40.0, 50.0]


@plan(
    "censored_normal_nll",
    f"""with s as (select count(*) filter (value < 100) as n, sum(value) filter (value < 100) as s, sum(value * value) filter (value < 100) as q, count(*) filter (value >= 100) as c from events),
    g as (select mu, sigma, (100 - mu) / sigma / sqrt(2) as x from unnest([30.0::double, 40, 50, 60]) a(mu), unnest([30.0::double, 40, 50]) b(sigma))
    select mu, sigma, round(n * ln(sigma) + n / 2 * ln(2 * pi()) + (q - 2 * mu * s + n * mu * mu) / (2 * sigma * sigma) - c * ln(greatest(0.5 * (1 - {ERF.format(x='x')}), 1e-12)), 3) as nll from s, g""",
)
def censored_normal_nll(t):
    return H.censored_normal_nll(t.events, "value", 100, MUS, SIGMAS).withColumn("nll", r6("nll", 3))


@plan("logit_regression_inference")
def logit_regression_inference(t):
    rows = t.lineitem.select((F.col("l_quantity") > 25).alias("y"), "l_discount", "l_tax")
    return H.logit_inference(rows, F.col("y"), ["l_discount", "l_tax"])


@plan(
    "score_band_rates",
    """with e as (select *, ntile(20) over (order by value, event_id)::integer as band from events), g as (select band, avg((event_id % 7 < 2)::integer) filter (event_type = 'click') as p1, avg((event_id % 7 < 2)::integer) filter (event_type <> 'click') as p0 from e group by 1)
    select band, round(p1, 6) as p1, round(p0, 6) as p0, round(p1 - p0, 6) + 0.0 as lift, round(case when abs(p0) > 1e-12 then (p1 - p0) / p0 end, 6) + 0.0 as relative_lift from g""",
)
def score_band_rates(t):
    from lodestat.functions.scalars import lift

    n = t.events.agg(F.count(F.lit(1))).scalar()
    ranked = row_numbers(t.events.select("event_id", "value", "event_type"), "value", "event_id", name="_i")
    banded = ranked.withColumn("band", ntile_from_rank(F.col("_i"), n, 20))
    paid, click = (F.col("event_id") % 7 < 2).cast("double"), F.col("event_type") == "click"
    g = banded.groupBy("band").agg(F.avg(F.when(click, paid)).alias("p1"), F.avg(F.when(~click, paid)).alias("p0"))
    p0, p1 = F.col("p0"), F.col("p1")
    return g.select(
        "band", r6("p1").alias("p1"), r6("p0").alias("p0"), r6(lift(p0, p1)).alias("lift"),
        r6(lift(p0, p1, "multiplicative")).alias("relative_lift"),
    )
