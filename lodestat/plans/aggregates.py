"""Aggregations."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from lodestat.operators import aggregates as A
from lodestat.operators.cleaning import unpivot_row
from lodestat.operators.quantiles import attach, exact_quantiles, quantile_values
from lodestat.plans.registry import plan, r6

LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@plan(
    "agg_group_stats",
    """select user_id, round(avg(value), 6) as value_mean, round(coalesce(stddev_samp(value), 0), 6) as value_std,
    min(value) as value_min, max(value) as value_max, arg_max(value, ts) as value_last, count(event_type) as event_type_count,
    arg_max(event_type, ts) as event_type_last, count(distinct event_type) as event_type_nunique from events group by 1""",
)
def agg_group_stats(t):
    s = A.group_stats(t.events, ["user_id"], ["value"], ["event_type"], F.struct("ts", "event_id"))
    return s.withColumns({"value_mean": r6("value_mean"), "value_std": r6(F.coalesce("value_std", F.lit(0.0)))})


@plan(
    "agg_group_transform",
    """select event_id, round(avg(value) over (partition by event_type), 6) as value_mean_by_event_type,
    round(stddev_samp(value) over (partition by event_type), 6) as value_std_by_event_type,
    round(median(value) over (partition by event_type), 6) as value_median_by_event_type,
    round(sum(value) over (partition by user_id), 6) as value_sum_by_user_id,
    max(value) over (partition by user_id) as value_max_by_user_id from events""",
)
def agg_group_transform(t):
    ev = t.events.select("event_id", "user_id", "event_type", "value")
    out = A.group_transform(ev, ["event_type"], ["value"], ["mean", "std", "median"])
    out = A.group_transform(out, ["user_id"], ["value"], ["sum", "max"])
    made = [c for c in out.columns if "_by_" in c]
    return out.select("event_id", *[r6(c).alias(c) for c in made])


@plan("agg_value_counts", "select p_type, count(*) as n, round(count(*) / sum(count(*)) over (), 6) as share from part group by 1")
def agg_value_counts(t):
    return A.value_counts(t.part, "p_type").withColumn("share", r6("share"))


@plan(
    "agg_value_count_quantiles",
    """with c as (select l_partkey, count(*) as n from lineitem group by 1)
    select min(n) as least, round(quantile_cont(n, 0.25), 6) as q25, round(median(n), 6) as q50, round(quantile_cont(n, 0.75), 6) as q75,
    round(quantile_cont(n, 0.99), 6) as q99, max(n) as most from c""",
)
def agg_value_count_quantiles(t):
    counts = t.lineitem.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    q = exact_quantiles(counts, ["n"], {"q25": 0.25, "q50": 0.5, "q75": 0.75, "q99": 0.99})
    ends = counts.agg(F.struct(F.min("n").alias("least"), F.max("n").alias("most")).alias("e")).scalar()
    return q.select(ends["least"].alias("least"), *[r6(c).alias(c) for c in ("q25", "q50", "q75", "q99")], ends["most"].alias("most"))


@plan(
    "agg_n_unique",
    "\nunion all ".join(f"select '{c}' as \"column\", count(distinct {c}) as n_unique from part" for c in ("p_name", "p_brand", "p_type")),
)
def agg_n_unique(t):
    names = ["p_name", "p_brand", "p_type"]
    row = t.part.agg(*[F.count_distinct(c).alias(f"{c}__n_unique") for c in names])
    return unpivot_row(row, names, ["n_unique"])


@plan(
    "agg_describe",
    "\nunion all ".join(
        f"""select '{c}' as "column", count({c}) as count, count(*) - count({c}) as nulls, round(avg({c}), 6) as mean,
        round(stddev_samp({c}), 6) as std, min({c}) + 0.0 as min, max({c}) as max, round(quantile_cont({c}, 0.05), 6) as p05,
        round(median({c}), 6) as p50, round(quantile_cont({c}, 0.95), 6) as p95 from lineitem"""
        for c in LI
    ),
)
def agg_describe(t):
    d = A.describe(t.lineitem.select(*LI), LI, {"p05": 0.05, "p50": 0.5, "p95": 0.95})
    return d.select("column", "count", "nulls", "min", "max", *[r6(c).alias(c) for c in ("mean", "std", "p05", "p50", "p95")])


@plan(
    "agg_crosstab_pivot",
    """select l_returnflag, count(*) filter (l_linestatus = 'F') as "F", count(*) filter (l_linestatus = 'O') as "O",
    round(count(*) filter (l_linestatus = 'F') / count(*), 6) as share_f from lineitem group by 1""",
)
def agg_crosstab_pivot(t):
    counts = t.lineitem.groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).agg(F.count(F.lit(1)))
    counts = counts.na.fill(0)
    return counts.withColumn("share_f", r6(F.col("F") / (F.col("F") + F.col("O"))))


@plan(
    "agg_unpivot_pivot_funnel",
    """with s as (select case when ts < timestamp '2024-01-16' then 'control' else 'test' end as campaign, event_type as metric, value from events)
    select metric, round(sum(value) filter (campaign = 'control') / 1000, 6) as control, round(sum(value) filter (campaign = 'test') / 1000, 6) as test
    from s where metric in ('view', 'click', 'purchase') group by 1""",
)
def agg_unpivot_pivot_funnel(t):
    half = F.when(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"), "control").otherwise("test")
    kinds = ["view", "click", "purchase"]
    sums = t.events.groupBy(half.alias("campaign")).agg(
        *[(F.sum(F.when(F.col("event_type") == k, F.col("value"))) / 1000).alias(k) for k in kinds]
    )
    long = sums.unpivot(["campaign"], kinds, "metric", "value")
    wide = long.groupBy("metric").pivot("campaign", ["control", "test"]).agg(F.max("value"))
    return wide.select("metric", r6("control").alias("control"), r6("test").alias("test"))


@plan(
    "agg_conditional_sums",
    """select user_id, count(*) filter (event_type = 'purchase') as bought, round(coalesce(sum(value) filter (event_type = 'purchase'), 0), 6) as spent,
    count(*) filter (event_type = 'error') as errors from events group by 1""",
)
def agg_conditional_sums(t):
    buy = F.col("event_type") == "purchase"
    return t.events.groupBy("user_id").agg(
        F.count_if(buy).alias("bought"),
        r6(F.sum(F.when(buy, F.col("value")).otherwise(0.0))).alias("spent"),
        F.count_if(F.col("event_type") == "error").alias("errors"),
    )


@plan("agg_min_max_span", "select o_custkey, min(o_orderdate) as first_day, max(o_orderdate) as last_day from orders group by 1")
def agg_min_max_span(t):
    return t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day"))


@plan(
    "agg_max_by_group_filter",
    """with m as (select o_custkey, max(o_totalprice) as top from orders group by 1), q as (select quantile_cont(top, 0.1) as cut from m)
    select o_custkey, top, case when top > cut then 'large' else 'small' end as size from m, q""",
)
def agg_max_by_group_filter(t):
    top = t.orders.groupBy("o_custkey").agg(F.max("o_totalprice").alias("top"))
    cut = quantile_values(top, ["top"], {"cut": 0.1})
    return top.withColumn("size", F.when(F.col("top") > cut["top_cut"], "large").otherwise("small"))


@plan(
    "agg_median_mean_by_label",
    "\nunion all ".join(
        f"""select l_returnflag, '{c}' as "column", round(avg({c}), 6) as mean, round(median({c}), 6) as median from lineitem group by 1"""
        for c in ("l_quantity", "l_extendedprice")
    ),
)
def agg_median_mean_by_label(t):
    cols = ["l_quantity", "l_extendedprice"]
    medians = exact_quantiles(t.lineitem, cols, {"median": 0.5}, ["l_returnflag"]).drop("size")
    means = t.lineitem.groupBy("l_returnflag").agg(*[F.avg(c).alias(c) for c in cols])
    means = means.unpivot(["l_returnflag"], cols, "column", "mean")
    both = attach(medians, means, ["l_returnflag", "column"])
    return both.withColumns({"mean": r6("mean"), "median": r6("median")})


@plan(
    "agg_mode",
    "\nunion all ".join(
        f"""(select '{c}' as "column", {c}::varchar as value, count(*) as n from part group by {c} order by n desc, {c}::varchar limit 1)"""
        for c in ("p_brand", "p_type", "p_size")
    ),
)
def agg_mode(t):
    return A.modes(t.part, ["p_brand", "p_type", "p_size"])


@plan("agg_class_distribution", "select quality, count(*) as n, round(count(*) / sum(count(*)) over (), 4) as share from labels group by 1")
def agg_class_distribution(t):
    return A.value_counts(t.labels, "quality").withColumn("share", r6("share", 4))


@plan(
    "agg_class_weights",
    """with c as (select quality, count(*) as n from labels group by 1), w as (select sum(n) as total, count(*) as k from c)
    select quality, n, round(n / total, 6) as share, round(total / n, 6) as inverse, round(total / (k * n), 6) as balanced,
    round(total / (2 * n), 6) as half, round((select max(n) filter (quality = 0) / max(n) filter (quality = 1) from c), 6) as neg_over_pos,
    round((select ln(max(n) filter (quality = 1) / max(n) filter (quality = 0)) from c), 6) as initial_bias from c, w""",
)
def agg_class_weights(t):
    w = A.class_weights(t.labels, "quality")
    ratio = t.labels.agg((F.count_if(F.col("quality") == 0) / F.count_if(F.col("quality") == 1)).alias("r")).scalar()
    w = w.withColumns({"neg_over_pos": ratio, "initial_bias": -F.log(ratio)})
    return w.select("quality", "n", *[r6(c).alias(c) for c in ("share", "inverse", "balanced", "half", "neg_over_pos", "initial_bias")])


@plan(
    "agg_prevalence_cost_matrix",
    """with c as (select label, count(*) as n from embeddings group by 1)
    select a.label as truth, b.label as predicted, case when a.label = b.label then 0.0::double else round(a.n / b.n, 6) end as cost from c a, c b""",
)
def agg_prevalence_cost_matrix(t):
    counts = t.embeddings.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    # the classes travel as one small array inside a scalar, then unfold next to each class
    others = counts.agg(F.collect_list(F.struct(F.col("label").alias("predicted"), F.col("n").alias("m")))).scalar()
    cells = counts.select(F.col("label").alias("truth"), "n", F.inline(others))
    cost = F.when(F.col("truth") == F.col("predicted"), 0.0).otherwise(r6(F.col("n") / F.col("m")))
    return cells.select("truth", "predicted", cost.alias("cost"))


@plan(
    "agg_recent_weights",
    """select o_orderkey, case when row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey desc) <= 3 then 2 else 1 end as weight from orders""",
)
def agg_recent_weights(t):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    # rank <= 3 per key is limited before the exchange, so a hot key sends three rows per task
    recent = t.orders.withColumn("_i", F.row_number().over(w)).filter("_i <= 3").select("o_orderkey", F.lit(2).alias("weight"))
    joined = t.orders.select("o_orderkey").join(recent, "o_orderkey", "left")
    return joined.withColumn("weight", F.coalesce("weight", F.lit(1)))


PAIRS = [(a, b) for i, a in enumerate(LI) for b in LI[i + 1 :]]


@plan(
    "agg_corr_matrix",
    "\nunion all ".join(f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) + 0.0 as r from lineitem" for a, b in PAIRS),
)
def agg_corr_matrix(t):
    return A.correlation_table(t.lineitem, LI).withColumn("r", r6("r"))


@plan(
    "agg_spearman",
    """with r as (select rank() over (order by l_quantity) + (count(*) over (partition by l_quantity) - 1) / 2 as a,
    rank() over (order by l_extendedprice) + (count(*) over (partition by l_extendedprice) - 1) / 2 as b from lineitem)
    select 'l_quantity' as a, 'l_extendedprice' as b, round(corr(a, b), 6) as r from r""",
)
def agg_spearman(t):
    return A.spearman_table(t.lineitem, ["l_quantity", "l_extendedprice"]).withColumn("r", r6("r"))


@plan(
    "agg_kendall",
    """with c as (select l_quantity as x, l_linenumber * 10 + floor(l_tax * 100) as y, count(*)::double as n from lineitem group by 1, 2),
    p as (select sum(case when a.x < b.x and a.y < b.y then a.n * b.n else 0 end) as c, sum(case when a.x < b.x and a.y > b.y then a.n * b.n else 0 end) as d from c a, c b),
    n as (select sum(n) as n from c), tx as (select sum(m * (m - 1) / 2) as t from (select sum(n) as m from c group by x)),
    ty as (select sum(m * (m - 1) / 2) as t from (select sum(n) as m from c group by y))
    select c as concordant, d as discordant, round((c - d) / (sqrt(n * (n - 1) / 2 - tx.t) * sqrt(n * (n - 1) / 2 - ty.t)), 6) + 0.0 as tau_b from p, n, tx, ty""",
)
def agg_kendall(t):
    li = t.lineitem.select("l_quantity", (F.col("l_linenumber") * 10 + F.floor(F.col("l_tax") * 100)).alias("y"))
    return A.kendall_tau_b(li, "l_quantity", "y").withColumn("tau_b", r6("tau_b"))


RATIOS = """select case when ts < timestamp '2024-01-16' then 'control' else 'test' end as campaign,
    round(count_if(event_type = 'click') / nullif(count_if(event_type = 'view'), 0), 6) as ctr,
    round(count_if(event_type = 'purchase') / nullif(count_if(event_type = 'click'), 0), 6) as conversion,
    round(sum(value) / nullif(count_if(event_type = 'click'), 0), 6) as cpc,
    round(1000 * sum(value) / nullif(count_if(event_type = 'view'), 0), 6) as cpm,
    round(sum(value) / nullif(count_if(event_type = 'purchase'), 0), 6) as cpa from events group by 1"""


@plan("agg_key_ratios_sql", RATIOS)
def agg_key_ratios_sql(t):
    return t.spark.sql(RATIOS.replace("timestamp '", "timestamp_ntz '").replace("from events", "from {ev}"), ev=t.events)


@plan(
    "agg_distinct_key_counts",
    "select count(*) as n, count(distinct l_orderkey) as keys, count(*) - count(distinct l_orderkey) as repeats from lineitem",
)
def agg_distinct_key_counts(t):
    return t.lineitem.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("l_orderkey").alias("keys")).withColumn(
        "repeats", F.col("n") - F.col("keys")
    )


@plan(
    "agg_rows_per_chunk",
    """with k as (select o_custkey, count(*) as n from orders group by 1), c as (select *, ntile(7) over (order by o_custkey) as chunk from k)
    select chunk::integer as chunk, count(*) as keys, sum(n)::bigint as rows, min(o_custkey) as first, max(o_custkey) as last from c group by 1""",
)
def agg_rows_per_chunk(t):
    return A.rows_per_chunk(t.orders, "o_custkey", 7)


@plan("agg_bootstrap_ci")
def agg_bootstrap_ci(t):
    return A.bootstrap_correlation(t.events, "event_id", "value", "user_id", 200)


@plan(
    "agg_quantile_bins_exact",
    """select distinct round(unnest(quantile_cont(value, [0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95])), 6) as edge from events""",
)
def agg_quantile_bins_exact(t):
    probabilities = [0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95]
    q = exact_quantiles(t.events, ["value"], {f"q{i}": p for i, p in enumerate(probabilities)})
    return q.select(F.explode(F.array_distinct(F.array(*[r6(f"q{i}") for i in range(len(probabilities))]))).alias("edge"))


@plan(
    "agg_histogram_rules",
    """with s as (select count(value)::double as n, min(value) as lo, max(value) as hi, stddev_pop(value) as sd,
      quantile_cont(value, 0.75) - quantile_cont(value, 0.25) as iqr, avg(value) as m from events),
    g as (select avg(pow((value - m) / sd, 3)) as g1 from events, s),
    o as (select value, sum(count(*)) over (order by value) as upto from events where value is not null group by 1),
    e as (select k, i, i * ((hi - lo) / k) + lo as edge from (select lo, hi, unnest(range(1, greatest(100, floor(sqrt(n))::bigint) + 1)) as k from s), range(1, 100000) r(i) where i < k),
    b as (select k, i, coalesce(upto, 0) as below from e asof left join o on e.edge > o.value union all select k, k, n from s, (select unnest(range(1, greatest(100, floor(sqrt(n))::bigint) + 1)) as k from s)),
    p as (select k, (below - lag(below, 1, 0) over (partition by k order by i)) / n as p, n from b, s),
    j as (select k, (2 - (max(n) + 1) * sum(p * p)) * k as risk from p group by 1),
    w as (select lo, hi, unnest([struct_pack(rule := 'sqrt', width := (hi - lo) / sqrt(n)),
      struct_pack(rule := 'sturges', width := (hi - lo) / (log2(n) + 1)),
      struct_pack(rule := 'rice', width := (hi - lo) / (2 * pow(n, 1.0::double / 3))),
      struct_pack(rule := 'scott', width := pow(24 * sqrt(pi()) / n, 1.0::double / 3) * sd),
      struct_pack(rule := 'doane', width := (hi - lo) / (1 + log2(n) + log2(1 + abs(g1) / sqrt(6 * (n - 2) / ((n + 1) * (n + 3)))))),
      struct_pack(rule := 'fd', width := 2 * iqr / pow(n, 1.0::double / 3)),
      struct_pack(rule := 'stone', width := (hi - lo) / (select arg_min(k, struct_pack(r := risk, k := k)) from j)),
      struct_pack(rule := 'auto', width := least(2 * iqr / pow(n, 1.0::double / 3), (hi - lo) / (log2(n) + 1)))]) as x from s, g)
    select x.rule as rule, round(x.width, 6) as width, ceil((hi - lo) / x.width)::bigint as bins, lo, hi from w""",
)
def agg_histogram_rules(t):
    return A.histogram_rules(t.events, "value").withColumn("width", r6("width"))
