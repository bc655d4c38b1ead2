"""Model-evaluation tables, splits and folds."""

from pyspark.sql import functions as F

from lodestat.operators import evaluation as Ev
from lodestat.operators import ranking as R
from lodestat.operators import splits as Sp
from lodestat.operators.clustering import cluster_indices as indices
from lodestat.plans.registry import plan, r6
from lodestat.plans.windows import SCORE_SQL, daily, DAILY, scored



def y():
    return F.col("y")


PRED = "score >= 6"

EMB_SQL = "with e as (select vec_id, label as truth, case when vec_id % 3 = 0 then (label + 1) % 10 else label end as predicted, vec_id % 4 as fold from embeddings)"


def labelled(t):
    predicted = F.when(F.col("vec_id") % 3 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return t.embeddings.select("vec_id", F.col("label").alias("truth"), predicted.alias("predicted"), (F.col("vec_id") % 4).alias("fold"))


@plan("confusion_table", EMB_SQL + " select truth, predicted, count(*) as n, round(count(*) / sum(count(*)) over (partition by truth), 6) as share from e group by 1, 2")
def confusion_table(t):
    return Ev.confusion(labelled(t), "truth", "predicted").withColumn("share", r6("share"))


@plan(
    "binary_metrics",
    SCORE_SQL + f""", c as (select count_if(y and {PRED}) as tp, count_if(not y and {PRED}) as fp, count_if(y and not {PRED}) as fn, count_if(not y and not {PRED}) as tn from e)
    select tp::bigint as tp, fp::bigint as fp, fn::bigint as fn, tn::bigint as tn, round(tp / (tp + fp), 6) as precision, round(tp / (tp + fn), 6) as recall, round(2 * tp / (2 * tp + fp + fn), 6) as f1, round((tp + tn) / (tp + fp + fn + tn), 6) as accuracy from c""",
)
def binary_metrics(t):
    m = Ev.binary_metrics(scored(t), y(), F.expr(PRED))
    return m.withColumns({c: r6(c) for c in ("precision", "recall", "f1", "accuracy")})


@plan(
    "balanced_accuracy",
    EMB_SQL + """, r as (select fold, truth, avg((truth = predicted)::integer) as r from e group by 1, 2)
    select fold, round(avg(r), 6) as balanced, round((avg(r) - 1 / count(*)) / (1 - 1 / count(*)), 6) as adjusted from r group by 1""",
)
def balanced_accuracy(t):
    b = Ev.balanced_accuracy(labelled(t), "truth", "predicted", "fold")
    return b.withColumns({"balanced": r6("balanced"), "adjusted": r6("adjusted")})


@plan(
    "classification_report",
    EMB_SQL + """, k as (select l.label, count(*) filter (truth = l.label) as support, count(*) filter (predicted = l.label) as p, count(*) filter (truth = l.label and predicted = l.label) as h from e, (select distinct truth as label from e) l group by 1),
    r as (select label::varchar as label, h / p as precision, h / support as recall, 2 * h / (p + support) as f1, support from k)
    select label, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from r
    union all select 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::bigint from r
    union all select 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support)::bigint from r""",
)
def classification_report(t):
    c = Ev.classification_report(labelled(t), "truth", "predicted")
    return c.withColumns({m: r6(m) for m in ("precision", "recall", "f1")})


@plan(
    "roc_pr_curve",
    SCORE_SQL + """, w as (select score, count_if(y)::double as p, count_if(not y)::double as n from e group by 1), c as (select score, sum(p) over o as cp, sum(n) over o as cn, sum(p) over () as tp, sum(n) over () as tn from w window o as (order by score desc))
    select score as threshold, round(cp / tp, 6) as tpr, round(cn / tn, 6) as fpr, round(cp / (cp + cn), 6) as precision from c""",
)
def roc_pr_curve(t):
    p = R.roc_pr_points(scored(t), "score", y())
    return p.select("threshold", *[r6(c).alias(c) for c in ("tpr", "fpr", "precision")])


@plan(
    "auc_average_precision",
    SCORE_SQL + """, w as (select score, count_if(y)::double as p, count_if(not y)::double as n from e group by 1), c as (select score, p, n, sum(p) over (order by score desc) as cp, sum(n) over (order by score desc) as cn from w)
    select round(sum(n * (cp - p / 2)) / (sum(p) * sum(n)), 6) as auc, round(sum(cp / (cp + cn) * p) / sum(p), 6) as average_precision from c""",
)
def auc_average_precision(t):
    rows = scored(t)
    table = R.score_table(rows, "score", y())
    area = R.auc(rows, "score", y())
    ap = R.average_precision(table, R.totals(rows, y())["pos"])
    return area.select(r6("auc").alias("auc"), r6(ap.scalar()).alias("average_precision"))


CLASS_SCORES = [f"p{k}" for k in range(10)]


def class_scored(t):
    return t.embeddings.select(F.col("label").alias("truth"), *[F.get("embedding", F.lit(k)).alias(f"p{k}") for k in range(10)])


@plan(
    "auc_ovr_ovo",
    """with l as (select label, unnest(range(10)) as k, embedding from embeddings), s as (select label, k, embedding[k + 1]::double as s from l),
    a as (select p.k, sum(case when p.s > n.s then 1 when p.s = n.s then 0.5 else 0 end) / count(*) as auc from s p join s n on p.k = n.k and p.label = p.k and n.label <> n.k group by 1),
    o as (select p.label as i, n.label as j, sum(case when p.s > n.s then 1 when p.s = n.s then 0.5 else 0 end) / count(*) as auc from s p join s n on p.k = n.k and p.label = p.k and n.label <> n.k group by 1, 2),
    w as (select label as k, count(*) as m from embeddings group by 1)
    select round(sum(auc * m) / sum(m), 6) as ovr_weighted, round((select avg(auc) from o), 6) as ovo_mean from a join w using (k)""",
)
def auc_ovr_ovo(t):
    rows = class_scored(t)
    ovr = Ev.auc_one_vs_rest(rows, "truth", CLASS_SCORES).agg((F.sum(F.col("auc") * F.col("support")) / F.sum("support")).alias("v"))
    ovo = Ev.auc_one_vs_one(rows, "truth", CLASS_SCORES).agg(F.avg("auc").alias("v"))
    return ovr.select(r6("v").alias("ovr_weighted"), r6(ovo.scalar()).alias("ovo_mean"))


@plan(
    "log_loss_balanced",
    """with e as (select event_type = 'purchase' as y, greatest(2.220446049250313e-16::double, least(1 - 2.220446049250313e-16::double, value / 500)) as p from events)
    select round((avg(-ln(1 - p)) filter (not y) + avg(-ln(p)) filter (y)) / 2, 6) as log_loss from e""",
)
def log_loss_balanced(t):
    return Ev.balanced_log_loss(scored(t), y(), F.col("value") / 500).select(r6("log_loss").alias("log_loss"))


@plan(
    "amex_metric",
    SCORE_SQL + """, w as (select score, count_if(y)::double as p, count_if(not y) * 20.0::double as n from e group by 1),
    c as (select score, p, n, sum(p) over (order by score desc) / sum(p) over () as cap, sum(p + n) over (order by score desc) / sum(p + n) over () as ws, (p + n) / sum(p + n) over () as step, sum(p) over () / sum(p + n) over () as base from w),
    g as (select sum((cap - ws) * step) / ((1 - max(base)) / 2) as gini, coalesce(max(cap) filter (ws <= 0.04), 0) as top_share from c)
    select round(gini, 6) as gini, round(top_share, 6) as top_share, round((gini + top_share) / 2, 6) as metric from g""",
)
def amex_metric(t):
    m = R.amex_metric(scored(t), "score", y())
    return m.select(*[r6(c).alias(c) for c in ("gini", "top_share", "metric")])


@plan(
    "calibration_curve",
    """with e as (select event_type = 'purchase' as y, value / 500 as p from events) select least(floor(p * 10), 9)::bigint as bin, round(avg(p), 6) as predicted, round(avg(y::integer), 6) as observed, count(*) as n from e group by 1""",
)
def calibration_curve(t):
    c = Ev.calibration(scored(t), y(), F.col("value") / 500, 10)
    return c.withColumns({"predicted": r6("predicted"), "observed": r6("observed")})


@plan(
    "cost_curve",
    """with e as (select event_type = 'purchase' as y, value, value / 400 as s from events), g as (select i / 100 as threshold from range(101) x(i))
    select threshold, round(sum(case when not y and s + 1e-11 >= threshold then 12.5 when y and s + 1e-11 < threshold then value else 0 end), 4) as cost from e, g group by 1""",
)
def cost_curve(t):
    c = Ev.cost_curve(scored(t), F.col("value") / 400, y(), F.col("value"), 12.5)
    return c.withColumn("cost", r6("cost", 4))


@plan(
    "error_distribution",
    SCORE_SQL + f""" select case when y then 'false_negative' else 'false_positive' end as kind, (floor(value / 25) * 25)::double as low, count(*) as n from e where y <> ({PRED}) group by 1, 2""",
)
def error_distribution(t):
    return Ev.error_histogram(scored(t), F.col("value"), y(), F.expr(PRED), 25.0)


@plan(
    "regression_errors",
    """with e as (select o_totalprice as a, 250000 + (o_custkey % 100) * 100.0::double as p from orders) select round(avg(pow(a - p, 2)), 0) as mse, round(sqrt(avg(pow(a - p, 2))), 4) as rmse, round(avg(abs(a - p)), 4) as mae, round(avg(abs((a - p) / a)), 6) as mape,
    round(avg(2 * abs(a - p) / (abs(a) + abs(p))), 6) as smape from e""",
)
def regression_errors(t):
    e = Ev.regression_errors(t.orders, F.col("o_totalprice"), 250000 + (F.col("o_custkey") % 100) * 100.0)
    digits = {"mse": 0, "rmse": 4, "mae": 4, "mape": 6, "smape": 6}
    return e.select(*[r6(c, d).alias(c) for c, d in digits.items()])


@plan(
    "pinball_loss",
    "\nunion all ".join(
        f"select {a}::double as alpha, round(avg(greatest({a} * (value - {p}), ({a} - 1) * (value - {p}))), 6) as loss from events" for a, p in ((0.1, 5), (0.5, 30), (0.9, 120))
    ),
)
def pinball_loss(t):
    p = Ev.pinball(t.events, F.col("value"), {0.1: F.lit(5.0), 0.5: F.lit(30.0), 0.9: F.lit(120.0)})
    return p.withColumn("loss", r6("loss"))


LOW, HIGH = "10 + event_id % 7", "80 + event_id % 11"


@plan(
    "interval_coverage_width",
    f"select round(avg((value >= {LOW} and value <= {HIGH})::integer), 6) as coverage, round(avg({HIGH} - ({LOW})), 6) as mean_width from events",
)
def interval_coverage_width(t):
    q = Ev.interval_quality(t.events, F.col("value"), F.expr(LOW), F.expr(HIGH))
    return q.withColumns({"coverage": r6("coverage"), "mean_width": r6("mean_width")})


SCORES_SQL = {
    "absolute": "abs(value - 40)", "gamma": "abs(value - 40) / 40", "normalised": "abs(value - 40) / (5 + event_id % 7)",
    "lower": f"{LOW} - value", "upper": f"value - ({HIGH})",
}


@plan(
    "conformal_quantile",
    "\nunion all ".join(
        f"""select '{n}' as "column", round(max(s) filter (i = ceil(0.9::double * (n + 1))), 6) as quantile, max(n) as size from (select {c} as s, row_number() over (order by {c}) as i, count(*) over () as n from events)"""
        for n, c in SCORES_SQL.items()
    ),
)
def conformal_quantile(t):
    v = F.col("value")
    scores = Ev.conformal_scores(v, F.lit(40.0), 5 + F.col("event_id") % 7, F.expr(LOW), F.expr(HIGH))
    return Ev.conformal_quantiles(t.events, scores, 0.1).withColumn("quantile", r6("quantile"))


@plan(
    "split_prop_table",
    """with e as (select o_orderstatus as label, md5(o_orderkey::varchar || '|42') < 'c' as train from orders), c as (select label, count(*) / sum(count(*)) over () as overall, count(*) filter (train) / sum(count(*) filter (train)) over () as train, count(*) filter (not train) / sum(count(*) filter (not train)) over () as test from e group by 1)
    select label, round(overall, 6) as overall, round(train, 6) as train, round(test, 6) as test, round((train / overall - 1) * 100, 6) + 0.0 as train_error, round((test / overall - 1) * 100, 6) + 0.0 as test_error from c""",
)
def split_prop_table(t):
    from lodestat.operators.ordered import hash_key

    inside = hash_key("o_orderkey") < "c"
    s = Ev.split_shares({"train": t.orders.filter(inside), "test": t.orders.filter(~inside)}, "o_orderstatus")
    return s.select("label", *[r6(c).alias(c) for c in s.columns if c != "label"])


def _dffits_sql(f):
    return f"""abs((l_extendedprice - my - c_{f} / v_{f} * ({f} - m_{f})) / sqrt(n * (vy - c_{f} * c_{f} / v_{f}) / (n - 2) * (1 - (1 / n + pow({f} - m_{f}, 2) / (n * v_{f}))))
    * sqrt((1 / n + pow({f} - m_{f}, 2) / (n * v_{f})) / (1 - (1 / n + pow({f} - m_{f}, 2) / (n * v_{f}))))) > 2 * sqrt(2 / n)"""


@plan(
    "outlier_dffits",
    """with s as (select count(*)::double as n, avg(l_extendedprice) as my, var_pop(l_extendedprice) as vy, """
    + ", ".join(f"avg({f}) as m_{f}, var_pop({f}) as v_{f}, covar_pop({f}, l_extendedprice) as c_{f}" for f in ("l_quantity", "l_tax"))
    + f""" from lineitem), f as (select ({_dffits_sql('l_quantity')})::integer as l_quantity_flag, ({_dffits_sql('l_tax')})::integer as l_tax_flag from lineitem, s)
    select l_quantity_flag, l_tax_flag, greatest(l_quantity_flag, l_tax_flag) as any_flag, count(*) as n from f group by 1, 2, 3""",
)
def outlier_dffits(t):
    f = Ev.dffits_flags(t.lineitem, "l_extendedprice", ["l_quantity", "l_tax"])
    return f.groupBy("l_quantity_flag", "l_tax_flag", "any_flag").agg(F.count(F.lit(1)).alias("n"))


@plan(
    "cluster_indices",
    """with x as (select vec_id, label, unnest(range(64)) as d, embedding from embeddings), p as (select vec_id, label, d, embedding[d + 1]::double as v from x),
    c as (select label, d, avg(v) as m, sum(v) as s, count(*) as n from p group by 1, 2), g as (select d, avg(v) as m from p group by 1),
    w as (select p.vec_id, p.label, sum(pow(v - m, 2)) as d2 from p join c using (label, d) group by 1, 2),
    wl as (select label, sum(d2) as ss, avg(sqrt(d2)) as spread, count(*) as n from w group by 1),
    b as (select sum(n * pow(c.m - g.m, 2)) as ssb from c join g using (d)),
    k as (select count(*) as k, sum(n) as n, sum(ss) as ssw from wl),
    dist as (select a.label as i, b.label as j, sqrt(sum(pow(a.m - b.m, 2))) as dd from c a join c b on a.d = b.d and a.label <> b.label group by 1, 2),
    r as (select i, max((x.spread + y.spread) / dd) as r from dist join wl x on x.label = i join wl y on y.label = j group by 1),
    q as (select vec_id, label, sum(v * v) as sq from p group by 1, 2), psi as (select label, sum(sq) as psi, count(*) as n from q group by 1),
    sil as (select q.vec_id, q.label, psi.label as other, psi.n, q.sq + psi.psi / psi.n - 2 * sum(p.v * c.s) / psi.n as md from q, psi join c on c.label = psi.label join p on p.d = c.d where p.vec_id = q.vec_id group by q.vec_id, q.label, psi.label, psi.n, q.sq, psi.psi),
    ab as (select vec_id, max(md * n / (n - 1)) filter (label = other) as a, min(md) filter (label <> other) as b from sil group by 1)
    select round(ssb / (k - 1) / (ssw / (n - k)), 5) as calinski_harabasz, round((select avg(r) from r), 5) as davies_bouldin, round((select avg((b - a) / greatest(a, b)) from ab), 5) as silhouette from b, k""",
)
def cluster_indices(t):
    return indices(t.embeddings, "embedding", "label").select(
        r6("calinski_harabasz", 5).alias("calinski_harabasz"), r6("davies_bouldin", 5).alias("davies_bouldin"), r6("silhouette", 5).alias("silhouette")
    )


@plan(
    "kde_grid",
    """with s as (select count(*) as n, stddev_samp(value) as sd, min(value) as lo, max(value) as hi from events), c as (select value as c, count(*) as m from events group by 1)
    select i::integer as i, round(lo + i * (hi - lo) / 99, 6) as x, round(sum(m * exp(-pow((lo + i * (hi - lo) / 99 - c) / (sd * pow(n, -0.2::double)), 2) / 2)) / (n * sd * pow(n, -0.2::double) * sqrt(2 * pi())), 8) as density
    from c, s, range(100) r(i) group by i, lo, hi, n, sd""",
)
def kde_grid(t):
    k = Ev.kde_on_grid(t.events, F.col("value"), 100)
    return k.select("i", r6("x").alias("x"), r6("density", 8).alias("density"))


@plan(
    "knee_point",
    """with c as (select floor(value / 10)::bigint as x, count(*)::double as y from events group by 1), s as (select *, (1 - (x - min(x) over ()) / (max(x) over () - min(x) over ())) - (y - min(y) over ()) / (max(y) over () - min(y) over ()) as gap from c)
    select x, y, round(gap, 6) as gap from s order by gap desc, x limit 1""",
)
def knee_point(t):
    curve = t.events.groupBy(F.floor(F.col("value") / 10).alias("x")).agg(F.count(F.lit(1)).cast("double").alias("y"))
    return Ev.knee(curve, "x", "y").withColumn("gap", r6("gap"))


# ---- splits and folds

SHARES = {"train": 0.6, "calibration": 0.32, "test": 0.08}


@plan("split_hash")
def split_hash(t):
    return Sp.split_crc32(t.orders.select("o_orderkey"), "o_orderkey", 0.2)


@plan(
    "split_random_3way",
    """with h as (select o_orderkey, ('0x' || md5(o_orderkey::varchar || '|42')[:8])::bigint / 4294967296 as p from orders) select o_orderkey, case when p < 0.6 then 'train' when p < 0.92 then 'calibration' else 'test' end as split from h""",
)
def split_random_3way(t):
    return Sp.split_by_bucket(t.orders.select("o_orderkey"), ["o_orderkey"], SHARES)


@plan(
    "split_stratified",
    """with r as (select doc_id, quality, row_number() over (partition by quality order by md5(doc_id::varchar || '|42')) as i, count(*) over (partition by quality) as n from labels)
    select doc_id, quality, case when i <= round(n * 0.7) then 'train' when i <= round(n * 0.85) then 'validation' else 'test' end as split from r""",
)
def split_stratified(t):
    return Sp.split_stratified(t.labels.select("doc_id", "quality"), ["doc_id"], "quality", {"train": 0.7, "validation": 0.15, "test": 0.15})


@plan(
    "split_exact_per_class",
    """with r as (select doc_id, quality, row_number() over (partition by quality order by md5(doc_id::varchar || '|42')) as i, count(*) over (partition by quality) as n from labels)
    select doc_id, quality, case when i <= floor(n * 0.7::double) then 'train' when i <= floor(n * 0.7::double) + floor(n * 0.15::double) then 'validation' else 'test' end as split from r""",
)
def split_exact_per_class(t):
    return Sp.split_exact_counts(t.labels.select("doc_id", "quality"), ["doc_id"], "quality", {"train": 0.7, "validation": 0.15, "test": 0.15})


@plan(
    "split_stratified_group",
    """with g as (select user_id, count(*) as n, count(*) filter (event_type = 'purchase') as pos from events group by 1),
    r as (select *, row_number() over (order by pos / n, user_id) as i, count(*) over () as k from g), b as (select *, ((i - 1) * 5 // k)::bigint as stratum from r),
    s as (select *, (row_number() over (partition by stratum order by n desc, user_id) - 1) % 20 as slot from b)
    select user_id, case when case when slot < 10 then slot else 19 - slot end < 6 then 'train' when case when slot < 10 then slot else 19 - slot end < 8 then 'validation' else 'test' end as split from s""",
)
def split_stratified_group(t):
    return Sp.split_groups(t.events, "user_id", F.col("event_type") == "purchase", {"train": 6, "validation": 2, "test": 2})


@plan(
    "fold_assign",
    """select o_orderkey, ((row_number() over (partition by o_orderstatus order by md5(o_orderkey::varchar || '|42')) - 1) % 5)::integer as outer_fold,
    ((row_number() over (partition by o_orderstatus order by md5(o_orderkey::varchar || '|7')) - 1) % 3)::integer as inner_fold from orders""",
)
def fold_assign(t):
    rows = t.orders.select("o_orderkey", "o_orderstatus")
    outer = Sp.fold_numbers(rows, ["o_orderkey"], 5, ["o_orderstatus"], out="outer_fold")
    inner = Sp.fold_numbers(outer, ["o_orderkey"], 3, ["o_orderstatus"], seed=7, out="inner_fold")
    return inner.drop("o_orderstatus")


@plan(
    "fold_assign_grouped",
    """with c as (select distinct o_custkey from orders), f as (select o_custkey, ((row_number() over (order by md5(o_custkey::varchar || '|42')) - 1) % 5)::integer as fold from c) select o_orderkey, fold from orders join f using (o_custkey)""",
)
def fold_assign_grouped(t):
    return Sp.fold_numbers(t.orders.select("o_orderkey", "o_custkey"), ["o_orderkey"], 5, group="o_custkey").drop("o_custkey")


@plan("split_temporal", DAILY + " select day, total, case when dense_rank() over (order by day desc) <= 7 then 'test' else 'train' end as split from d")
def split_temporal(t):
    return Sp.split_last_periods(daily(t), "day", 7)


@plan(
    "cv_sliding_windows",
    DAILY + """, n as (select day, total, row_number() over (order by day) - 1 as i, count(*) over () as n from d), j as (select unnest(range(0, ((select max(n) from n) - 3 - 10) // 4 + 1)) as split)
    select split, day, case when i < split * 4 + 10 then 'train' else 'test' end as part from j join n on i >= split * 4 and i < split * 4 + 13""",
)
def cv_sliding_windows(t):
    return Sp.sliding_windows(daily(t), "day", window=10, horizon=3, step=4).select("split", "day", "part")
