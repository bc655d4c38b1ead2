"""Scaling, reduction, learners and clustering."""

from pyspark.sql import functions as F

from lodestat.operators import clustering as Cl
from lodestat.operators import learners as L
from lodestat.operators import scaling as Sc
from lodestat.operators import trees as Tr
from lodestat.operators import wide as Wd
from lodestat.operators.density import dbscan as density_clusters
from lodestat.operators.evaluation import knee
from lodestat.operators.ordered import hash_key
from lodestat.operators.prototypes import nearest_gower
from lodestat.operators.resampling import border_classes, borderline_smote, edit_by_neighbours, smote
from lodestat.operators.words import terms
from lodestat.plans.registry import plan, r6

LI = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
KEYS = ", ".join(KEY)
SPREADS = {
    "zscore": ("avg({c})", "stddev_pop({c})"),
    "minmax": ("min({c})", "(max({c}) - min({c}))"),
    "robust": ("median({c})", "(quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"),
    "maxabs": ("0", "max(abs({c}))"),
}


def _scale_plan(kind):
    a, b = SPREADS[kind]
    stats = ", ".join(f"{a.format(c=c)} as a_{c}, {b.format(c=c)} as b_{c}" for c in LI)
    cells = ", ".join(f"round(({c} - a_{c}) / b_{c}, 6) + 0.0 as {c}" for c in LI)

    # fitted on the training rows (before 2000), applied to all
    @plan(f"scale_{kind}", f"with s as (select {stats} from lineitem where l_shipdate < timestamp '2000-01-01') select {KEYS}, {cells} from lineitem, s")
    def run(t):
        train = t.lineitem.filter(F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
        out = Sc.fit_scaler(train, LI, kind).apply(t.lineitem.select(*KEY, *LI))
        return out.select(*KEY, *[(r6(c) + 0.0).alias(c) for c in LI])


for _kind in SPREADS:
    _scale_plan(_kind)


@plan(
    "scale_l2rows",
    """with x as (select vec_id, unnest(range(64)) as d, embedding from embeddings), v as (select vec_id, d, embedding[d + 1]::double as v from x) select vec_id, d::integer as d, round(v / sqrt(sum(v * v) over (partition by vec_id)), 6) + 0.0 as v from v""",
)
def scale_l2rows(t):
    rows = t.embeddings.select("vec_id", F.posexplode(Sc.unit_rows(F.col("embedding"))).alias("d", "v"))
    return rows.withColumn("v", r6("v") + 0.0)


COVARIANCE = {c: f"{c} / 1000" if c == "l_extendedprice" else c for c in LI}  # in thousands, so that six digits compare


@plan(
    "pca_covariance",
    "\nunion all ".join(f"select '{a}' as a, '{b}' as b, round(covar_samp({COVARIANCE[a]}, {COVARIANCE[b]}), 6) + 0.0 as covariance from lineitem" for i, a in enumerate(LI) for b in LI[i:]),
)
def pca_covariance(t):
    c = Sc.covariance(t.lineitem.withColumn("l_extendedprice", F.col("l_extendedprice") / 1000), LI)
    return c.withColumn("covariance", r6("covariance") + 0.0)


@plan("pca")
def pca(t):
    scaled = Sc.fit_scaler(t.lineitem, LI, "zscore").apply(t.lineitem)
    return Sc.components_table(scaled, Sc.fit_pca(scaled, LI))


@plan("pca_scores")
def pca_scores(t):
    scaled = Sc.fit_scaler(t.lineitem, LI, "zscore").apply(t.lineitem.select(*KEY, *LI))
    c = Sc.fit_pca(scaled, LI)
    return c.scores(scaled, c.count_for(0.95)).drop(*LI)


@plan("truncated_svd")
def truncated_svd(t):
    return Sc.truncated_svd(t.embeddings, "embedding", 0.9)


@plan("famd")
def famd(t):
    rows = t.lineitem.select(*LI, "l_returnflag", "l_linestatus")
    _, c = Sc.fit_famd(rows, LI, ["l_returnflag", "l_linestatus"])
    return Sc.components_table(rows, c)


@plan("wide_svd")
def wide_svd(t):
    """The first components of the documents' word counts, a column per word of the whole texts."""
    counts = terms(t.documents, "doc_id", "text").groupBy(F.col("doc_id").alias("row"), F.col("term").alias("column")).agg(F.count(F.lit(1)).alias("value"))
    found = Wd.wide_components(counts, 5, centre=False, tolerance=1e-7)
    return Wd.components_rows(found).withColumns({"value": r6("value", 3), "share": r6("share")})


LIN = """with s as (select count(*)::double as n, avg(l_quantity) as m1, avg(l_discount) as m2, avg(l_extendedprice) as my, var_pop(l_quantity) as v1, var_pop(l_discount) as v2, covar_pop(l_quantity, l_discount) as v12,
    covar_pop(l_quantity, l_extendedprice) as c1, covar_pop(l_discount, l_extendedprice) as c2 from lineitem), b as (select (v2 * c1 - v12 * c2) / (v1 * v2 - v12 * v12) as b1, (v1 * c2 - v12 * c1) / (v1 * v2 - v12 * v12) as b2, m1, m2, my from s)"""


@plan("linreg", LIN + " select round(my - b1 * m1 - b2 * m2, 3) as intercept, round(b1, 4) as l_quantity, round(b2, 3) as l_discount from b")
def linreg(t):
    beta = L.linear_fit(t.lineitem, "l_extendedprice", ["l_quantity", "l_discount"])
    row = [float(b) for b in beta]
    out = t.spark.createDataFrame([row], "intercept double, l_quantity double, l_discount double")
    return out.select(r6("intercept", 3).alias("intercept"), r6("l_quantity", 4).alias("l_quantity"), r6("l_discount", 3).alias("l_discount"))


@plan(
    "linreg_cost_gradient",
    """with e as (select 1.5 + 0.2::double * l_quantity - 3.0 * l_discount - l_tax * 100 as err, l_quantity, l_discount from lineitem)
    select round(avg(err * err) / 2, 6) as cost, round(avg(err), 6) as d_intercept, round(avg(err * l_quantity), 6) as "d_l_quantity", round(avg(err * l_discount), 6) as "d_l_discount" from e""",
)
def linreg_cost_gradient(t):
    g = L.cost_and_gradient(t.lineitem, F.col("l_tax") * 100, ["l_quantity", "l_discount"], [1.5, 0.2, -3.0], logistic=False)
    return g.select(*[r6(c).alias(c) for c in g.columns])


GD_COLUMNS = "round(cost, 6) as cost, round(b0, 6) as intercept, round(b1, 6) as q, round(b2, 6) as d"


def _rounded(path):
    return path.withColumns({c: r6(c) for c in path.columns if c != "iteration"})


@plan(
    "linreg_gd",
    f"""with recursive m as (select avg(q) as q, avg(d) as d, avg(y) as y, avg(q * q) as qq, avg(q * d) as qd, avg(d * d) as dd, avg(q * y) as qy, avg(d * y) as dy, avg(y * y) as yy
    from (select l_quantity / 50 as q, l_discount * 10 as d, l_extendedprice / 1e4 as y from lineitem)),
    g as (select 0::integer as iteration, 0::double as b0, 0::double as b1, 0::double as b2 union all
    select iteration + 1, b0 - 0.5::double * (b0 + b1 * q + b2 * d - y), b1 - 0.5::double * (b0 * q + b1 * qq + b2 * qd - qy), b2 - 0.5::double * (b0 * d + b1 * qd + b2 * dd - dy) from g, m where iteration < 9),
    c as (select iteration, b0, b1, b2, (b0 * b0 + b1 * b1 * qq + b2 * b2 * dd + yy) / 2 + b0 * b1 * q + b0 * b2 * d + b1 * b2 * qd - b0 * y - b1 * qy - b2 * dy as cost from g, m)
    select iteration, {GD_COLUMNS} from c""",
)
def linreg_gd(t):
    rows = t.lineitem.select((F.col("l_quantity") / 50).alias("q"), (F.col("l_discount") * 10).alias("d"), (F.col("l_extendedprice") / 1e4).alias("y"))
    return _rounded(L.gradient_descent(rows, F.col("y"), ["q", "d"], 0.5, 10, logistic=False))


@plan(
    "logreg_cost_gradient",
    """with e as (select (l_returnflag = 'R')::integer as y, 0.1 - 0.02::double * l_quantity + 2.0 * l_discount as z, l_quantity, l_discount from lineitem), g as (select *, 1 / (1 + exp(-z)) - y as err from e)
    select round((sum(greatest(z, 0) + ln(1 + exp(-abs(z))) - y * z) + 0.7::double / 2 * (0.0004 + 4)) / count(*), 6) as cost, round(avg(err), 6) as d_intercept, round((sum(err * l_quantity) + 0.7::double * -0.02) / count(*), 6) as "d_l_quantity",
    round((sum(err * l_discount) + 0.7::double * 2) / count(*), 6) as "d_l_discount" from g""",
)
def logreg_cost_gradient(t):
    g = L.cost_and_gradient(t.lineitem, F.col("l_returnflag") == "R", ["l_quantity", "l_discount"], [0.1, -0.02, 2.0], logistic=True, penalty=0.7)
    return g.select(*[r6(c).alias(c) for c in g.columns])


def _logistic_steps(iterations):
    """One aggregate for each step: e{k} has the cost and gradient at the parameters b{k}."""
    steps = ["with l as (select (l_returnflag = 'R')::integer as y, l_quantity / 50 as q, l_discount * 10 as d from lineitem), b0 as (select 0::double as b0, 0::double as b1, 0::double as b2)"]
    for k in range(iterations):
        steps.append(
            f"""e{k} as materialized (select any_value(b0) as b0, any_value(b1) as b1, any_value(b2) as b2, (sum(greatest(z, 0) + ln(1 + exp(-abs(z))) - y * z) + any_value(b1 * b1 + b2 * b2) / 2) / count(*) as cost,
            avg(err) as g0, (sum(err * q) + any_value(b1)) / count(*) as g1, (sum(err * d) + any_value(b2)) / count(*) as g2
            from (select *, 1 / (1 + exp(-z)) - y as err from (select *, b0 + b1 * q + b2 * d as z from l, b{k})))"""
        )
        steps.append(f"b{k + 1} as (select b0 - 0.5::double * g0 as b0, b1 - 0.5::double * g1 as b1, b2 - 0.5::double * g2 as b2 from e{k})")
    return ", ".join(steps) + " " + " union all ".join(f"select {k}::integer as iteration, {GD_COLUMNS} from e{k}" for k in range(iterations))


@plan("logreg_gd", _logistic_steps(10))
def logreg_gd(t):
    rows = t.lineitem.select((F.col("l_returnflag") == "R").alias("y"), (F.col("l_quantity") / 50).alias("q"), (F.col("l_discount") * 10).alias("d"))
    return _rounded(L.gradient_descent(rows, F.col("y"), ["q", "d"], 0.5, 10, logistic=True, penalty=1.0))


@plan("huber_irls")
def huber_irls(t):
    a, b = L.huber_line(t.orders.withColumn("x", F.col("o_custkey").cast("double")), "o_totalprice", "x")
    return t.spark.createDataFrame([(a, b)], "intercept double, slope double")


@plan("glm_poisson")
def glm_poisson(t):
    c = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).cast("double").alias("n"), F.avg("o_totalprice").alias("m"))
    e = c.agg(F.min("m").alias("lo"), F.max("m").alias("hi")).first()
    basis = L.spline_basis("m", e["lo"], e["hi"], 2)
    rows = c.withColumns(basis)
    return L.poisson_fit(rows, "n", list(basis)).select("o_custkey", r6("fitted").alias("fitted"), r6("residual").alias("residual"))


def _f_sql(f):
    return f"""select '{f}' as feature, round((sum(n * pow(m - gm, 2)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))), 5) as f from (select count(*) as n, avg({f}) as m, var_pop({f}) as v, (select avg({f}) from lineitem) as gm from lineitem group by l_returnflag)"""


@plan("select_k_best_f", "select * from (" + "\nunion all ".join(_f_sql(f) for f in LI) + ") order by f desc limit 2")
def select_k_best_f(t):
    return L.anova_f(t.lineitem, LI, "l_returnflag", 2).withColumn("f", r6("f", 5))


@plan("rfe")
def rfe(t):
    return L.eliminate_features(t.lineitem, "l_returnflag", LI, 2)


def _split_sql(i, f):
    return f"""select {i} as i, '{f}' as feature, v, lag(v) over (order by v) as before, sum(a) over w - a as la, sum(n) over w - n as ln, sum(r) over w - r as lr, sum(a) over () as ta, sum(n) over () as tn, sum(r) over () as tr
    from (select {f} as v, count(*) filter (l_returnflag = 'A')::double as a, count(*) filter (l_returnflag = 'N')::double as n, count(*) filter (l_returnflag = 'R')::double as r from lineitem group by 1) window w as (order by v)"""


@plan(
    "tree_best_split",
    "with s as (" + "\nunion all ".join(_split_sql(i, f) for i, f in enumerate(["l_quantity", "l_discount", "l_tax"])) + """), g as (select i, feature, (before + v) / 2 as threshold, la + ln + lr as nl, ta + tn + tr as n,
    1 - (la * la + ln * ln + lr * lr) / pow(la + ln + lr, 2) as gl, 1 - (pow(ta - la, 2) + pow(tn - ln, 2) + pow(tr - lr, 2)) / pow(ta + tn + tr - la - ln - lr, 2) as gr, 1 - (ta * ta + tn * tn + tr * tr) / pow(ta + tn + tr, 2) as gt from s where before is not null)
    select 0 as node, feature, round(threshold, 6) as threshold, round(gt - (nl * gl + (n - nl) * gr) / n, 9) as gain from g order by round((nl * gl + (n - nl) * gr) / n, 12), i, threshold limit 1""",
)
def tree_best_split(t):
    rows = t.lineitem.withColumn("node", F.lit(0))
    s = Tr.best_splits(rows, ["l_quantity", "l_discount", "l_tax"], "l_returnflag")
    return s.select("node", "feature", r6("threshold").alias("threshold"), r6("gain", 9).alias("gain"))


@plan("tree_predict_rules")
def tree_predict_rules(t):
    rules = Tr.grow(t.lineitem, ["l_quantity", "l_discount", "l_tax"], "l_returnflag", depth=3, criterion="entropy")
    return t.lineitem.groupBy("l_returnflag", rules.predict().alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def _folded(t):
    fold = F.conv(F.substring(hash_key(*KEY), 1, 4), 16, 10).cast("int") % 2
    return t.lineitem.select("l_linestatus", *LI, fold.alias("fold"))


@plan("forest_and_boosting")
def forest_and_boosting(t):
    return L.ensemble_scores(_folded(t), "l_linestatus", LI, "fold", ["tree", "forest", "bagging", "boosting"])


@plan("score_batches")
def score_batches(t):
    model = L.fit_ensemble(t.lineitem.select("l_returnflag", *LI), "l_returnflag", LI)
    return L.score_batches(t.lineitem, model, KEY)


MODELS_SQL = """with p as (select event_id, 'm1' as model, round(least(1, value / 100), 6) as p from events union all select event_id, 'm2', round((props->>'k')::integer / 100, 6) from events union all select event_id, 'm3', round(hour(ts) / 24, 6) from events)"""


def model_rows(t):
    p1 = F.least(F.lit(1.0), F.col("value") / 100)
    p2 = F.get_json_object("props", "$.k").cast("int") / 100
    p3 = F.hour("ts") / 24
    cells = F.array(*[F.struct(F.lit(f"m{i + 1}").alias("model"), F.round(p, 6).alias("p")) for i, p in enumerate((p1, p2, p3))])
    return t.events.select("event_id", F.inline(cells))


@plan(
    "ensemble_vote_stack",
    MODELS_SQL + """ select event_id, (2 * count(*) filter (p >= 0.5) > count(*))::integer as hard, round(avg(p), 6) as mean_probability, (avg(p) >= 0.5)::integer as soft, max(p) filter (model = 'm1') as m1, max(p) filter (model = 'm2') as m2, max(p) filter (model = 'm3') as m3 from p group by 1""",
)
def ensemble_vote_stack(t):
    rows = model_rows(t)
    v = L.vote(rows, "event_id", "p").withColumn("mean_probability", r6("mean_probability"))
    return v.join(L.stack_features(rows, "event_id", "model", "p", ["m1", "m2", "m3"]), "event_id")


@plan(
    "oof_predictions",
    """with e as (select event_id, user_id::double as x, value as y, event_id % 5 as fold from events), m as (select f as fold, regr_slope(y, x) as b, regr_intercept(y, x) as a from e join range(5) r(f) on e.fold <> f group by 1)
    select event_id, round(a + b * x, 6) as predicted from e join m using (fold)""",
)
def oof_predictions(t):
    e = t.events.select("event_id", F.col("user_id").cast("double").alias("x"), "value", (F.col("event_id") % 5).alias("fold"))
    return L.out_of_fold(e, "value", ["x"], "fold").select("event_id", r6("predicted").alias("predicted"))


@plan(
    "permutation_importance",
    """with e as (select event_id, user_id::double as u, hour(ts)::double as h, value as y from events), p as (select *, row_number() over (order by md5(event_id::varchar || '|42')) as i, row_number() over (order by md5(event_id::varchar || '|43')) as j from e),
    q as (select a.y, a.u, a.h, b.u as pu, b.h as ph from p a join p b on a.i = b.j), m as (select avg(pow(y - (50 - 0.05::double * u + 0.8::double * h), 2)) as base, avg(pow(y - (50 - 0.05::double * pu + 0.8::double * h), 2)) as mu, avg(pow(y - (50 - 0.05::double * u + 0.8::double * ph), 2)) as mh from q)
    select 'u' as feature, 0 as repeat, round(mu - base, 6) as increase from m union all select 'h', 0, round(mh - base, 6) from m""",
)
def permutation_importance(t):
    e = t.events.select("event_id", F.col("user_id").cast("double").alias("u"), F.hour("ts").cast("double").alias("h"), "value")
    model = lambda names: 50 - 0.05 * F.col(names[0]) + 0.8 * F.col(names[1])
    return L.permutation_importance(e, ["event_id"], "value", ["u", "h"], model).withColumn("increase", r6("increase"))


@plan(
    "topk_permutation_table",
    """with e as (select event_id, user_id::double as u, hour(ts)::double as h, value as y from events), s as (select *, row_number() over (order by md5(event_id::varchar || '|42')) as i0, row_number() over (order by md5(event_id::varchar || '|43')) as j0, row_number() over (order by md5(event_id::varchar || '|44')) as i1, row_number() over (order by md5(event_id::varchar || '|45')) as j1 from e),
    q as (select a.y, a.u, a.h, b.u as pu, b.h as ph, 0 as r from s a join s b on a.i0 = b.j0 union all select a.y, a.u, a.h, b.u, b.h, 1 from s a join s b on a.i1 = b.j1),
    m as (select r, avg(pow(y - (50 - 0.05::double * u + 0.8::double * h), 2)) as base, avg(pow(y - (50 - 0.05::double * pu + 0.8::double * h), 2)) as mu, avg(pow(y - (50 - 0.05::double * u + 0.8::double * ph), 2)) as mh from q group by 1),
    f as (select 'u' as feature, avg(mu - base) as x from m union all select 'h', avg(mh - base) from m) select feature, round(x, 6) as mean_increase from f order by x desc limit 1""",
)
def topk_permutation_table(t):
    e = t.events.select("event_id", F.col("user_id").cast("double").alias("u"), F.hour("ts").cast("double").alias("h"), "value")
    model = lambda names: 50 - 0.05 * F.col(names[0]) + 0.8 * F.col(names[1])
    p = L.permutation_importance(e, ["event_id"], "value", ["u", "h"], model, repeats=2)
    return p.groupBy("feature").agg(r6(F.avg("increase")).alias("mean_increase")).orderBy(F.desc("mean_increase")).limit(1)


# two features without intercept once centred, so each ridge fit is a two by two system over the other folds
GRID_SQL = """with e as (select user_id::double as u, hour(ts)::double as h, value as y, (event_id % 5)::integer as fold from events), k as (select distinct fold from e),
    m as (select k.fold, count(*) as n, avg(u) as mu, avg(h) as mh, avg(y) as my, var_pop(u) * count(*) as uu, var_pop(h) * count(*) as hh, covar_pop(u, h) * count(*) as uh, covar_pop(u, y) * count(*) as uy, covar_pop(h, y) * count(*) as hy
    from k join e on e.fold <> k.fold group by 1),
    b as (select *, (uy * (hh + penalty) - hy * uh) / ((uu + penalty) * (hh + penalty) - uh * uh) as bu, (hy * (uu + penalty) - uy * uh) / ((uu + penalty) * (hh + penalty) - uh * uh) as bh
    from m, unnest([0.0::double, 1, 10, 100, 1000, 1e6]) p(penalty)),
    s as (select penalty, fold, avg(pow(y - my - bu * (u - mu) - bh * (h - mh), 2)) as mse from b join e using (fold) group by 1, 2), w as (select penalty, avg(mse) as mean_mse from s group by 1)
    select penalty, fold, round(mse, 6) as mse, round(mean_mse, 6) as mean_mse, r::integer as rank from s join (select *, row_number() over (order by mean_mse) as r from w) using (penalty)"""


@plan("grid_search", GRID_SQL)
def grid_search(t):
    e = t.events.select(F.col("user_id").cast("double").alias("u"), F.hour("ts").cast("double").alias("h"), "value", (F.col("event_id") % 5).cast("int").alias("fold"))
    return L.ridge_grid(e, "value", ["u", "h"], "fold", [0.0, 1.0, 10.0, 100.0, 1000.0, 1e6]).withColumns({"mse": r6("mse"), "mean_mse": r6("mean_mse")})


@plan("smote_enn")
def smote_enn(t):
    rare = t.embeddings.groupBy("label").count().orderBy("count", "label").first()["label"]
    made = smote(t.embeddings, "vec_id", "embedding", "label", rare, per_row=2)
    old = t.embeddings.select(F.col("vec_id").cast("string").alias("row"), "label", F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    both = old.unionByName(made.select("row", "label", "embedding"))
    kept = edit_by_neighbours(both, "row", "embedding", "label", 3)
    return kept.select("row", "label")


def rarest(t):
    return t.embeddings.groupBy("label").count().orderBy("count", "label").first()["label"]


@plan(
    "borderline_danger",
    """with r as (select label from embeddings group by 1 order by count(*), label limit 1), k as (select a.vec_id as query, b.label, row_number() over (partition by a.vec_id order by list_distance(a.embedding::double[], b.embedding::double[]), b.vec_id) as rank
        from embeddings a join r using (label) join embeddings b on a.vec_id <> b.vec_id),
    c as (select query, count(*) filter (label is distinct from (select label from r)) as others, count(*) as n from k where rank <= 10 group by 1)
    select query, others, case when others = n then 'noise' when 2 * others >= n then 'danger' else 'safe' end as border from c""",
)
def borderline_danger(t):
    return border_classes(t.embeddings, "vec_id", "embedding", "label", rarest(t))


@plan("borderline_smote")
def borderline_rows(t):
    return borderline_smote(t.embeddings, "vec_id", "embedding", "label", rarest(t), per_row=2, kind=2)


AXES = [f"x{i}" for i in range(64)]


def _assign(cents):
    return f"select vec_id, arg_min(c, struct_pack(d := dd, c := c)) as c from (select vec_id, c, sum(pow(v - cv, 2)) as dd from p join {cents} using (d) group by 1, 2) group by 1"


def _means(placed):
    return f"select c, d, avg(v) as cv from p join {placed} using (vec_id) group by 1, 2"


@plan(
    "kmeans_lloyd",
    f"""with p as materialized (select vec_id, unnest(range(64)) as d, unnest(embedding)::double as v from embeddings), s as (select vec_id, (row_number() over (order by vec_id) - 1)::integer as c from embeddings order by vec_id limit 3),
    c0 as (select c, d, v as cv from p join s using (vec_id)), a0 as ({_assign('c0')}), c1 as ({_means('a0')}), a1 as ({_assign('c1')}), c2 as ({_means('a1')}), a2 as ({_assign('c2')})
    select c as cluster, count(distinct vec_id) as n, round(sum(pow(v - cv, 2)), 6) as cost from p join a2 using (vec_id) join c2 using (c, d) group by 1""",
)
def kmeans_lloyd(t):
    p = t.embeddings.select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(AXES)])
    seeds = [[r[c] for c in AXES] for r in p.orderBy("vec_id").limit(3).collect()]
    rows, _ = Cl.lloyd(p, AXES, seeds, 2)
    return rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("d2")).alias("cost"))


@plan("geo_kmeans_label")
def geo_kmeans_label(t):
    p = t.embeddings.select("vec_id", *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(AXES)])
    ready, models, curve = Cl.kmeans_elbow(p, AXES, range(4, 13))
    k = knee(curve, "k", "cost").first()["k"]
    return models[k].transform(ready).select("vec_id", "cluster")


@plan("kprototypes")
def kprototypes(t):
    o = t.orders.select("o_orderkey", (F.col("o_totalprice") / 1e5).alias("price"), "o_orderstatus", "o_orderpriority")
    gamma = Cl.mixed_gamma(o, ["price"], ["o_orderstatus", "o_orderpriority"])
    seeds = [r.asDict() for r in o.orderBy(hash_key("o_orderkey")).limit(3).collect()]
    rows, _ = Cl.k_prototypes(o, ["price"], ["o_orderstatus", "o_orderpriority"], seeds, gamma)
    return rows.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), r6(F.sum("cost")).alias("cost"))


PART_RANGE = "select max(p_size) - min(p_size) as rs, max(p_retailprice) - min(p_retailprice) as rp from part"


@plan(
    "gower_distance",
    f"""with g as ({PART_RANGE}), p as (select arg_min(p_partkey, p_partkey) as k, p_type as pt, arg_min(p_size, p_partkey) as s, arg_min(p_retailprice, p_partkey) as pr, arg_min(p_brand, p_partkey) as br from part group by p_type),
    d as (select p_partkey, k, (abs(p_size - s) / rs + abs(p_retailprice - pr) / rp + (p_type <> pt)::integer + (p_brand <> br)::integer) / 4 as d from part, p, g)
    select p_partkey, arg_min(k, struct_pack(d := round(d, 9), k := k)) as nearest, round(min(d), 6) as distance from d group by 1""",
)
def gower_distance(t):
    numeric, categorical = ["p_size", "p_retailprice"], ["p_type", "p_brand"]
    first = t.part.groupBy("p_type").agg(F.min_by(F.struct("p_partkey", "p_size", "p_retailprice", "p_brand"), "p_partkey").alias("r"))
    found = nearest_gower(t.part, "p_partkey", first.select("p_type", "r.*"), "p_partkey", numeric, categorical, Cl.column_ranges(t.part, numeric))
    return found.select("p_partkey", "nearest", r6("distance").alias("distance"))


@plan("dbscan")
def dbscan(t):
    p = t.lineitem.select(F.col("l_orderkey"), (F.col("l_extendedprice") / 1000).alias("x"), F.col("l_quantity").alias("y"))
    keyed = p.withColumn("row", F.xxhash64("l_orderkey", "x", "y"))
    c = density_clusters(keyed, "row", "x", "y", eps=0.9, min_points=6)
    return c.groupBy("cluster", "core").agg(F.count(F.lit(1)).alias("n"))


@plan(
    "kmedoids_step",
    f"""with g as ({PART_RANGE}), d as (select a.p_type, a.p_partkey as k, sum((abs(a.p_size - b.p_size) / rs + abs(a.p_retailprice - b.p_retailprice) / rp + (a.p_brand <> b.p_brand)::integer) / 3) as total from part a join part b on a.p_type = b.p_type, g group by 1, 2)
    select p_type, arg_min(k, struct_pack(t := round(total, 6), k := k)) as medoid, round(min(total), 4) as total from d group by 1""",
)
def kmedoids_step(t):
    numeric = ["p_size", "p_retailprice"]
    m = Cl.gower_medoids(t.part, "p_partkey", "p_type", numeric, ["p_brand"], Cl.column_ranges(t.part, numeric))
    return m.withColumn("total", r6("total", 4))
