"""Two-sample tests, contingency tests and posteriors.

Every test reads its rows once in a grouped count and does the rest on the counts.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.functions import special as sp
from lodestat.operators.ordered import running_totals
from lodestat.operators.quantiles import attach, exact_quantiles

chi2_tail = sp.as_udf(sp.chi2_tail, 2)
t_two_sided = sp.as_udf(sp.t_two_sided, 2)
normal_two_sided = sp.as_udf(lambda z: math.erfc(abs(z) / math.sqrt(2)), 1)
normal_upper = sp.as_udf(lambda z: 0.5 * math.erfc(z / math.sqrt(2)), 1)
log_gamma = sp.as_udf(math.lgamma, 1)
digamma = sp.as_udf(sp.digamma, 1)
beta_quantile = sp.as_udf(sp.beta_quantile, 3)


def z_test_proportions(table: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Pooled z test and Cohen's h for rows (metric, n1, s1, n0, s0); 1 is treatment, 0 control."""
    p1, p0 = F.col("s1") / F.col("n1"), F.col("s0") / F.col("n0")
    pooled = (F.col("s1") + F.col("s0")) / (F.col("n1") + F.col("n0"))
    sd = F.sqrt(pooled * (1 - pooled) * (1 / F.col("n1") + 1 / F.col("n0")))
    out = table.select(
        "metric", p1.alias("p1"), p0.alias("p0"), (p1 - p0).alias("diff"), ((p1 - p0) / sd).alias("z"),
        (2 * F.asin(F.sqrt(p1)) - 2 * F.asin(F.sqrt(p0))).alias("effect"),
    )
    size = F.abs("effect")
    return out.withColumn("p_value", normal_two_sided("z")).withColumns(
        {
            "significant": F.when(F.col("p_value") < alpha, "yes").otherwise("no"),
            "reading": F.when(size < 0.2, "small").when(size < 0.5, "medium").otherwise("large"),
        }
    )


def pooled_value_table(df: DataFrame, value: str, second: Column) -> DataFrame:
    """Distinct values with counts of both samples and pooled and own midranks."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("value")).agg(
        F.count_if(~second).alias("n1"), F.count_if(second).alias("n2")
    )
    t = running_totals(counts, "value", ["n1", "n2"])
    both = F.col("n1") + F.col("n2")
    return t.select(
        "value", "n1", "n2", both.alias("t"),
        (F.col("cum_n1") + F.col("cum_n2") - (both - 1) / 2).alias("rank"),
        (F.col("cum_n1") - (F.col("n1") - 1) / 2).alias("rank1"),
        (F.col("cum_n2") - (F.col("n2") - 1) / 2).alias("rank2"),
    )


def brunner_munzel(df: DataFrame, value: str, second: Column) -> DataFrame:
    """Brunner-Munzel statistic, its t degrees of freedom, p value and the relative effect."""
    t = pooled_value_table(df, value, second)
    d1, d2 = F.col("rank") - F.col("rank1"), F.col("rank") - F.col("rank2")
    row = t.agg(
        F.sum("n1").cast("double").alias("n1"), F.sum("n2").cast("double").alias("n2"),
        F.sum(F.col("n1") * F.col("rank")).alias("r1"), F.sum(F.col("n2") * F.col("rank")).alias("r2"),
        F.sum(F.col("n1") * d1).alias("a1"), F.sum(F.col("n1") * d1 * d1).alias("b1"),
        F.sum(F.col("n2") * d2).alias("a2"), F.sum(F.col("n2") * d2 * d2).alias("b2"),
    )
    row = row.withColumns(
        {"v1": F.expr("n1 * (b1 - a1 * a1 / n1) / (n1 - 1)"), "v2": F.expr("n2 * (b2 - a2 * a2 / n2) / (n2 - 1)")}
    )
    row = row.select(
        F.expr("n1 * n2 * (r2 / n2 - r1 / n1) / ((n1 + n2) * sqrt(v1 + v2))").alias("statistic"),
        F.expr("pow(v1 + v2, 2) / (v1 * v1 / (n1 - 1) + v2 * v2 / (n2 - 1))").alias("df"),
        F.expr("(r2 / n2 - (n2 + 1) / 2) / n1").alias("effect"),
    )
    return row.withColumn("p_value", t_two_sided("statistic", "df"))


def mann_whitney(df: DataFrame, value: str, second: Column) -> DataFrame:
    """U of both samples and the tie-corrected normal approximation with continuity correction."""
    t = pooled_value_table(df, value, second)
    row = t.agg(
        F.sum("n1").cast("double").alias("n1"), F.sum("n2").cast("double").alias("n2"),
        F.sum(F.col("n1") * F.col("rank")).alias("r1"),
        F.sum(F.pow("t", F.lit(3)) - F.col("t")).alias("ties"),
    )
    row = row.select(
        "n1", "n2", "ties", F.expr("r1 - n1 * (n1 + 1) / 2").alias("u1"), F.expr("n1 + n2").alias("n")
    ).withColumn("u2", F.expr("n1 * n2 - u1"))
    sd = F.expr("sqrt(n1 * n2 / 12 * (n + 1 - ties / (n * (n - 1))))")
    row = row.select("u1", "u2", ((F.greatest("u1", "u2") - F.expr("n1 * n2 / 2") - 0.5) / sd).alias("z"))
    return row.withColumn("p_value", F.least(F.lit(1.0), 2 * normal_upper("z")))


def ordinal_sample_size(
    shares: DataFrame, order: str, control: str, treatment: str, treatment_fraction: float, alpha: float = 0.05, power: float = 0.8
) -> DataFrame:
    """Total sample size for the rank-sum test on ordinal outcomes with ties."""
    q = (sp.normal_quantile(1 - alpha / 2) + sp.normal_quantile(power)) ** 2
    f = treatment_fraction
    t = running_totals(shares, order, [treatment])
    c, x = F.col(control), F.col(treatment)
    row = t.agg(
        F.sum(F.pow((1 - f) * c + f * x, F.lit(3))).alias("cubes"),
        F.sum(c * (F.col(f"cum_{treatment}") - x) + 0.5 * c * x).alias("effect"),
    )
    null_variance = (1 - F.col("cubes")) / (12 * f * (1 - f))
    return row.select("effect", (q * null_variance / F.pow(F.col("effect") - 0.5, F.lit(2))).alias("n_total"))


def independence(df: DataFrame, a: str, b: str, likelihood: bool = True, yates: bool = True) -> DataFrame:
    """G (or Pearson) statistic, degrees of freedom, p value and bias-corrected Cramer's V.

    The cells are the observed pairs plus the unobserved ones, which only need their expected
    count; both follow from the margins.
    """
    cells = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("o"))
    rows = cells.groupBy(a).agg(F.sum("o").alias("_row"))
    cols = cells.groupBy(b).agg(F.sum("o").alias("_col"))
    n = cells.agg(F.sum("o").cast("double")).scalar()
    r = rows.agg(F.count(F.lit(1))).scalar()
    c = cols.agg(F.count(F.lit(1))).scalar()
    full = attach(attach(cells, rows, [a]), cols, [b])
    e = F.col("_row") * F.col("_col") / n
    gap = e - F.col("o")
    small = (r == 2) & (c == 2)
    o = F.when(small, F.col("o") + F.signum(gap) * F.least(F.lit(0.5), F.abs(gap))).otherwise(F.col("o").cast("double")) if yates else F.col("o")
    # an unobserved cell adds 0 to G and its expected count to Pearson's sum
    row = full.agg(
        F.sum(2 * o * F.log(o / e)).alias("g"),
        F.sum((o - e) * (o - e) / e).alias("seen"),
        F.sum(e).alias("expected_seen"),
        F.sum((F.col("o") - e) * (F.col("o") - e) / e).alias("raw_seen"),
    )
    pearson = F.col("seen") + (n - F.col("expected_seen"))
    phi2 = (F.col("raw_seen") + (n - F.col("expected_seen"))) / n
    phi2 = F.greatest(F.lit(0.0), phi2 - (r - 1) * (c - 1) / (n - 1))
    r_c, c_c = r - (r - 1) * (r - 1) / (n - 1), c - (c - 1) * (c - 1) / (n - 1)
    out = row.select(
        (F.col("g") if likelihood else pearson).alias("statistic"),
        ((r - 1) * (c - 1)).cast("int").alias("df"),
        F.sqrt(phi2 / F.least(r_c - 1, c_c - 1)).alias("cramers_v"),
    )
    return out.withColumn("p_value", chi2_tail("statistic", F.col("df").cast("double")))


def fligner_killeen(df: DataFrame, value: str, group: str) -> DataFrame:
    """Equality of spread: normal scores of the ranks of deviations from the group medians."""
    medians = exact_quantiles(df, [value], {"_med": 0.5}, [group]).select(group, "_med")
    rows = attach(df.select(group, F.col(value).cast("double").alias("_v")), medians, [group])
    counts = rows.filter("_v is not null").groupBy(group, F.abs(F.col("_v") - F.col("_med")).alias("dev")).agg(F.count(F.lit(1)).alias("n"))
    pooled = running_totals(counts.groupBy("dev").agg(F.sum("n").alias("t")), "dev", ["t"])
    n = counts.agg(F.sum("n").cast("double")).scalar()
    rank = F.col("cum_t") - (F.col("t") - 1) / 2
    scores = sp.with_normal_quantile(pooled.withColumn("_p", 0.5 + rank / (2 * (n + 1))), "_p", "a").select("dev", "a")
    scored = attach(counts, scores, ["dev"])
    groups = scored.groupBy(group).agg(
        F.sum("n").cast("double").alias("m"), F.sum(F.col("n") * F.col("a")).alias("s"),
        F.sum(F.col("n") * F.col("a") * F.col("a")).alias("q"),
    )
    row = groups.agg(
        F.sum("m").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"), F.sum(F.col("s") * F.col("s") / F.col("m")).alias("between"),
        (F.count(F.lit(1)) - 1).cast("int").alias("df"),
    )
    row = row.select(F.expr("(between - s * s / n) / ((q - s * s / n) / (n - 1))").alias("statistic"), "df")
    return row.withColumn("p_value", chi2_tail("statistic", F.col("df").cast("double")))


def beta_posterior(df: DataFrame, arm: str, success: Column, alpha: float = 1.0, beta: float = 1.0) -> DataFrame:
    """Beta parameters per arm with mean, variance and mode (null unless both exceed 1)."""
    counts = df.groupBy(arm).agg(F.count_if(success).alias("s"), F.count(F.lit(1)).alias("n"))
    t = counts.select(arm, (F.col("s") + alpha).alias("a"), (F.col("n") - F.col("s") + beta).alias("b"))
    a, b = F.col("a"), F.col("b")
    return t.select(
        arm, "a", "b", (a / (a + b)).alias("mean"), (a * b / ((a + b) * (a + b) * (a + b + 1))).alias("variance"),
        F.when((a > 1) & (b > 1), (a - 1) / (a + b - 2)).alias("mode"),
    )


def with_interval(posterior: DataFrame, level: float = 0.95) -> DataFrame:
    tail = (1 - level) / 2
    return posterior.withColumns(
        {"low": beta_quantile(F.lit(tail), F.col("a"), F.col("b")), "high": beta_quantile(F.lit(1 - tail), F.col("a"), F.col("b"))}
    )


def beta_binomial(posterior: DataFrame, arm: str, trials: int) -> DataFrame:
    """Posterior predictive probability of k successes in the next trials."""
    t = posterior.select(arm, "a", "b", F.explode(F.sequence(F.lit(0), F.lit(trials))).alias("k"))
    k, a, b = F.col("k").cast("double"), F.col("a"), F.col("b")
    g = log_gamma
    log_p = (
        g(F.lit(trials + 1.0)) - g(k + 1) - g(trials - k + 1) + g(k + a) + g(trials - k + b) - g(a + b + trials)
        + g(a + b) - g(a) - g(b)
    )
    return t.select(arm, "k", F.exp(log_p).alias("probability"))


def beta_divergence(posterior: DataFrame, arm: str, alpha: float = 1.0, beta: float = 1.0) -> DataFrame:
    """Kullback-Leibler divergence of the posterior from the prior, per arm."""
    a, b, g, d = F.col("a"), F.col("b"), log_gamma, digamma
    prior = math.lgamma(alpha) + math.lgamma(beta) - math.lgamma(alpha + beta)
    kl = (
        prior - (g(a) + g(b) - g(a + b)) + (a - alpha) * d(a) + (b - beta) * d(b) + (alpha - a + beta - b) * d(a + b)
    )
    return posterior.select(arm, kl.alias("kl"))


def censored_normal_nll(df: DataFrame, value: str, threshold: float, mus: list[float], sigmas: list[float]) -> DataFrame:
    """Negative log-likelihood of a right-censored normal on a parameter grid.

    Four sums over the rows are sufficient; the grid is evaluated on that one row.
    """
    y = F.col(value).cast("double")
    seen = y < threshold
    row = df.agg(
        F.count_if(seen).cast("double").alias("n"), F.sum(F.when(seen, y)).alias("s"), F.sum(F.when(seen, y * y)).alias("q"),
        F.count_if(~seen).cast("double").alias("c"),
    )
    cells = F.array(*[F.struct(F.lit(float(m)).alias("mu"), F.lit(float(s)).alias("sigma")) for m in mus for s in sigmas])
    grid = row.select("n", "s", "q", "c", F.inline(cells))
    tail = normal_upper((F.lit(float(threshold)) - F.col("mu")) / F.col("sigma"))
    grid = grid.withColumn("tail", F.greatest(tail, F.lit(1e-12)))
    loss = F.expr("n * ln(sigma) + n / 2 * ln(2 * pi()) + (q - 2 * mu * s + n * mu * mu) / (2 * sigma * sigma) - c * ln(tail)")
    return grid.select("mu", "sigma", loss.alias("nll"))


def logit_regression(df: DataFrame, label: Column, features: list[str], iterations: int = 100, tolerance: float = 1e-10) -> dict:
    """Logistic regression by iteratively reweighted least squares.

    Each step is one aggregate of the weighted cross products; only a (k + 1) x (k + 1) matrix
    reaches the driver, whatever the number of rows. Raises if the steps don't shrink to the tolerance (classes that a
    line separates have no finite solution).
    """
    names = ["intercept", *features]
    cols = [F.lit(1.0), *[F.col(f).cast("double") for f in features]]
    y = label.cast("double")
    beta = np.zeros(len(names))
    k = len(names)
    for _ in range(iterations):
        eta = sum((c * float(b) for c, b in zip(cols, beta)), F.lit(0.0))
        p = 1 / (1 + F.exp(-eta))
        w = p * (1 - p)
        sums = [F.sum(w * cols[i] * cols[j]).alias(f"h{i}_{j}") for i in range(k) for j in range(i, k)]
        sums += [F.sum((y - p) * cols[i]).alias(f"g{i}") for i in range(k)]
        row = df.agg(*sums).first()
        hessian = np.array([[row[f"h{min(i, j)}_{max(i, j)}"] for j in range(k)] for i in range(k)])
        step = np.linalg.solve(hessian, np.array([row[f"g{i}"] for i in range(k)]))
        beta = beta + step
        if np.abs(step).max() < tolerance * (1 + np.abs(beta).max()):
            break
    else:
        raise ValueError(f"no convergence in {iterations} iterations")
    error = np.sqrt(np.diag(np.linalg.inv(hessian)))
    return {n: (float(b), float(e)) for n, b, e in zip(names, beta, error)}


def logit_inference(df: DataFrame, label: Column, features: list[str]) -> DataFrame:
    """Coefficient table with odds ratios and the change of x that doubles the odds, also as a share of its IQR."""
    fit = logit_regression(df, label, features)
    quartiles = {
        r["column"]: r["q3"] - r["q1"] for r in exact_quantiles(df, features, {"q1": 0.25, "q3": 0.75}).collect()
    }
    rows = []
    for name, (b, e) in fit.items():
        double = math.log(2) / b if b else None
        iqr = quartiles.get(name)
        rows.append(
            (name, b, e, b / e, math.erfc(abs(b / e) / math.sqrt(2)), math.exp(b), double, double / iqr if iqr and double else None)
        )
    schema = "term string, coefficient double, std_error double, z double, p_value double, odds_ratio double, doubling_step double, step_over_iqr double"
    return df.sparkSession.createDataFrame(rows, schema)
