"""Learners whose passes over the data are aggregates; only small matrices reach the driver."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.functions.scalars import sigmoid, softplus
from lodestat.operators.ordered import hash_row_numbers
from lodestat.operators.quantiles import quantile_values
from lodestat.operators.series import least_squares_sums
from lodestat.session import checkpointed


def _design(features: Sequence[str]) -> list[Column]:
    return [F.lit(1.0), *[F.col(f).cast("double") for f in features]]


def _matrix(gram: Sequence[float]) -> np.ndarray:
    k = int(round(len(gram) ** 0.5))
    return np.asarray(gram, dtype=float).reshape(k, k)


def _solve(g: np.ndarray, ridge: float = 0.0) -> np.ndarray:
    penalty = ridge * np.eye(len(g) - 1)
    penalty[0, 0] = 0.0
    return np.linalg.solve(g[:-1, :-1] + penalty, g[:-1, -1])


def _rss(g: np.ndarray, beta: np.ndarray) -> float:
    v = np.append(-beta, 1.0)
    return float(v @ g @ v)


def linear_fit(df: DataFrame, target: str, features: Sequence[str], weight: Column | None = None) -> np.ndarray:
    """Least-squares coefficients, intercept first, from one aggregate of cross products."""
    w = F.lit(1.0) if weight is None else F.sqrt(weight)
    row = least_squares_sums(df, F.col(target).cast("double") * w, [c * w for c in _design(features)]).first()
    return _solve(_matrix(row["gram"]))


def linear_value(beta: Sequence[float], features: Sequence[str]) -> Column:
    terms = [F.lit(float(b)) * c for b, c in zip(beta, _design(features))]
    return sum(terms[1:], terms[0])


def cost_and_gradient(
    df: DataFrame, target: Column, features: Sequence[str], beta: Sequence[float], logistic: bool, penalty: float = 0.0
) -> DataFrame:
    """Mean cost and its gradient at given parameters (intercept first, not penalised), one row."""
    m = F.count(F.lit(1))
    y = target.cast("double")
    z = linear_value(beta, features)
    error = (sigmoid(z) if logistic else z) - y
    loss = (softplus(z) - y * z) if logistic else error * error / 2
    ridge = sum(float(b) ** 2 for b in beta[1:]) * penalty / 2
    cells = [((F.sum(loss) + ridge) / m).alias("cost"), (F.sum(error) / m).alias("d_intercept")]
    for b, f in zip(beta[1:], features):
        cells.append(((F.sum(error * F.col(f)) + penalty * float(b)) / m).alias(f"d_{f}"))
    return df.agg(*cells)


def gradient_descent(
    df: DataFrame, target: Column, features: Sequence[str], step: float, iterations: int, logistic: bool, penalty: float = 0.0
) -> DataFrame:
    """(iteration, cost, parameters): batch gradient descent, one aggregate per step over the target and features, written once."""
    df = checkpointed(df.select(target.alias("_target"), *features))
    target, beta, path = F.col("_target"), [0.0] * (len(features) + 1), []
    names = ["d_intercept", *[f"d_{f}" for f in features]]
    for i in range(iterations):
        row = cost_and_gradient(df, target, features, beta, logistic, penalty).first()
        path.append((i, row["cost"], *beta))
        beta = [b - step * row[n] for b, n in zip(beta, names)]
    schema = "iteration int, cost double, intercept double, " + ", ".join(f"{f} double" for f in features)
    return df.sparkSession.createDataFrame(path, schema)


def huber_line(df: DataFrame, target: str, feature: str, k: float = 1.345, iterations: int = 200, tolerance: float = 1e-8) -> tuple[float, float]:
    """Robust line: weights k s / |residual| beyond k s, scale by the median absolute deviation.

    Raises if the coefficients still move after ``iterations`` rounds.
    """
    beta = linear_fit(df, target, [feature])
    for _ in range(iterations):
        r = F.col(target) - linear_value(beta, [feature])
        centre = quantile_values(df.select(r.alias("r")), ["r"], {"m": 0.5})["r_m"]
        scale = quantile_values(df.select(F.abs(r - centre).alias("r")), ["r"], {"m": 0.5})["r_m"] / 0.6744897501960817
        weight = F.least(F.lit(1.0), F.lit(k * scale) / F.greatest(F.abs(r), F.lit(1e-12)))
        fresh = linear_fit(df, target, [feature], weight)
        done = np.abs(fresh - beta).max() <= tolerance * (1 + np.abs(beta).max())
        beta = fresh
        if done:
            return float(beta[0]), float(beta[1])
    raise ValueError(f"the line still moves after {iterations} rounds")


def poisson_fit(df: DataFrame, target: str, features: Sequence[str]) -> DataFrame:
    """Rows with the fitted mean and residual of a log-linear Poisson regression."""
    ready = VectorAssembler(inputCols=list(features), outputCol="_x").transform(df)
    model = GeneralizedLinearRegression(family="poisson", link="log", featuresCol="_x", labelCol=target, predictionCol="fitted").fit(ready)
    return model.transform(ready).drop("_x").withColumn("residual", F.col(target) - F.col("fitted"))


def spline_basis(column: str, low: float, high: float, knots: int) -> dict[str, Column]:
    """Truncated-power cubic basis on the column scaled to [0, 1]."""
    x = (F.col(column) - low) / (high - low)
    out = {"s1": x, "s2": x * x, "s3": x * x * x}
    for i in range(1, knots + 1):
        gap = F.greatest(x - i / (knots + 1), F.lit(0.0))
        out[f"s{3 + i}"] = gap * gap * gap
    return out


def anova_f(df: DataFrame, features: Sequence[str], label: str, keep: int) -> DataFrame:
    """(feature, f): between over within mean squares; the ``keep`` greatest."""
    cells = []
    for f in features:
        cells += [F.avg(f).alias(f"m_{f}"), F.var_pop(f).alias(f"v_{f}")]
    groups = checkpointed(df.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *cells))
    whole = groups.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), *[(F.sum(F.col("n") * F.col(f"m_{f}")) / F.sum("n")).alias(f) for f in features]).first()
    off = {f: F.col(f"m_{f}") - whole[f] for f in features}
    sums = groups.agg(
        *[F.sum(F.col("n") * off[f] * off[f]).alias(f"b_{f}") for f in features], *[F.sum(F.col("n") * F.col(f"v_{f}")).alias(f"w_{f}") for f in features]
    ).first()
    n, k = whole["n"], whole["k"]
    rows = [(f, float(sums[f"b_{f}"] / (k - 1) / (sums[f"w_{f}"] / (n - k)))) for f in features]
    return df.sparkSession.createDataFrame(sorted(rows, key=lambda r: -r[1])[:keep], "feature string, f double")


def fold_sums(df: DataFrame, target: str, features: Sequence[str], fold: str) -> dict[int, tuple[np.ndarray, int]]:
    """Cross products per fold: enough to fit and score every leave-one-fold-out linear model."""
    rows = least_squares_sums(df, F.col(target).cast("double"), _design(features), [fold]).collect()
    return {r[fold]: (_matrix(r["gram"]), r["rows"]) for r in rows}


def out_of_fold(df: DataFrame, target: str, features: Sequence[str], fold: str, out: str = "predicted") -> DataFrame:
    """Each row is predicted by the model fitted on the other folds; one aggregate fits them all."""
    sums = fold_sums(df, target, features, fold)
    whole = sum(g for g, _ in sums.values())
    choice = None
    for k, (g, _) in sums.items():
        value = linear_value(_solve(whole - g), features)
        choice = F.when(F.col(fold) == k, value) if choice is None else choice.when(F.col(fold) == k, value)
    return df.withColumn(out, choice)


def ridge_grid(df: DataFrame, target: str, features: Sequence[str], fold: str, penalties: Sequence[float]) -> DataFrame:
    """(penalty, fold, mse, mean_mse, rank): the whole grid from one aggregate of cross products."""
    sums = fold_sums(df, target, features, fold)
    whole = sum(g for g, _ in sums.values())
    scores = {p: {k: _rss(g, _solve(whole - g, p)) / n for k, (g, n) in sums.items()} for p in penalties}
    order = sorted(penalties, key=lambda p: np.mean(list(scores[p].values())))
    rows = [
        (float(p), int(k), float(v), float(np.mean(list(scores[p].values()))), order.index(p) + 1)
        for p in penalties
        for k, v in sorted(scores[p].items())
    ]
    return df.sparkSession.createDataFrame(rows, "penalty double, fold int, mse double, mean_mse double, rank int")


def permutation_importance(
    df: DataFrame, ids: Sequence[str], target: str, features: Sequence[str], predict, repeats: int = 1, seed: int = 42
) -> DataFrame:
    """(feature, repeat, increase): rise of the mean squared error when one column is shuffled.

    ``predict(names)`` gives the prediction as a column over the named feature columns. A shuffle
    pairs the row at place i of one hash order with the value at place i of another.
    """
    base = df.agg(F.avg(F.pow(F.col(target) - predict(list(features)), F.lit(2)))).first()[0]
    out = None
    for r in range(repeats):
        left = hash_row_numbers(df.select(*ids, target, *features), ids, seed=seed + 2 * r, name="_i")
        right = hash_row_numbers(df.select(*ids, *features), ids, seed=seed + 2 * r + 1, name="_i")
        paired = left.join(right.select("_i", *[F.col(f).alias(f"_{f}") for f in features]), "_i")
        cells = []
        for f in features:
            names = [f"_{f}" if g == f else g for g in features]
            cells.append(F.struct(F.lit(f).alias("feature"), F.avg(F.pow(F.col(target) - predict(names), F.lit(2))).alias("mse")))
        row = paired.agg(F.array(*cells).alias("c")).select(F.inline("c"))
        part = row.select("feature", F.lit(r).alias("repeat"), (F.col("mse") - base).alias("increase"))
        out = part if out is None else out.union(part)
    return out


# ---- tree ensembles on MLlib

ROWS_A_TASK = 1 << 16  # a training row of a forest carries a number for every tree


def dealt(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in equal parts, as many for every core. A tree learner takes rows x trees x depth, far more than reading, and a file of a few MB would be read, and so worked on, by one task."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores * max(1, -(-rows // (cores * ROWS_A_TASK))))


def _stages(df: DataFrame, label: str, features: Sequence[str], learner):
    index = StringIndexer(inputCol=label, outputCol="_label", stringOrderType="alphabetAsc")
    gather = VectorAssembler(inputCols=list(features), outputCol="_x")
    return Pipeline(stages=[index, gather, learner.setFeaturesCol("_x").setLabelCol("_label")])


def tree_learner(kind: str, seed: int = 42, trees: int = 300, rounds: int = 300, depth: int = 5, rate: float = 0.1):
    """A tree, a forest, bagged trees (all features at every split) or boosted trees."""
    return {
        "tree": lambda: DecisionTreeClassifier(maxDepth=depth, seed=seed),
        "forest": lambda: RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed),
        "bagging": lambda: RandomForestClassifier(numTrees=trees, maxDepth=depth, featureSubsetStrategy="all", seed=seed),
        "boosting": lambda: GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=rate, seed=seed),
    }[kind]()


def validation_rows(columns: Sequence[str], share: int = 5, seed: int = 42) -> Column:
    """True for about one row in ``share``, by a hash of the columns; equal rows are on one side."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(share)) == 0


def stopping_early(learner: GBTClassifier, validation: str, tolerance: float = 1e-3) -> GBTClassifier:
    """Boosting that ends at the first round that doesn't lower the loss on rows with ``validation`` by ``tolerance`` of it.

    Trees are grown on the other rows only. The model keeps the rounds up to the best one; ``rounds_used`` tells how many.
    """
    return learner.setValidationIndicatorCol(validation)._set(validationTol=tolerance)


def rounds_used(model) -> int:
    """Trees of a fitted pipeline's last stage: the best round of boosting, the size of a forest, 1 for a tree."""
    return int(getattr(model.stages[-1], "getNumTrees", 1))


def ensemble_scores(
    df: DataFrame, label: str, features: Sequence[str], fold: str, kinds: Sequence[str], seed: int = 42, class_weights: dict | None = None, tolerance: float = 1e-3, **size
) -> DataFrame:
    """(learner, fold, accuracy, rounds) of tree ensembles trained on the other folds; ``size`` goes to ``tree_learner``.

    Boosting holds a fifth of its training rows back and stops on them; ``rounds`` is its best round and the number of trees of the others.
    ``class_weights`` (label value to weight) weighs the training rows. The columns used are written once.
    """
    weight = F.lit(1.0)
    for value, w in (class_weights or {}).items():
        weight = F.when(F.col(label) == value, float(w)).otherwise(weight)
    held_back = validation_rows([label, *features], seed=seed).alias("_validation")
    df = checkpointed(df.select(label, *features, fold, weight.alias("_weight"), held_back))
    folds = sorted(r[0] for r in df.select(fold).distinct().collect())
    count = df.count()
    judge = MulticlassClassificationEvaluator(labelCol="_label", metricName="accuracy")
    rows = []
    for kind in kinds:
        for k in folds:
            learner = tree_learner(kind, seed, **size).setWeightCol("_weight")
            if kind == "boosting":
                learner = stopping_early(learner, "_validation", tolerance)
            model = _stages(df, label, features, learner).fit(dealt(df.filter(F.col(fold) != k), count))
            rows.append((kind, int(k), float(judge.evaluate(model.transform(dealt(df.filter(F.col(fold) == k), count)))), rounds_used(model)))
    return df.sparkSession.createDataFrame(rows, "learner string, fold int, accuracy double, rounds int")


def score_batches(df: DataFrame, model, ids: Sequence[str]) -> DataFrame:
    """Ids with predicted class and its probability by a fitted pipeline; only ids and features are dealt out, each row goes through all trees."""
    features = next(s.getInputCols() for s in model.stages if isinstance(s, VectorAssembler))
    scored = model.transform(dealt(df.select(*dict.fromkeys([*ids, *features])), df.count()))
    p = vector_to_array("probability")
    return scored.select(*ids, F.col("prediction").cast("int").alias("predicted"), F.array_max(p).alias("probability"))


def fit_ensemble(df: DataFrame, label: str, features: Sequence[str], kind: str = "forest", seed: int = 42, validation: str | None = None, tolerance: float = 1e-3, **size):
    """A fitted pipeline; boosting with a ``validation`` column (true: held back) stops on those rows."""
    learner = tree_learner(kind, seed, **size)
    df = checkpointed(df.select(label, *features, *([] if validation is None else [validation])))
    return _stages(df, label, features, learner if validation is None else stopping_early(learner, validation, tolerance)).fit(dealt(df, df.count()))


def eliminate_features(df: DataFrame, label: str, features: Sequence[str], keep: int, seed: int = 42) -> DataFrame:
    """Recursive elimination: drop the feature a tree values least until ``keep`` are left."""
    left, out = list(features), []
    df = checkpointed(df.select(label, *features))
    while len(left) > keep:
        model = _stages(df, label, left, tree_learner("tree", seed)).fit(df)
        importance = model.stages[-1].featureImportances.toArray()
        worst = int(importance.argmin())
        out.append((left.pop(worst), len(left) + 1))
    rows = [(f, 1) for f in left] + [(f, place - keep + 1) for f, place in reversed(out)]
    return df.sparkSession.createDataFrame(rows, "feature string, ranking int")


def vote(predictions: DataFrame, id_: str, probability: str, cut: float = 0.5) -> DataFrame:
    """Hard and soft vote over rows (id, model, probability)."""
    p = F.col(probability)
    ayes = F.count_if(p >= cut)
    return predictions.groupBy(id_).agg(
        (2 * ayes > F.count(p)).cast("int").alias("hard"), F.avg(p).alias("mean_probability"),
        (F.avg(p) >= cut).cast("int").alias("soft"),
    )


def stack_features(predictions: DataFrame, id_: str, model: str, probability: str, models: Sequence[str]) -> DataFrame:
    """One row per id with a column per model: the inputs of a second-level model."""
    return predictions.groupBy(id_).pivot(model, list(models)).agg(F.max(probability))
