"""Clustering and cluster quality."""

from __future__ import annotations

from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.session import checkpointed


def squared_distance(a, b):
    """Squared Euclidean distance of two array columns, in double."""
    pairs = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(pairs, F.lit(0.0), lambda s, v: s + v)


def as_double(vector: str):
    return F.transform(F.col(vector), lambda v: v.cast("double"))


def centroids(df: DataFrame, vector: str, label: str) -> DataFrame:
    """(label, n, centre): one row per cluster. Coordinates are averaged in long form, so the
    exchange carries one number per cluster and coordinate and task."""
    long = df.select(F.col(label).alias("label"), F.posexplode(as_double(vector)).alias("d", "v"))
    means = long.groupBy("label", "d").agg(F.avg("v").alias("m"), F.count(F.lit(1)).alias("n"))
    ordered = F.array_sort(F.collect_list(F.struct("d", "m")))
    return means.groupBy("label").agg(F.max("n").alias("n"), F.transform(ordered, lambda x: x["m"]).alias("centre"))


def cluster_indices(df: DataFrame, vector: str, label: str) -> DataFrame:
    """Calinski-Harabasz, Davies-Bouldin and the squared-distance silhouette, one row.

    Clusters are few: their centres come to the driver (k rows) and return as a small map.
    """
    import numpy as np

    found = {r["label"]: (r["n"], np.array(r["centre"])) for r in centroids(df, vector, label).collect()}
    n = sum(c[0] for c in found.values())
    k = len(found)
    overall = sum(c[0] * c[1] for c in found.values()) / n
    between = sum(c[0] * float(((c[1] - overall) ** 2).sum()) for c in found.values())
    table = F.create_map(*[x for key, c in found.items() for x in (F.lit(key), F.array(*[F.lit(float(v)) for v in c[1]]))])
    gaps = df.select(F.col(label).alias("label"), squared_distance(as_double(vector), table[F.col(label)]).alias("d2"))
    inside = {r["label"]: (r["ss"], r["spread"]) for r in gaps.groupBy("label").agg(F.sum("d2").alias("ss"), F.avg(F.sqrt("d2")).alias("spread")).collect()}
    within = sum(v[0] for v in inside.values())
    worst = [
        max(
            (inside[i][1] + inside[j][1]) / float(np.sqrt(((found[i][1] - found[j][1]) ** 2).sum()))
            for j in found
            if j != i
        )
        for i in found
    ]
    ready = df.select(array_to_vector(as_double(vector)).alias("features"), F.col(label).cast("double").alias("prediction"))
    silhouette = ClusteringEvaluator(metricName="silhouette", distanceMeasure="squaredEuclidean").evaluate(ready)
    row = [(between / (k - 1) / (within / (n - k)), sum(worst) / k, silhouette)]
    return df.sparkSession.createDataFrame(row, "calinski_harabasz double, davies_bouldin double, silhouette double")


def nearest_centre(columns, centres):
    """Struct (squared distance, number) of the nearest of a short list of centres, first on ties."""
    cells = []
    for i, c in enumerate(centres):
        terms = [(F.col(x) - float(v)) * (F.col(x) - float(v)) for x, v in zip(columns, c)]
        cells.append(F.struct(sum(terms[1:], terms[0]).alias("d2"), F.lit(i).alias("cluster")))
    return F.array_min(F.array(*cells))


def lloyd(df: DataFrame, columns, centres, iterations: int):
    """Fixed rounds of k-means: assign in place, one grouped mean per round. Returns (rows, centres)."""
    centres = [list(c) for c in centres]
    for _ in range(iterations):
        placed = df.withColumn("_n", nearest_centre(columns, centres))
        means = placed.groupBy("_n.cluster").agg(*[F.avg(c).alias(c) for c in columns]).collect()  # k rows
        for m in means:
            centres[m["cluster"]] = [m[c] for c in columns]
    placed = df.withColumn("_n", nearest_centre(columns, centres))
    return placed.withColumns({"cluster": F.col("_n.cluster"), "d2": F.col("_n.d2")}).drop("_n"), centres


def kmeans_elbow(df: DataFrame, columns, ks, seed: int = 42):
    """(k, cost) by MLlib k-means for each k, with the fitted models."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    ready = checkpointed(VectorAssembler(inputCols=list(columns), outputCol="_x").transform(df))
    models = {k: KMeans(k=k, seed=seed, featuresCol="_x", predictionCol="cluster").fit(ready) for k in ks}
    curve = df.sparkSession.createDataFrame([(int(k), float(m.summary.trainingCost)) for k, m in models.items()], "k int, cost double")
    return ready, models, curve


def mixed_gamma(df: DataFrame, numeric, categorical) -> float:
    """Weight of a mismatch: mean squared distance to the means over mean mismatches with the modes."""
    from lodestat.operators.aggregates import modes

    means = df.agg(*[F.avg(c).alias(c) for c in numeric]).first()
    top = {r["column"]: r["value"] for r in modes(df, categorical).collect()}
    far = [(F.col(c) - means[c]) * (F.col(c) - means[c]) for c in numeric]
    off = [(F.col(c).cast("string") != top[c]).cast("double") for c in categorical]
    row = df.agg(F.avg(sum(far[1:], far[0])).alias("n"), F.avg(sum(off[1:], off[0])).alias("c")).first()
    return row["n"] / row["c"]


def k_prototypes(df: DataFrame, numeric, categorical, seeds, gamma: float, iterations: int = 200):
    """Mixed clustering from given seed prototypes (dicts): means and modes per round until stable, or an error.

    Returns the rows with cluster and cost, and the prototypes.
    """
    prototypes = [dict(s) for s in seeds]
    df = checkpointed(df)

    def place(protos):
        cells = []
        for i, p in enumerate(protos):
            terms = [(F.col(c) - float(p[c])) * (F.col(c) - float(p[c])) for c in numeric]
            terms += [F.lit(gamma) * (F.col(c) != p[c]).cast("double") for c in categorical]
            cells.append(F.struct(sum(terms[1:], terms[0]).alias("cost"), F.lit(i).alias("cluster")))
        return df.withColumn("_n", F.array_min(F.array(*cells))).withColumns({"cluster": F.col("_n.cluster"), "cost": F.col("_n.cost")}).drop("_n")

    for _ in range(iterations):
        placed = place(prototypes)
        fresh = [dict(p) for p in prototypes]
        for r in placed.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in numeric]).collect():
            fresh[r["cluster"]].update({c: r[c] for c in numeric})
        for c in categorical:
            counts = placed.groupBy("cluster", c).agg(F.count(F.lit(1)).alias("n"))
            for r in counts.groupBy("cluster").agg(F.min_by(c, F.struct(-F.col("n"), F.col(c))).alias("v")).collect():
                fresh[r["cluster"]][c] = r["v"]
        if fresh == prototypes:
            return placed, prototypes
        prototypes = fresh
    raise ValueError(f"prototypes still move after {iterations} rounds")


def gower_to(df: DataFrame, numeric, categorical, ranges, prototypes):
    """Gower distance of every row to each of a short list of prototypes (dicts), as an array column."""
    p = len(numeric) + len(categorical)
    cells = []
    for proto in prototypes:
        terms = [F.abs(F.col(c) - float(proto[c])) / float(ranges[c] or 1.0) for c in numeric]
        terms += [(F.col(c) != proto[c]).cast("double") for c in categorical]
        cells.append(sum(terms[1:], terms[0]) / p)
    return F.array(*cells)


def column_ranges(df: DataFrame, numeric) -> dict[str, float]:
    return df.agg(*[(F.max(c) - F.min(c)).cast("double").alias(c) for c in numeric]).first().asDict()


def gower_medoids(df: DataFrame, id_: str, cluster: str, numeric, categorical, ranges) -> DataFrame:
    """Per cluster the row with the least summed Gower distance to its cluster.

    The sum over a cluster of |x - x_j| follows from running counts and totals of the sorted
    distinct values, and the number of mismatches from value counts, so no two rows are paired.
    """
    from lodestat.operators.ordered import running_totals
    from lodestat.operators.quantiles import attach

    sizes = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).cast("double").alias(f"_t_{c}") for c in numeric])
    out = attach(df, sizes, [cluster])
    score = F.lit(0.0)
    for c in numeric:
        values = df.groupBy(cluster, c).agg(F.count(F.lit(1)).alias("_m"), F.sum(c).cast("double").alias("_s"))
        summed = running_totals(values, c, ["_m", "_s"], [cluster]).select(cluster, c, F.col("cum__m").alias(f"_m_{c}"), F.col("cum__s").alias(f"_s_{c}"))
        out = attach(out, summed, [cluster, c])
        below, mass, total = F.col(f"_m_{c}"), F.col(f"_s_{c}"), F.col(f"_t_{c}")
        score = score + (F.col(c) * below - mass + (total - mass) - F.col(c) * (F.col("_n") - below)) / float(ranges[c] or 1.0)
    for c in categorical:
        counts = df.groupBy(cluster, c).agg(F.count(F.lit(1)).alias(f"_k_{c}"))
        out = attach(out, counts, [cluster, c])
        score = score + (F.col("_n") - F.col(f"_k_{c}"))
    out = out.withColumn("_score", F.round(score / (len(numeric) + len(categorical)), 6))
    best = F.min(F.struct(F.col("_score").alias("total"), F.col(id_).alias("medoid")))
    return out.groupBy(cluster).agg(best.alias("b")).select(cluster, "b.medoid", "b.total")
