"""Tree learners work on all cores, also when the rows come as one part."""

import pytest
from pyspark.sql import functions as F

from lodestat.operators import learners as L

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.range(400).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 11).cast("double").alias("b"), (F.col("id") % 7 > 3).cast("int").alias("y"), (F.col("id") % 2).cast("int").alias("fold")).coalesce(1)


def test_training_and_scoring_use_every_core(spark, rows, monkeypatch):
    cores, trained, stages = spark.sparkContext.defaultParallelism, [], L._stages

    class Watched:
        def __init__(self, pipeline):
            self.pipeline = pipeline

        def fit(self, df):
            trained.append(df.rdd.glom().map(len).collect())
            return self.pipeline.fit(df)

    monkeypatch.setattr(L, "_stages", lambda *a: Watched(stages(*a)))
    model = L.fit_ensemble(rows, "y", FEATURES, trees=3)
    L.ensemble_scores(rows, "y", FEATURES, "fold", ["tree"])
    assert [sum(t) for t in trained] == [400, 200, 200] and all(len(t) == cores and max(t) <= 2 * 400 / cores for t in trained)
    scored = L.score_batches(rows, model, ["id", "a"])
    assert scored.rdd.getNumPartitions() == cores and scored.columns == ["id", "a", "predicted", "probability"]
    assert sorted(r.id for r in scored.collect()) == list(range(400)) and all(r.predicted == (r.a > 3) for r in scored.collect())


def test_parts_grow_with_the_rows(spark, rows, monkeypatch):
    monkeypatch.setattr(L, "ROWS_A_TASK", 10)
    parts = L.dealt(rows, 400).rdd.getNumPartitions()
    assert parts >= 40 and parts % spark.sparkContext.defaultParallelism == 0
