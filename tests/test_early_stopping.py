import pytest
from pyspark.sql import functions as F

from lodestat.operators import learners as L

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """Labels that follow a step in the features, and labels that follow nothing."""
    df = spark.range(4000).select("id", *(F.pmod(F.xxhash64(F.lit(i), "id"), F.lit(1000)).cast("double").alias(f) for i, f in enumerate(FEATURES)))
    learnable = ((F.col("a") + F.col("b") * 2 > 1400) != (F.col("c") > 700)).cast("int")
    df = df.withColumns({"real": learnable, "noise": F.pmod(F.xxhash64(F.lit("noise"), "id"), F.lit(2)).cast("int"), "fold": (F.col("id") % 2).cast("int")})
    return df.withColumn("held", L.validation_rows(["id"])).cache()


def loss(model, rows, label):
    p = F.when(F.col(label) == 1, F.element_at("p", 2)).otherwise(F.element_at("p", 1))
    return model.transform(rows).withColumn("p", L.vector_to_array("probability")).agg(F.avg(-F.log(p))).first()[0]


def test_noise_stops_early_and_signal_goes_on(rows):
    size = {"rounds": 30, "depth": 3, "rate": 0.3}
    noisy = L.fit_ensemble(rows, "noise", FEATURES, "boosting", validation="held", **size)
    real = L.fit_ensemble(rows, "real", FEATURES, "boosting", validation="held", **size)
    assert L.rounds_used(noisy) <= 5 < L.rounds_used(real) <= 30
    full = L.fit_ensemble(rows.where("not held"), "noise", FEATURES, "boosting", **size)
    assert L.rounds_used(full) == 30
    held = rows.where("held")
    assert loss(noisy, held, "noise") < loss(full, held, "noise")


def test_held_back_rows_grow_no_tree(spark, rows):
    """With their labels turned round the held-back rows end the training at once."""
    turned = rows.withColumn("turned", F.when(F.col("held"), 1 - F.col("real")).otherwise(F.col("real")))
    assert L.rounds_used(L.fit_ensemble(turned, "turned", FEATURES, "boosting", validation="held", rounds=20, depth=3)) == 1


def test_scores_tell_the_best_round(rows):
    scores = {(r["learner"], r["fold"]): r for r in L.ensemble_scores(rows, "noise", FEATURES, "fold", ["tree", "forest", "boosting"], trees=7, rounds=20, depth=3).collect()}
    assert {scores["tree", k]["rounds"] for k in (0, 1)} == {1} and {scores["forest", k]["rounds"] for k in (0, 1)} == {7}
    assert all(1 <= scores["boosting", k]["rounds"] < 20 for k in (0, 1))


def test_share_of_validation_rows(rows):
    n, held = rows.agg(F.count("*"), F.sum(F.col("held").cast("int"))).first()
    assert 0.17 < held / n < 0.23
