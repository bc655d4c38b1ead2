import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from lodestat.operators import parts as P

SCHEMA = "id long, x double, n int, word string, y double, fold int"


@pytest.fixture(scope="module")
def rows(spark):
    words = ["b", "a", "c", None]
    data = [(i, None if i % 7 == 3 else float(i % 13), None if i % 5 == 4 else i % 4, words[i * i % 4 if i % 3 else 3], float(i % 10), i % 2) for i in range(60)]
    return spark.createDataFrame(data, SCHEMA).cache()


def steps():
    return [
        P.Fill(inputCols=["x", "n"], strategy="median"),
        P.Fill(inputCols=["word"], outputCols=["known"], strategy="mode"),
        P.Scale(inputCols=["x"], outputCols=["robust"], kind="robust"),
        P.Ordinal(inputCols=["word"], outputCols=["code"]),
        P.CountEncode(inputCols=["word", "n"], outputCols=["seen_word", "seen_n"]),
        P.TargetEncode(inputCols=["word"], outputCols=["mean_y"], target="y", weight=2.0),
    ]


def sorted_rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def test_saved_pipeline_transforms_alike(spark, rows, tmp_path):
    pipeline = Pipeline(stages=steps())
    fitted = pipeline.fit(rows.where("fold = 0"))
    want = sorted_rows(fitted.transform(rows))
    assert len(want) == rows.count()
    fitted.write().save(f"{tmp_path}/fitted")
    loaded = PipelineModel.load(f"{tmp_path}/fitted")
    assert [type(s) for s in loaded.stages] == [type(s) for s in fitted.stages] and [s.uid for s in loaded.stages] == [s.uid for s in fitted.stages]
    assert sorted_rows(loaded.transform(rows)) == want
    pipeline.write().save(f"{tmp_path}/plain")
    again = Pipeline.load(f"{tmp_path}/plain").fit(rows.where("fold = 0"))
    assert sorted_rows(again.transform(rows)) == want


def test_values_of_every_part(rows):
    train = rows.where("fold = 0")
    fitted = Pipeline(stages=steps()).fit(train)
    out = {r["id"]: r for r in fitted.transform(rows).collect()}
    data = rows.collect()
    half = [r for r in data if r["fold"] == 0]

    def median(values):
        values = sorted(values)
        k = len(values)
        return (values[(k - 1) // 2] + values[k // 2]) / 2

    x_fill, n_fill = (median([r[c] for r in half if r[c] is not None]) for c in ("x", "n"))
    x = sorted(x_fill if r["x"] is None else r["x"] for r in half)
    at = lambda p: x[int(p * (len(x) - 1))] + (p * (len(x) - 1) % 1) * (x[min(len(x) - 1, int(p * (len(x) - 1)) + 1)] - x[int(p * (len(x) - 1))])
    words = [r["word"] for r in half]
    known = sorted({w for w in words if w is not None})
    mode = max(known, key=lambda w: (words.count(w), -known.index(w)))
    prior = sum(r["y"] for r in half) / len(half)
    for r in data:
        o = out[r["id"]]
        filled = x_fill if r["x"] is None else r["x"]
        assert o["x"] == filled and o["n"] == (n_fill if r["n"] is None else r["n"])
        assert abs(o["robust"] - (filled - at(0.5)) / (at(0.75) - at(0.25))) < 1e-12
        assert o["known"] == (r["word"] or mode) and o["code"] == (known.index(r["word"]) if r["word"] in known else -999)
        assert o["seen_word"] == words.count(r["word"])
        ys = [h["y"] for h in half if h["word"] == r["word"]]
        assert abs(o["mean_y"] - (sum(ys) + 2 * prior) / (len(ys) + 2)) < 1e-12


def test_values_not_seen_and_repeated_names(spark, rows):
    train = rows.where("word = 'a' AND x IS NOT NULL").withColumn("word value", F.col("word"))
    fitted = Pipeline(stages=[P.Ordinal(inputCols=["word value"]), P.CountEncode(inputCols=["word"]), P.TargetEncode(inputCols=["fold"], outputCols=["t"], target="y")]).fit(train)
    out = fitted.transform(rows.withColumn("word value", F.lit("new"))).collect()
    assert {r["word value"] for r in out} == {-999} and {r["word"] for r in out} <= {0, train.count()}
    with pytest.raises(ValueError, match="differ"):
        P.CountEncode(inputCols=["word"], outputCols=["a", "b"]).fit(train).transform(train)
    with pytest.raises(ValueError, match="strategy"):
        P.Fill(inputCols=["x"], strategy="first").fit(train)


def test_columns_of_nulls_and_tables_without_rows(spark, rows):
    nothing = rows.withColumn("x", F.lit(None).cast("double"))
    out = Pipeline(stages=[P.Fill(inputCols=["x"]), P.Scale(inputCols=["x"])]).fit(nothing).transform(rows.select("id", "x"))
    assert out.where("x IS NOT NULL").count() == 0
    empty = rows.limit(0)
    made = Pipeline(stages=[P.Ordinal(inputCols=["word"], outputCols=["c"]), P.CountEncode(inputCols=["word"], outputCols=["s"]), P.TargetEncode(inputCols=["word"], outputCols=["m"], target="y")]).fit(empty).transform(rows)
    assert {(r["c"], r["s"], r["m"]) for r in made.collect()} == {(-999, 0, None)}


def test_folds_do_not_leak(spark, rows, monkeypatch):
    """Every part of every fold is fitted on the other folds' rows only, and a row's own target is not in its code."""
    fits, learned = [], P.TargetEncode.learned
    monkeypatch.setattr(P.TargetEncode, "learned", lambda self, df: fits.append({r["id"] for r in df.select("id").collect()}) or learned(self, df))
    stages = [P.Fill(inputCols=["x"]), P.TargetEncode(inputCols=["word"], outputCols=["m"], target="y"), VectorAssembler(inputCols=["x", "m"], outputCol="f"), LinearRegression(featuresCol="f", labelCol="y")]
    grid = ParamGridBuilder().addGrid(stages[1].weight, [1.0, 10.0]).build()
    search = CrossValidator(estimator=Pipeline(stages=stages), estimatorParamMaps=grid, evaluator=RegressionEvaluator(labelCol="y"), numFolds=2, foldCol="fold")
    search.fit(rows)
    ids = {k: {r["id"] for r in rows.where(F.col("fold") == k).collect()} for k in (0, 1)}
    assert fits[:4].count(ids[0]) == 2 and fits[:4].count(ids[1]) == 2 and fits[4:] == [ids[0] | ids[1]]
    monkeypatch.undo()
    moved = rows.withColumn("y", F.when(F.col("fold") == 1, F.col("y") + 1000).otherwise(F.col("y")))
    part = P.TargetEncode(inputCols=["word"], outputCols=["m"], target="y")
    codes = [sorted((r["id"], r["m"]) for r in part.fit(df.where("fold = 0")).transform(df).collect()) for df in (rows, moved)]
    assert codes[0] == codes[1]
