"""Preparation steps as parts of a ``pyspark.ml`` pipeline: fitted on one table, applied to any, saved and loaded.

What a part has learned is a table, written to the shared folder when it is fitted: a transform joins it (or reads its few rows) and
never looks at the training rows again, and a saved part is its parameters and that table. Refitted per fold, as ``CrossValidator`` does with
a pipeline, a part knows the training fold only.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.operators.aggregates import SIMPLE
from lodestat.operators.encoding import ordinal_codes
from lodestat.operators.quantiles import quantile_values
from lodestat.operators.scaling import fit_scaler
from lodestat.session import checkpointed


class _StateWriter(MLWriter):
    def __init__(self, instance: FittedPart):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.state.write.parquet(f"{path}/state")


class _StateReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> FittedPart:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        part = self.kind()
        part._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(part, metadata)
        part.state = SparkSession.getActiveSession().read.parquet(f"{path}/state")
        return part


class _Columns(HasInputCols, HasOutputCols):
    """``outputCols`` take the place of ``inputCols`` one by one; without them the inputs are replaced."""

    def targets(self) -> list[str]:
        made = self.getOutputCols() if self.isSet(self.outputCols) else self.getInputCols()
        if len(made) != len(self.getInputCols()):
            raise ValueError("outputCols and inputCols differ in number")
        return made


class FittedPart(Model, _Columns, MLReadable, MLWritable):
    state: DataFrame

    def write(self) -> MLWriter:
        return _StateWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StateReader(cls)

    def rows(self) -> dict[str, dict]:
        """The state by column, where it is one row a column."""
        return {r["column"]: r.asDict() for r in self.state.collect()}

    def joined(self, df: DataFrame, source: str, target: str, value: Column) -> DataFrame:
        """``target`` from the state's row for the column's value; ``value`` is null where the value wasn't seen. Null values match.

        The state has one row a value, so the rows keep their number and a hot value is only probed.
        """
        known = self.state.where(F.col("column") == source).withColumnRenamed("value", "_value").alias("_s")
        out = [F.col(f"_r.`{c}`") for c in df.columns if c != target]
        same = F.col(f"_r.`{source}`").cast("string").eqNullSafe(F.col("_s._value"))
        return df.alias("_r").join(known, same, "left").select(*out, value.alias(target))


class _Part(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    fitted: type[FittedPart]

    def learned(self, df: DataFrame) -> DataFrame:
        raise NotImplementedError

    def _fit(self, df: DataFrame) -> FittedPart:
        part = self._copyValues(self.fitted(), None)
        part.state = checkpointed(self.learned(df))
        return part.setParent(self) if hasattr(part, "setParent") else part


class ScaledColumns(FittedPart):
    def _transform(self, df: DataFrame) -> DataFrame:
        rows = self.rows()
        made = {t: (F.col(c) - rows[c]["centre"]) / (rows[c]["spread"] or 1.0) for c, t in zip(self.getInputCols(), self.targets(), strict=True)}
        return df.withColumns(made)


class Scale(_Part):
    """(x - centre) / spread: ``kind`` is zscore, minmax, robust or maxabs. A column without a value stays null, one without spread is only centred."""

    fitted = ScaledColumns
    kind = Param(Params._dummy(), "kind", "zscore, minmax, robust or maxabs", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None, kind: str = "zscore"):
        super().__init__()
        self._setDefault(kind="zscore")
        self._set(**self._input_kwargs)

    def learned(self, df: DataFrame) -> DataFrame:
        found = fit_scaler(df, self.getInputCols(), self.getOrDefault(self.kind))
        rows = [(c, *(None if v is None else float(v) for v in (found.centre[c], found.spread[c]))) for c in self.getInputCols()]
        return df.sparkSession.createDataFrame(rows, "column string, centre double, spread double")


class FilledColumns(FittedPart):
    def _transform(self, df: DataFrame) -> DataFrame:
        rows, kinds = self.rows(), dict(df.dtypes)

        def filled(c: str) -> Column:
            number, text = rows[c]["number"], rows[c]["text"]
            return F.coalesce(F.col(c).cast("double"), F.lit(number)) if rows[c]["numeric"] else F.coalesce(F.col(c), F.lit(text).cast(kinds[c]))

        return df.withColumns({t: filled(c) for c, t in zip(self.getInputCols(), self.targets(), strict=True)})


class Fill(_Part):
    """Nulls take the training column's median, mean or mode (``strategy``; of equally frequent values the smallest); a column of nulls stays as it is.

    Median and mean make double columns, the mode keeps the column's type.
    """

    fitted = FilledColumns
    strategy = Param(Params._dummy(), "strategy", "median, mean or mode", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None, strategy: str = "median"):
        super().__init__()
        self._setDefault(strategy="median")
        self._set(**self._input_kwargs)

    def learned(self, df: DataFrame) -> DataFrame:
        columns, strategy = self.getInputCols(), self.getOrDefault(self.strategy)
        if strategy == "median":
            found = quantile_values(df, columns, {"m": 0.5})
            fills = {c: found[f"{c}_m"] for c in columns}
        elif strategy == "mean":
            fills = df.agg(*(SIMPLE["mean"](c).alias(c) for c in columns)).first().asDict()
        elif strategy == "mode":
            fills = {}
            for c in columns:
                top = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "v").first()
                fills[c] = top["v"] if top else None
        else:
            raise ValueError(f"unknown strategy: {strategy}")
        numeric = strategy != "mode"
        rows = [(c, numeric, *((v, None) if numeric else (None, None if v is None else str(v)))) for c, v in fills.items()]
        return df.sparkSession.createDataFrame(rows, "column string, numeric boolean, number double, text string")


def _stacked(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


class OrdinalColumns(FittedPart):
    unknown = Param(Params._dummy(), "unknown", "code of a null and of a value that was not seen", TypeConverters.toInt)

    def _transform(self, df: DataFrame) -> DataFrame:
        for c, t in zip(self.getInputCols(), self.targets(), strict=True):
            df = self.joined(df, c, t, F.coalesce("_s.code", F.lit(self.getOrDefault(self.unknown))))
        return df


class Ordinal(_Part):
    """The place of a value among the sorted values seen, from 0; any number of values."""

    fitted = OrdinalColumns
    unknown = OrdinalColumns.unknown

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None, unknown: int = -999):
        super().__init__()
        self._set(**{"unknown": unknown, **self._input_kwargs})

    def learned(self, df: DataFrame) -> DataFrame:
        return _stacked([ordinal_codes(df, c).select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), "code") for c in self.getInputCols()])


class CountedColumns(FittedPart):
    def _transform(self, df: DataFrame) -> DataFrame:
        for c, t in zip(self.getInputCols(), self.targets(), strict=True):
            df = self.joined(df, c, t, F.coalesce("_s.n", F.lit(0)))
        return df


def _by_value(df: DataFrame, columns: list[str], **sums: Column) -> DataFrame:
    return _stacked([df.groupBy(F.col(c).cast("string").alias("value")).agg(*(s.alias(n) for n, s in sums.items())).withColumn("column", F.lit(c)) for c in columns])


class CountEncode(_Part):
    """How often the training rows hold the value (null is a value); 0 for values not seen."""

    fitted = CountedColumns

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def learned(self, df: DataFrame) -> DataFrame:
        return _by_value(df, self.getInputCols(), n=F.count(F.lit(1)))


class TargetColumns(FittedPart):
    weight = Param(Params._dummy(), "weight", "rows the overall mean counts for", TypeConverters.toFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        weight = self.getOrDefault(self.weight)
        whole = self.state.where("column IS NULL").first()
        prior = whole["total"] / whole["n"] if whole and whole["n"] else None
        pulled = (F.coalesce("_s.total", F.lit(0.0)) + F.lit(prior) * weight) / (F.coalesce("_s.n", F.lit(0)) + weight)
        for c, t in zip(self.getInputCols(), self.targets(), strict=True):
            df = self.joined(df, c, t, pulled)
        return df


class TargetEncode(_Part):
    """The mean of ``target`` over the training rows with the value (null is a value), pulled to the overall mean, which counts as ``weight`` rows."""

    fitted = TargetColumns
    weight = TargetColumns.weight
    target = Param(Params._dummy(), "target", "the column that is averaged", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, outputCols: list[str] | None = None, target: str | None = None, weight: float = 1.0):
        super().__init__()
        self._set(**{"weight": weight, **self._input_kwargs})

    def learned(self, df: DataFrame) -> DataFrame:
        y = F.col(self.getOrDefault(self.target)).cast("double")
        known = df.where(y.isNotNull())
        whole = known.agg(F.sum(y).alias("total"), F.count(y).alias("n")).select(F.lit(None).cast("string").alias("column"), F.lit(None).cast("string").alias("value"), "total", "n")
        return _by_value(known, self.getInputCols(), total=F.sum(y), n=F.count(y)).unionByName(whole)
