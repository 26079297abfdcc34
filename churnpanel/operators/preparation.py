"""Fitted feature preparation that is stored with the models that need it.

``FeaturePreparation`` learns, on training accounts, which columns to keep (by their rank
correlation with a label) and the range of each; the fitted ``FeaturePreparationModel``
holds nothing but the column list and those constants as parameters, so Spark ML's own
persistence stores it, alone or as a stage of a pipeline, and a new session applies it to
test accounts without any training row."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnpanel.functions.exprs import unit_scale
from churnpanel.operators.correlation import corr_spearman

SCALES = ("minmax", "standard")


class _Preparation(HasInputCols, HasLabelCol, HasOutputCol):
    minimum = Param(Params._dummy(), "minimum", "least |rho| of a column that is kept; 0 keeps all",
                    TypeConverters.toFloat)
    scale = Param(Params._dummy(), "scale", "minmax: to [0, 1]; standard: to mean 0 and deviation 1",
                  TypeConverters.toString)
    keyCol = Param(Params._dummy(), "keyCol", "column that names an account", TypeConverters.toString)
    allowNone = Param(Params._dummy(), "allowNone", "whether a preparation that keeps no column is a result, not an error",
                      TypeConverters.toBoolean)

    def __init__(self):
        super().__init__()
        self._setDefault(minimum=0.0, scale="minmax", keyCol="acc_id", outputCol="features", labelCol="label", allowNone=False)


class FeaturePreparation(Estimator, _Preparation, DefaultParamsReadable, DefaultParamsWritable):
    """Estimator.  Missing values count as 0, the panel's own fill.

    Two aggregations over the training rows: rank correlations (only if ``minimum`` > 0) and
    the ranges.  A column whose correlation is undefined (it is constant) counts as 0.  If no
    column reaches ``minimum``, fitting fails, or with ``allowNone`` keeps none."""

    @keyword_only
    def __init__(self, *, inputCols=None, labelCol=None, outputCol=None, minimum=None, scale=None, keyCol=None,
                 allowNone=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        if self.getOrDefault(self.scale) not in SCALES:
            raise ValueError(f"scale is one of {SCALES}")

    def _fit(self, dataset: DataFrame) -> FeaturePreparationModel:
        columns, label, least = self.getInputCols(), self.getLabelCol(), self.getOrDefault(self.minimum)
        rows = _filled(dataset, columns)
        kept, strengths = columns, []
        if least > 0:
            known = rows.where(F.col(label).isNotNull()).select(
                F.col(self.getOrDefault(self.keyCol)).alias("acc_id"), F.col(label).cast("double").alias("_label"),
                *[F.round(c, 9).alias(c) for c in columns])
            # one row per column
            rho = {r.feature: r.rho or 0.0 for r in corr_spearman(known, columns, ["_label"]).collect()}
            strengths = [round(rho.get(c, 0.0), 9) for c in columns]
            kept = [c for c, r in zip(columns, strengths) if abs(r) >= least]
            if not kept and not self.getOrDefault(self.allowNone):
                raise ValueError(f"no column is correlated with {label} by {least} or more")
        one = rows.agg(F.count(F.lit(1)).alias("n"), *[f(c).alias(f"{n}{i}") for i, c in enumerate(kept) for n, f in (
            ("lo", F.min), ("hi", F.max), ("mean", F.avg), ("std", F.stddev_pop))]).first()
        if not one["n"]:
            raise ValueError("no rows to fit on")
        model = FeaturePreparationModel()
        self._copyValues(model)
        return model._set(
            kept=kept, strengths=strengths,
            **{name: [float(one[f"{short}{i}"]) for i in range(len(kept))]
               for name, short in (("lows", "lo"), ("highs", "hi"), ("means", "mean"), ("deviations", "std"))})


class FeaturePreparationModel(Model, _Preparation, DefaultParamsReadable, DefaultParamsWritable):
    """Scales the kept columns, drops the others and adds the vector of the kept ones.

    All other columns pass through; one named like the vector is replaced.  A constant
    column gives 0; values outside the fitted range are not cut."""

    kept = Param(Params._dummy(), "kept", "columns that are kept, in order", TypeConverters.toListString)
    strengths = Param(Params._dummy(), "strengths", "rho of all input columns", TypeConverters.toListFloat)
    lows = Param(Params._dummy(), "lows", "least value of each kept column", TypeConverters.toListFloat)
    highs = Param(Params._dummy(), "highs", "greatest value of each kept column", TypeConverters.toListFloat)
    means = Param(Params._dummy(), "means", "mean of each kept column", TypeConverters.toListFloat)
    deviations = Param(Params._dummy(), "deviations", "population deviation of each kept column", TypeConverters.toListFloat)

    def columns(self) -> list[str]:
        return self.getOrDefault(self.kept)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        kept, out = self.columns(), self.getOutputCol()
        rows = _filled(dataset, kept).drop(out, *[c for c in self.getInputCols() if c not in kept])
        constants = zip(kept, *[self.getOrDefault(p) for p in (self.lows, self.highs, self.means, self.deviations)])
        if self.getOrDefault(self.scale) == "minmax":
            scaled = {c: unit_scale(f"`{c}`", f"{lo!r}D", f"{hi!r}D") for c, lo, hi, _, _ in constants}
        else:
            scaled = {c: f"coalesce((`{c}` - {mean!r}D) / nullif({std!r}D, 0D), 0D)" for c, _, _, mean, std in constants}
        rows = rows.selectExpr(*[f"{scaled[c]} as `{c}`" if c in scaled else f"`{c}`" for c in rows.columns])
        if not kept:
            return rows.withColumn(out, array_to_vector(F.array().cast("array<double>")))
        return VectorAssembler(inputCols=kept, outputCol=out, handleInvalid="error").transform(rows)

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per input column: rho (NULL unless columns were selected), kept, and the
        range of the kept ones.  Its size is that of the column list."""
        kept, names = self.columns(), self.getInputCols()
        rho = dict(zip(names, self.getOrDefault(self.strengths)))
        at = {c: i for i, c in enumerate(kept)}
        lows, highs = self.getOrDefault(self.lows), self.getOrDefault(self.highs)
        rows = [(c, rho.get(c), int(c in at), lows[at[c]] if c in at else None, highs[at[c]] if c in at else None) for c in names]
        return spark.createDataFrame(rows, "feature string, rho double, kept int, low double, high double")


def _filled(df: DataFrame, columns: list[str]) -> DataFrame:
    chosen = set(columns)
    return df.selectExpr(*[f"coalesce(cast(`{c}` as double), 0D) as `{c}`" if c in chosen else f"`{c}`" for c in df.columns])
