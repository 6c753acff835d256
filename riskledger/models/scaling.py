"""Standardising by the population deviation, as a stage that is saved with the model."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _Columns(HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, inputCols=None, outputCol=None):
        super().__init__()
        self._set(**self._input_kwargs)


class PopulationScaler(_Columns, Estimator):
    """Means and population deviations of numeric columns, in one aggregate.

    Nulls are left out of the fit. ``pyspark.ml``'s scaler divides by the sample deviation.
    """

    def _fit(self, dataset: DataFrame) -> PopulationScalerModel:
        columns = self.getInputCols()
        values = [F.col(c).cast("double") for c in columns]
        row = dataset.agg(
            F.array(*[F.coalesce(F.avg(v), F.lit(0.0)) for v in values]).alias("means"),
            F.array(*[F.coalesce(F.stddev_pop(v), F.lit(0.0)) for v in values]).alias("deviations"),
        ).first()
        model = PopulationScalerModel(inputCols=columns, outputCol=self.getOutputCol())
        return model._set(means=row["means"], deviations=row["deviations"])


class PopulationScalerModel(_Columns, Model):
    """Adds a vector of z-scores: zero where a column did not vary, NaN where it is null."""

    means = Param(Params._dummy(), "means", "mean of each column", TypeConverters.toListFloat)
    deviations = Param(
        Params._dummy(), "deviations", "population deviation of each", TypeConverters.toListFloat
    )

    def z_scores(self) -> list:
        fitted = zip(
            self.getInputCols(), self.getOrDefault("means"), self.getOrDefault("deviations")
        )
        return [
            F.when(F.col(c).isNull(), F.lit(float("nan"))).otherwise(
                (F.col(c).cast("double") - F.lit(m)) / F.lit(d) if d > 0 else F.lit(0.0)
            )
            for c, m, d in fitted
        ]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), array_to_vector(F.array(*self.z_scores())))
