"""ML pipeline stages of our own (F18, M2): behavioural features and median imputation, saved and loaded like any stage."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditlens.operators.features import BILL_COLUMNS, FEATURE_CLIP, FEATURE_NAMES, PAY_COLUMNS, PAYMENT_COLUMNS, engineer_features
from creditlens.operators.harmonize import column_medians


class BehavioralFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Replaces the six-month history columns by the 17 features; other columns stay."""

    clip = Param(Params._dummy(), "clip", "features are clipped to [-clip, clip]", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, clip: float = FEATURE_CLIP):
        super().__init__()
        self._setDefault(clip=FEATURE_CLIP)
        self._set(**self._input_kwargs)

    def names(self) -> list[str]:
        return list(FEATURE_NAMES)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        history = {"LIMIT_BAL", *PAY_COLUMNS, *BILL_COLUMNS, *PAYMENT_COLUMNS}
        lacking = history - set(dataset.columns)
        if lacking:
            raise ValueError(f"missing columns: {', '.join(sorted(lacking))}")
        return engineer_features(dataset, keep=[c for c in dataset.columns if c not in history], clip_bound=self.getOrDefault(self.clip))


class _Columns(Params):
    inputCols = Param(Params._dummy(), "inputCols", "numeric columns to fill", TypeConverters.toListString)
    indicators = Param(Params._dummy(), "indicators", "add <column>_missing as 0 or 1", TypeConverters.toBoolean)


class MedianImputerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    medians = Param(Params._dummy(), "medians", "median of each input column", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols, flags = {}, {}
        for c, m in zip(self.getOrDefault(self.inputCols), self.getOrDefault(self.medians)):
            x = F.col(c).cast("double")
            gone = x.isNull() | F.isnan(x)
            cols[c] = F.when(gone, F.lit(m)).otherwise(x)
            flags[f"{c}_missing"] = gone.cast("int")
        clash = set(flags) & set(dataset.columns) if self.getOrDefault(self.indicators) else set()
        if clash:
            raise ValueError(f"columns exist already: {', '.join(sorted(clash))}")
        return dataset.withColumns({**(flags if self.getOrDefault(self.indicators) else {}), **cols})


class MedianImputer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Exact interpolated medians of all columns from one histogram of (column, value).

    NULL and NaN are missing; a column without any value is filled with 0.
    """

    @keyword_only
    def __init__(self, inputCols: list[str] | None = None, indicators: bool = True):
        super().__init__()
        self._setDefault(indicators=True)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> MedianImputerModel:
        names = self.getOrDefault(self.inputCols)
        found = {r["column"]: r["median"] for r in column_medians(dataset, names).collect()}  # a row per column
        model = MedianImputerModel()
        model._set(inputCols=names, indicators=self.getOrDefault(self.indicators), medians=[found.get(c, 0.0) for c in names])
        return model
