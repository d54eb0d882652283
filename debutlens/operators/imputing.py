"""The catalog's imputer as a stage of pyspark.ml pipelines, saved and loaded with them."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from .catalog import FEATURES, FittedImputer, Imputer


class _Named(Params):
    names = Param(Params._dummy(), "names", "features of the catalog, in its order", typeConverter=TypeConverters.toListString)

    def features(self) -> list:
        wanted = set(self.getOrDefault(self.names))
        return [f for f in FEATURES if f.name in wanted]


class CatalogImputer(Estimator, _Named, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the catalog's fill values (mean, exact median or zero) for the features named; all of them by default."""

    @keyword_only
    def __init__(self, *, names: list[str] | None = None):
        super().__init__()
        self._setDefault(names=[f.name for f in FEATURES])
        if names is not None:
            self._set(names=names)

    def _fit(self, dataset: DataFrame) -> CatalogImputerModel:
        fitted = Imputer(self.features()).fit(dataset)
        return self._copyValues(CatalogImputerModel(names=[f.name for f in fitted.features], fills=[float(fitted.fills[f.name]) for f in fitted.features]))


class CatalogImputerModel(Model, _Named, DefaultParamsReadable, DefaultParamsWritable):
    """Coerces, clips and fills; features that the table lacks are added, other columns stay as they are."""

    fills = Param(Params._dummy(), "fills", "fill values, in the order of names", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, names: list[str] | None = None, fills: list[float] | None = None):
        super().__init__()
        if names is not None:
            self._set(names=names, fills=fills)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        named = self.getOrDefault(self.names)
        fitted = FittedImputer(self.features(), dict(zip(named, self.getOrDefault(self.fills), strict=True)))
        return fitted.transform(dataset, [c for c in dataset.columns if c not in set(named)])
