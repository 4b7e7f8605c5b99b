"""Model registry and the calibrate / evaluate / refit helpers around it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidewheel.plans import evaluate as E
from tidewheel.session import cut_lineage

# A forecaster maps (training panel, future frame with regressors) to id, k, ts, prediction.
Forecaster = Callable[[DataFrame, DataFrame], DataFrame]


@dataclass
class ModelTable:
    """Named forecasters; ids are given in order of registration."""

    models: dict[str, tuple[str, Forecaster]] = field(default_factory=dict)

    def add(self, fn: Forecaster, desc: str) -> ModelTable:
        self.models[str(len(self.models) + 1)] = (desc, fn)
        return self

    def combine(self, other: ModelTable) -> ModelTable:
        out = ModelTable(dict(self.models))
        for desc, fn in other.models.values():
            out.add(fn, desc)
        return out

    def describe(self, model_id: str, desc: str) -> ModelTable:
        self.models[model_id] = (desc, self.models[model_id][1])
        return self

    def pluck(self, model_id: str) -> Forecaster:
        return self.models[model_id][1]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(m, d) for m, (d, _) in self.models.items()], "model_id string, model_desc string")

    def forecast(self, train: DataFrame, future: DataFrame) -> DataFrame:
        """All models over all ids; one union, no loop over series."""
        from pyspark.sql import functions as F
        out = None
        for m, (_, fn) in self.models.items():
            f = fn(train, future).select("id", "k", "ts", F.lit(m).alias("model_id"), "prediction")
            out = f if out is None else out.unionByName(f)
        return out


def calibrate_evaluate(models: ModelTable, split: DataFrame, y: str = "y", by_id: bool = True):
    """(calibration, accuracy, forecast table) of every model on the test segment; the split panel is written once for all of them."""
    from tidewheel.plans.resample import testing, training
    split = cut_lineage(split)
    train, test = training(split), testing(split)
    fc = models.forecast(train, test)
    cal = E.calibrate(fc, test, y)
    acc = E.accuracy(cal, ("model_id", "id") if by_id else ("model_id",))
    return cal, acc, E.forecast_table(split.drop("segment"), fc, y)


def refit(models: ModelTable, data: DataFrame, future: DataFrame) -> DataFrame:
    """Fit on all rows, forecast the future frame; both are written once for all models."""
    return models.forecast(cut_lineage(data), cut_lineage(future))
