"""Column bindings and settings.

A ``Spec`` says which columns of a table play which part (time, measure,
category, ...), so one operator serves any timestamped measurement table.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from types import MappingProxyType

# Fixed values -------------------------------------------------------------
LEVELS = ("low", "medium", "high")          # order of the bucket rule
LEVEL_INDEX = ("high", "low", "medium")     # alphabetical: position = label index
QUANTILE_PROBS = (0.05, 0.25, 0.5, 0.75, 0.95)
QUANTILE_NAMES = ("p05", "p25", "p50", "p75", "p95")
KELVIN_OFFSET = 273.15


@dataclass(frozen=True)
class Spec:
    """Which column is which, and the bounds that belong to the semantics."""

    time: str = "date_time"
    measure: str = "traffic_volume"
    category: str = "weather_main"
    detail: str = "weather_description"
    holiday: str = "holiday"
    temp: str = "temp"
    numeric: tuple[str, ...] = ("temp", "rain_1h", "snow_1h", "clouds_all", "traffic_volume")
    low_max: float = 1500      # measure <= low_max  -> low
    high_min: float = 3500     # measure >= high_min -> high
    min_temp: float = 200      # rows at or below are sensor faults
    no_holiday: str = "None"
    null_is_holiday: bool = True
    whole_day_holidays: bool = False   # a holiday row marks every row of its day
    split_key: str | None = None   # column hashed for the split; time if None

    @property
    def key(self) -> str:
        return self.split_key or self.time


@dataclass(frozen=True)
class FeatureSpec:
    """Inputs of the feature vector, in slot order: scalars, one-hots, hashed categories."""

    scalars: tuple[str, ...] = (
        "hour", "day_of_week", "month", "is_weekend", "is_holiday",
        "temp_c", "rain_1h", "snow_1h", "clouds_all",
    )
    categories: tuple[str, ...] = ("weather_main", "season")
    # Categories without a known number of values: each has ``hash_slots`` slots.
    hashed: tuple[str, ...] = ()
    hash_slots: int = 1 << 12

    @property
    def inputs(self) -> tuple[str, ...]:
        return self.scalars + self.categories + self.hashed


# Hyper-parameters of the published fits, and the tuning grids,
# by Spark ML's class and parameter names.
PARAMS: Mapping[str, Mapping[str, object]] = MappingProxyType({
    "LogisticRegression": {"maxIter": 100, "regParam": 0.0, "elasticNetParam": 0.0},
    "DecisionTree": {"maxDepth": 7, "maxBins": 64},
    "RandomForest": {
        "numTrees": 50, "maxDepth": 15, "maxBins": 64, "subsamplingRate": 0.9,
        "featureSubsetStrategy": "log2"},
})
GRIDS: Mapping[str, Mapping[str, list]] = MappingProxyType({
    "LogisticRegression": {"regParam": [0.0, 0.01, 0.1], "elasticNetParam": [0.0, 0.5]},
    "DecisionTree": {"maxDepth": [6, 8, 10, 12]},
    "RandomForest": {"numTrees": [60, 100], "maxDepth": [12, 15]},
})


@dataclass(frozen=True)
class ModelSettings:
    """How rows are split, and what each classifier is fitted and tuned with."""

    params: Mapping[str, Mapping[str, object]] = field(default_factory=lambda: dict(PARAMS))
    grids: Mapping[str, Mapping[str, list]] = field(default_factory=lambda: dict(GRIDS))
    tune: bool = False
    folds: int = 3
    parallel_fits: int = 2
    train_share: float = 0.8
    split_salt: str = ""       # another text draws another split
    seed: int = 42             # of the estimators
    # Memory for one round of split statistics of a tree; more means fewer
    # passes over the training rows for deep forests.
    tree_memory_mb: int = 1024
    # Partitions the training rows are laid out in; None follows their size.
    partitions: int | None = None
    # Beyond this many training rows, equal ones are joined into rows with a weight,
    # none above the rows divided by this.
    whole_rows: int = 1 << 18

    def fitted_with(self, model: str, **params) -> ModelSettings:
        return replace(self, params={**self.params, model: {**self.params[model], **params}})

    def tuned_over(self, model: str, **grid) -> ModelSettings:
        return replace(self, tune=True, grids={**self.grids, model: grid})
