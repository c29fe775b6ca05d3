"""Stages of the analysis as DataFrame transformations, and the registry of named steps."""

from __future__ import annotations

import dataclasses
import json
from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, Transformer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from seriesmill.functions.scalar import convert
from seriesmill.operators import blocks, clean, columns, lookups, resample, signal, windows
from seriesmill.operators.windows import RollingSpec
from seriesmill.schema import CHANNELS, MEASUREMENTS, FillRule, clip_bounds, declared_types, fill_rules
from seriesmill.sources.files import chunk_rows

# Fixed value: window of the default feature.
MEDIAN_WINDOW = 120

STEPS: dict[str, Callable[..., DataFrame]] = {
    "clip": clean.clip,
    "inf_to_null": clean.inf_to_null,
    "fill": clean.fill,
    "replace_nonpositive": clean.replace_nonpositive,
    "cast_declared": columns.cast_declared,
    "narrow_types": columns.narrow_types,
    "dedupe_columns": columns.dedupe_columns,
    "mark_target": lookups.mark_target,
    "resample_mean": resample.resample_mean,
    "rolling": windows.rolling,
    "convert": convert,
    "fft_denoise": signal.fft_denoise,
    "wavelet_denoise": signal.wavelet_denoise,
}


#: Custom functions that saved pipelines may name, by name; a process that loads one registers the same.
CUSTOM: dict[str, object] = {}


def register(name: str, function: object) -> None:
    """Give a step's or a feature's custom function a name that pipelines are saved under."""
    CUSTOM[name] = function


def _plain(value: object) -> object:
    """A setting as JSON."""
    if value is None or isinstance(value, (bool, int, float, str)):
        return value
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    if isinstance(value, dict) and all(isinstance(k, str) for k in value):
        return {"map": {k: _plain(v) for k, v in value.items()}}
    if isinstance(value, T.DataType):
        return {"type": value.json()}
    for kind in (RollingSpec, FillRule):
        if isinstance(value, kind):
            return {"new": kind.__name__, "of": {f.name: _plain(getattr(value, f.name)) for f in dataclasses.fields(value)}}
    for name, function in CUSTOM.items():
        if function is value:
            return {"custom": name}
    raise ValueError(f"a pipeline with {value!r} cannot be saved; functions must be registered by name first")


def _rebuilt(value: object) -> object:
    if isinstance(value, list):
        return [_rebuilt(v) for v in value]
    if not isinstance(value, dict):
        return value
    if "map" in value:
        return {k: _rebuilt(v) for k, v in value["map"].items()}
    if "type" in value:
        return T._parse_datatype_json_string(value["type"])
    if "new" in value:
        return {"RollingSpec": RollingSpec, "FillRule": FillRule}[value["new"]](**{k: _rebuilt(v) for k, v in value["of"].items()})
    if value["custom"] not in CUSTOM:
        raise KeyError(f"the pipeline uses {value['custom']!r}, which is not registered here")
    return CUSTOM[value["custom"]]


class _StepWriter(MLWriter):
    def __init__(self, step: Step) -> None:
        super().__init__()
        self.step = step

    def saveImpl(self, path: str) -> None:
        names = [name for name, function in STEPS.items() if function is self.step.function]
        about = {"step": names[0]} if names else {"function": _plain(self.step.function)}
        about["settings"] = {k: _plain(v) for k, v in self.step.settings.items()}
        DefaultParamsWriter.saveMetadata(self.step, path, self.sparkSession, extraMetadata={"step": json.dumps(about)})


class _StepReader(MLReader):
    def load(self, path: str) -> Step:
        about = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        said = json.loads(about["step"])
        step = Step(said["step"] if "step" in said else _rebuilt(said["function"]), **{k: _rebuilt(v) for k, v in said["settings"].items()})
        step._resetUid(about["uid"])
        return step


class Step(Transformer, MLWritable, MLReadable):
    """A DataFrame function with its settings as a stage of a Spark ML pipeline.

    It is saved with the pipeline: the function by its name in ``STEPS`` or ``CUSTOM``, the settings as JSON.  A function
    without a name, or the check of one table's series (``found``), is an error when saving.
    """

    def __init__(self, function: str | Callable[..., DataFrame], **settings) -> None:
        super().__init__()
        self.function = STEPS[function] if isinstance(function, str) else function
        self.settings = settings

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.function(dataset, **self.settings)

    def write(self) -> MLWriter:
        return _StepWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StepReader()


def preprocess(df: DataFrame, schema=MEASUREMENTS, ids: Sequence[str] = ("id",), order: Sequence[str] = ("time",),
               narrow: bool = False, max_rows: int = blocks.MAX_ROWS,
               found: blocks.LongSeries | None = None) -> DataFrame:
    """Clip, infinities to missing, fill, cast to the declared types, in this order.

    Bounds therefore catch infinities of declared columns.  ``narrow`` also shrinks undeclared columns,
    which costs a pass over the data.
    """
    rules = {c: r for c, r in fill_rules(schema).items() if c not in (*ids, *order)}
    types = {c: t for c, t in declared_types(schema).items() if c not in (*ids, *order)}
    return (
        df.transform(clean.clip, clip_bounds(schema))
        .transform(clean.inf_to_null)
        .transform(clean.fill, rules, ids, order, max_rows, found)
        .transform(columns.cast_declared, types, narrow)
    )


def default_features(channels: Sequence[str] = CHANNELS, min_periods: int | None = None) -> list[RollingSpec]:
    """Rolling median of each channel."""
    return [RollingSpec(c, "median", window=MEDIAN_WINDOW, min_periods=min_periods,
                        name=f"{c}_median_{MEDIAN_WINDOW}_shift_0") for c in channels]


def feature_pipeline(specs: Sequence[RollingSpec] | None = None, ids: Sequence[str] = ("id",),
                     order: Sequence[str] = ("time",), max_rows: int = blocks.MAX_ROWS,
                     found: blocks.LongSeries | None = None, keep: Sequence[str] | None = None) -> Pipeline:
    """Infinities to missing, then the features.  ``found`` and ``keep`` as in ``rolling``."""
    specs = default_features() if specs is None else list(specs)
    return Pipeline(stages=[
        Step("inf_to_null"),
        Step("rolling", specs=specs, ids=ids, order=order, max_rows=max_rows, found=found, keep=keep),
    ])


def build_features(df: DataFrame, specs: Sequence[RollingSpec] | None = None, **settings) -> tuple[DataFrame, list[str]]:
    """Rows with their features, and the names of the new columns."""
    out = feature_pipeline(specs, **settings).fit(df).transform(df)
    return out, [c for c in out.columns if c not in df.columns]


def plot_series(df: DataFrame, predictions: DataFrame, rows: int | None = None, ids: Sequence[str] = ("id",),
                order: Sequence[str] = ("time",), max_rows: int = blocks.MAX_ROWS) -> DataFrame:
    """Plot-ready rows: the measurements that have predictions, with them, in chunks."""
    chosen = predictions.select(*ids).distinct()
    shown = lookups.attach(df, chosen, ids, "left_semi", max_rows=max_rows)
    both = lookups.attach_predictions(shown, predictions, [*ids, *order])
    return chunk_rows(both, rows, ids, order, max_rows)
