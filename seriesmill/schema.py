"""Declared columns of a recording: types, bounds and fill rules, kept as schema metadata."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

UNDEFINED = -1


@dataclass(frozen=True)
class FillRule:
    """How to fill missing values.  ``value`` wins over ``method`` (ffill, bfill) whenever it is given.

    ``limit`` is the number of first missing rows filled with ``value``, or the rows ``method`` reaches.
    """

    value: float | None = None
    method: str | None = None
    limit: int | None = None


def _field(name: str, dtype: T.DataType, description: str, **rules) -> T.StructField:
    return T.StructField(name, dtype, True, {"description": description, **rules})


# Channel bounds 0 to 1000, channel fill 0, target fill -1, limit 300 rows,
# target codes OD = 0, ID = 1, UNDEFINED = -1.
_LIMIT = 300
TARGET_CODES = {"OD": 0, "ID": 1, "UNDEFINED": UNDEFINED}
_CHANNEL = dict(lower=0.0, upper=1000.0, fill_value=0.0, fill_method="ffill", fill_limit=_LIMIT)

MEASUREMENTS = T.StructType([
    _field("id", T.StringType(), "measurement"),
    _field("time", T.DoubleType(), "seconds from the start", fill_method="ffill", fill_limit=_LIMIT),
    _field("ch0", T.FloatType(), "first channel along the pipe", **_CHANNEL),
    _field("ch1", T.FloatType(), "second channel along the pipe", **_CHANNEL),
    _field("ch2", T.FloatType(), "third channel along the pipe", **_CHANNEL),
])
LABELS = T.StructType([
    _field("id", T.StringType(), "measurement"),
    _field("target", T.StringType(), "outer (OD) or inner (ID) defect", fill_value=float(UNDEFINED),
           fill_limit=_LIMIT),
])
CHANNELS = ("ch0", "ch1", "ch2")
IGNORED_FEATURES = ("id",)


def declared_types(schema: T.StructType = MEASUREMENTS) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in schema}


def clip_bounds(schema: T.StructType = MEASUREMENTS) -> dict[str, tuple[float | None, float | None]]:
    """Bounds of the columns that declare any."""
    return {f.name: (f.metadata.get("lower"), f.metadata.get("upper")) for f in schema
            if {"lower", "upper"} & f.metadata.keys()}


def fill_rules(schema: T.StructType = MEASUREMENTS) -> dict[str, FillRule]:
    """Fill rules of the columns that declare any."""
    return {f.name: FillRule(f.metadata.get("fill_value"), f.metadata.get("fill_method"),
                             f.metadata.get("fill_limit")) for f in schema
            if {"fill_value", "fill_method"} & f.metadata.keys()}
