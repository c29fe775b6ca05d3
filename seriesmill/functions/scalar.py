"""Column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.operators.blocks import micros, ticks_per_second

# Accepted method names.
METHODS = ("divide", "subtract", "substract", "normalize")


def convert(df: DataFrame, first: str, second: str, method: str = "divide", name: str | None = None) -> DataFrame:
    """Ratio, difference or relative difference of two columns, single precision, three decimals.

    Halves round to even; a zero divisor gives NULL.
    """
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; known: {METHODS}")
    missing = [c for c in (first, second) if c not in df.columns]
    if missing:
        raise KeyError(missing)
    a, b = F.col(f"`{first}`").cast("double"), F.col(f"`{second}`").cast("double")
    if method == "divide":
        value = F.try_divide(a, b)
    elif method == "normalize":
        value = F.try_divide(a - b, b)
    else:
        value = a - b
    return df.withColumn(name or f"{first}_{second}_{method}", F.bround(value.cast("float"), 3))


def normalize_name(name: Column) -> Column:
    return F.upper(F.replace(name, F.lit(" "), F.lit("")))


def file_stem(name: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1)


def map_code(value: Column, codes: Mapping) -> Column:
    """Code of each value, NULL where it has none."""
    out = None
    for name, code in codes.items():
        hit = value == F.lit(name)
        out = F.when(hit, F.lit(code)) if out is None else out.when(hit, F.lit(code))
    return out if out is not None else F.lit(None).cast("int")


def total_seconds(df: DataFrame, start: str, end: str) -> Column:
    """Seconds between two time columns, with their fraction; numeric columns hold seconds."""
    units = ticks_per_second(df, start), ticks_per_second(df, end)
    if units[0] == units[1]:  # the difference of exact numbers is exact
        return (micros(df, end) - micros(df, start)) / F.lit(float(units[0]))
    return micros(df, end) / F.lit(float(units[1])) - micros(df, start) / F.lit(float(units[0]))
