"""Column types, duplicate columns and column profiles: one aggregate for all columns, one projection."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)
FLOAT_MAX = 3.4028234663852886e38


def narrow_types(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Smallest integer or float type whose open range holds the values of each column.

    There is no half float in Spark, so floats end at single precision.
    """
    fields = [f for f in df.schema if columns is None or f.name in columns]
    numeric = [f for f in fields if isinstance(f.dataType, _INTEGERS + _FLOATING)]
    if not numeric:
        return df
    seen = df.agg(*[agg(F.col(f"`{f.name}`")) for f in numeric for agg in (F.min, F.max)]).first()

    def smallest(dtype: T.DataType, low, high) -> T.DataType:
        if low is None:
            return dtype
        if isinstance(dtype, _FLOATING):
            return T.FloatType() if -FLOAT_MAX < low and high < FLOAT_MAX else T.DoubleType()
        for bits, small in ((8, T.ByteType()), (16, T.ShortType()), (32, T.IntegerType())):
            if -(2 ** (bits - 1)) < low and high < 2 ** (bits - 1) - 1:
                return small
        return T.LongType()

    types = {f.name: smallest(f.dataType, seen[2 * i], seen[2 * i + 1]) for i, f in enumerate(numeric)}
    return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`")
                       for c in df.columns])


def cast_declared(df: DataFrame, types: Mapping[str, T.DataType | str], narrow: bool = True) -> DataFrame:
    """Cast the declared columns that are present, bad values to NULL; narrow the others."""
    rest = [c for c in df.columns if c not in types]
    df = df.select(*[F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types else F.col(f"`{c}`")
                     for c in df.columns])
    return narrow_types(df, rest) if narrow and rest else df


def dedupe_columns(df: DataFrame) -> DataFrame:
    """Of columns with the same name keep the most filled one, the first on ties, moved to the end."""
    names = df.columns
    repeated = [name for name, n in Counter(names).most_common() if n > 1]
    if not repeated:
        return df
    by_place = df.toDF(*[f"c{i}" for i in range(len(names))])
    places = {name: [i for i, c in enumerate(names) if c == name] for name in repeated}
    filled = by_place.agg(*[F.count(f"c{i}").alias(f"c{i}") for at in places.values() for i in at]).first()
    kept = [i for i, name in enumerate(names) if name not in places]
    kept += [max(at, key=lambda i: (filled[f"c{i}"], -i)) for at in places.values()]
    return by_place.select(*[F.col(f"c{i}").alias(names[i]) for i in kept])


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def select_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(missing)
    return df.select(*[F.col(f"`{c}`") for c in columns])


def profile_columns(df: DataFrame) -> DataFrame:
    """One row per column: rows, filled, fill_rate, n_inf, n_nan, min_value, max_value (numbers only)."""
    def stats(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        floating, numeric = isinstance(f.dataType, _FLOATING), isinstance(f.dataType, T.NumericType)
        none = F.lit(None).cast("double")
        return F.struct(
            F.lit(f.name).alias("column"),
            F.count(F.lit(1)).alias("rows"),
            F.count(c).alias("filled"),
            F.try_divide(F.count(c), F.count(F.lit(1))).alias("fill_rate"),
            (F.count_if(F.abs(c) == float("inf")) if floating else F.lit(0).cast("long")).alias("n_inf"),
            (F.count_if(F.isnan(c)) if floating else F.lit(0).cast("long")).alias("n_nan"),
            (F.min(c).cast("double") if numeric else none).alias("min_value"),
            (F.max(c).cast("double") if numeric else none).alias("max_value"),
        )

    return df.agg(F.array(*[stats(f) for f in df.schema]).alias("s")).select(F.inline("s"))
