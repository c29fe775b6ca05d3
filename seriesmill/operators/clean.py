"""Row cleaning.  Missing is NULL from ingest on; NaN never travels further."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.operators import blocks
from seriesmill.schema import FillRule

_FLOATING = (T.FloatType, T.DoubleType)
_RANGES = {t: (-(2 ** (8 * n - 1)), 2 ** (8 * n - 1) - 1)
           for t, n in ((T.ByteType, 1), (T.ShortType, 2), (T.IntegerType, 4), (T.LongType, 8))}


def _floating(df: DataFrame, columns: Iterable[str] | None) -> list[str]:
    wanted = None if columns is None else set(columns)
    return [f.name for f in df.schema if isinstance(f.dataType, _FLOATING) and (wanted is None or f.name in wanted)]


def nan_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    return df.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit(float("nan"))) for c in _floating(df, columns)})


def inf_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Both infinities become missing in every float column."""
    return df.withColumns({
        c: F.when(F.abs(F.col(f"`{c}`")) != float("inf"), F.col(f"`{c}`")) for c in _floating(df, columns)
    })


def clip(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]] | None) -> DataFrame:
    """Clamp to (lower, upper); a bound of None is open and missing stays missing.

    Integers are compared as they are wide enough for.  They keep their type unless a bound that rows can be set to
    does not fit it: then the column becomes bigint, or double for a bound with a fraction.
    """
    def clamped(name: str) -> Column:
        dtype, (lower, upper) = df.schema[name].dataType, bounds[name]
        c = x = F.col(f"`{name}`")
        if isinstance(dtype, T.IntegralType):
            given = [b for b in (lower, upper) if b is not None and abs(b) != float("inf")]
            wide = T.LongType() if all(float(b).is_integer() and abs(b) < 2**63 for b in given) else T.DoubleType()
            x = x.cast(wide)
            whole = isinstance(wide, T.LongType)
            if lower is not None and lower in given:
                x = F.greatest(x, F.lit(int(lower) if whole else float(lower)).cast(wide))
            if upper is not None and upper in given:
                x = F.least(x, F.lit(int(upper) if whole else float(upper)).cast(wide))
            low, high = _RANGES[type(dtype)]
            fits = whole and (lower is None or lower <= high) and (upper is None or upper >= low)
            return F.when(c.isNotNull(), x.cast(dtype) if fits else x)
        if lower is not None:
            x = F.greatest(x, F.lit(lower).cast(dtype))
        if upper is not None:
            x = F.least(x, F.lit(upper).cast(dtype))
        return F.when(c.isNotNull(), x)

    return df.withColumns({c: clamped(c) for c in bounds or {} if c in df.columns})


def replace_nonpositive(df: DataFrame, value: float = 0.01) -> DataFrame:
    """Numeric cells at or below zero become ``value`` in single precision."""
    small = F.lit(value).cast("float")
    return df.withColumns({
        f.name: F.when(F.col(f"`{f.name}`") <= 0, small).otherwise(F.col(f"`{f.name}`"))
        for f in df.schema if isinstance(f.dataType, T.NumericType)
    })


def fill_label(df: DataFrame, column: str = "target", value: int = 0) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(f"`{column}`"), F.lit(value).cast(df.schema[column].dataType)))


def fill(df: DataFrame, rules: Mapping[str, FillRule], ids: Sequence[str] = ("id",),
         order: Sequence[str] = ("time",), max_rows: int = blocks.MAX_ROWS,
         found: blocks.LongSeries | None = None) -> DataFrame:
    """Fill missing values inside each series; columns that share a kind of rule share one pass.

    ``found`` passes on a check of the same series.
    """
    rules = {c: r for c, r in rules.items() if c in df.columns and (r.value is not None or r.method)}
    for c, r in rules.items():
        if r.value is None and r.method not in ("ffill", "bfill"):
            raise ValueError(f"unknown fill method {r.method!r} for {c}")
    constant = {c: r for c, r in rules.items() if r.value is not None}
    whole = {c: r for c, r in constant.items() if r.limit is None}
    counted = {c: r for c, r in constant.items() if r.limit is not None}
    carried = {c: r for c, r in rules.items() if r.value is None}
    near = {c: r for c, r in carried.items() if r.limit is not None}
    columns = df.columns
    if found is None and (counted or carried):
        found = blocks.long_series(df, ids, order, max_rows)

    def literal(c: str) -> Column:
        return F.lit(rules[c].value).cast(df.schema[c].dataType)

    if whole:
        df = df.withColumns({c: F.coalesce(F.col(f"`{c}`"), literal(c)) for c in whole})
    if counted:
        # The limit counts missing rows of the series in total, not in a run.
        totals = {f"__gap_{c}": ("sum", F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0)) for c in counted}
        df = blocks.run_totals(df, ids, order, totals, False, max_rows, found)
        df = df.withColumns({
            c: F.when(F.col(f"`{c}`").isNull() & (F.col(f"`__gap_{c}`") <= r.limit), literal(c))
            .otherwise(F.col(f"`{c}`")) for c, r in counted.items()
        }).drop(*totals)
    if near:
        def add(rows: DataFrame, keys: list[str]) -> DataFrame:
            by = Window.partitionBy(*keys).orderBy(*order)
            return rows.withColumns({
                c: F.last(F.col(f"`{c}`"), True).over(by.rowsBetween(-r.limit, 0)) if r.method == "ffill"
                else F.first(F.col(f"`{c}`"), True).over(by.rowsBetween(0, r.limit))
                for c, r in near.items()
            })

        back = max([r.limit for r in near.values() if r.method == "ffill"], default=0)
        ahead = max([r.limit for r in near.values() if r.method == "bfill"], default=0)
        df = blocks.over_series(df, ids, order, back, ahead, add, max_rows, found)
    for method in ("ffill", "bfill"):
        far = [c for c, r in carried.items() if r.limit is None and r.method == method]
        if far:
            totals = {f"__seen_{c}": ("last", F.col(f"`{c}`")) for c in far}
            df = blocks.run_totals(df, ids, order, totals, method == "bfill", max_rows, found)
            df = df.withColumns({c: F.col(f"`__seen_{c}`") for c in far})
    return df.select(*[F.col(f"`{c}`") for c in columns])
