"""Rolling and expanding features of a series: one spec, many settings.

Frames always stay inside one series.  See ``blocks`` for how series of any length are spread.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.operators import blocks, growing, kernels, mergeable
from seriesmill.operators.mergeable import Mergeable
from seriesmill.storage import reliable

CLOSED = ("right", "left", "both", "neither")

# Functions that need the values of the frame at hand; None is a quantile.
HOLISTIC = (None, "median", "rank")
# Cost of all features of a row above which sliding kernels take over from Spark windows; measured.
WIDE = 80


@dataclass(frozen=True)
class RollingSpec:
    """One feature.

    ``func`` is a name from ``FUNCTIONS``, a ``Mergeable``, a function of a pandas Series to a number, or None when
    ``quantile`` is given; ``func`` wins if both are.  ``window=None`` is an expanding frame; a custom function of it
    must be a ``Mergeable``, since one of a Series would need all earlier rows anew for every row.  With ``filter_column`` the
    frame counts only the rows equal to ``filter_value`` and other rows get NULL.  ``shift`` moves the
    result by rows of the whole series, forward if positive.
    """

    source: str
    func: str | Mergeable | Callable[[pd.Series], float] | None = None
    quantile: float | None = None
    window: int | None = None
    min_periods: int | None = None
    center: bool = False
    closed: str = "right"
    win_type: str | None = None
    std: float | None = None
    shape: float | None = None
    filter_column: str | None = None
    filter_value: object = None
    shift: int = 0
    name: str | None = None

    def __post_init__(self) -> None:
        if self.func is None and self.quantile is None:
            raise AttributeError(f"give a function or a quantile for {self.source}")
        if isinstance(self.func, str) and self.func not in FUNCTIONS:
            raise ValueError(f"unknown function {self.func!r}; known: {sorted(FUNCTIONS)}")
        if self.func is None and not 0 <= self.quantile <= 1:
            raise ValueError("quantile must lie between 0 and 1")
        if self.closed not in CLOSED:
            raise ValueError(f"closed must be one of {CLOSED}")
        if self.window is None and (self.center or self.closed != "right" or self.win_type):
            raise TypeError("an expanding frame takes no center, closed or win_type")
        if self.window is not None and self.window < 1:
            raise ValueError("window must be at least 1")
        if self.min_periods is not None and self.window is not None and self.min_periods > self.window:
            raise ValueError("min_periods must not exceed the window")
        if self.win_type and (self.func not in ("sum", "mean", "var", "std") or self.closed != "right"):
            raise ValueError("weights go with sum, mean, var or std over a right-closed frame")
        if self.window is None and callable(self.func):
            raise TypeError("a custom function of all earlier rows must be Mergeable; one of a Series needs a window")

    @property
    def column(self) -> str:
        if self.name:
            return self.name
        func = self.func if isinstance(self.func, str) or self.func is None else self.func.__name__
        parts = (self.source, self.filter_column, self.filter_value, func,
                 self.quantile if self.func is None else None, self.window, self.min_periods, self.shift)
        return "_".join(str(p) for p in parts if p is not None)

    @property
    def least(self) -> int:
        """Values (rows, for count) a frame must hold to give a result."""
        if self.min_periods is not None:
            return self.min_periods
        return 1 if self.window is None else self.window

    @property
    def cost(self) -> float:
        """Rows a Spark window goes through for one result, as it redoes a sliding frame for every row."""
        if callable(self.func) or isinstance(self.func, Mergeable) or self.win_type and self.func in ("var", "std"):
            return math.inf
        holistic = self.func in HOLISTIC
        if self.window is None:
            return math.inf if holistic else 0
        return self.window * (3 if holistic else 1)

    @property
    def reach(self) -> tuple[int, int]:
        """First and last row of a bounded frame, relative to the current row."""
        ahead = (self.window - 1) // 2 if self.center else 0
        first = -(self.window - 1) - (self.closed in ("left", "both"))
        last = -1 if self.closed in ("left", "neither") else 0
        return first + ahead, last + ahead


def quantile_of(values: Column, q: float) -> Column:
    """Quantile of a sorted array, linear between neighbours; NULL if it is empty."""
    def pick(s: Column) -> Column:
        at = F.lit(float(q)) * (F.size(s) - 1)
        low = F.floor(at).cast("int")
        below, above = F.get(s, low), F.get(s, F.ceil(at).cast("int"))
        return below + (above - below) * (at - low)

    return F.get(F.transform(F.array(values), pick), F.lit(0))


def skewness(n: Column, g1: Column, variance: Column) -> Column:
    """Bias-corrected skewness from the population one."""
    corrected = F.when(variance == 0, F.lit(0.0)).otherwise(g1 * F.sqrt(n * (n - 1)) / (n - 2))
    return F.when(n >= 3, corrected)


def kurtosis(n: Column, g2: Column, variance: Column) -> Column:
    """Bias-corrected excess kurtosis from the population one."""
    corrected = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)
    return F.when(n >= 4, F.when(variance == 0, F.lit(-3.0)).otherwise(corrected))


def _sorted_frame(x: Column, w: WindowSpec) -> Column:
    return F.sort_array(F.collect_list(x).over(w))


def _rank(x: Column, w: WindowSpec) -> Column:
    frame = F.collect_list(x).over(w)
    below = F.size(F.filter(frame, lambda v: v < x))
    same = F.size(F.filter(frame, lambda v: v == x))
    return F.when(x.isNotNull(), below + (same + 1) / 2)


# name: (value column, frame) -> result.  All but count ignore missing values.
FUNCTIONS: dict[str, Callable[[Column, WindowSpec], Column]] = {
    "sum": lambda x, w: F.sum(x).over(w),
    "mean": lambda x, w: F.avg(x).over(w),
    "median": lambda x, w: quantile_of(_sorted_frame(x, w), 0.5),
    "min": lambda x, w: F.min(x).over(w),
    "max": lambda x, w: F.max(x).over(w),
    "std": lambda x, w: F.stddev_samp(x).over(w),
    "var": lambda x, w: F.var_samp(x).over(w),
    "count": lambda x, w: F.count(x).over(w).cast("double"),
    "skew": lambda x, w: skewness(F.count(x).over(w), F.skewness(x).over(w), F.var_pop(x).over(w)),
    "kurt": lambda x, w: kurtosis(F.count(x).over(w), F.kurtosis(x).over(w), F.var_pop(x).over(w)),
    "sem": lambda x, w: F.stddev_samp(x).over(w) / F.sqrt(F.nullif(F.count(x).over(w) - 1, F.lit(0))),
    "rank": _rank,
}


def weights(win_type: str, window: int, std: float | None = None, shape: float | None = None) -> list[float]:
    """Symmetric window weights by name: boxcar, triang, bartlett, hann, hamming, blackman, cosine, parzen; gaussian with
    ``std``; kaiser with its beta and exponential with its decay as ``shape``."""
    at = np.arange(window) - (window - 1) / 2
    if win_type in ("gaussian", "kaiser", "exponential"):
        number = std if win_type == "gaussian" and std is not None else shape
        if number is None:
            raise ValueError(f"{win_type} weights need {'std' if win_type == 'gaussian' else 'shape'}")
        if win_type == "gaussian":
            return np.exp(-0.5 * (at / number) ** 2).tolist()
        return (np.kaiser(window, number) if win_type == "kaiser" else np.exp(-np.abs(at) / number)).tolist()
    if win_type == "boxcar":
        return [1.0] * window
    if win_type == "triang":
        half = (window + 1) / 2 if window % 2 else window / 2
        return (1 - np.abs(at) / half).tolist()
    if win_type == "cosine":
        return np.sin(np.pi * (np.arange(window) + 0.5) / window).tolist()
    if win_type == "parzen":
        far = np.abs(at) / (window / 2)
        return np.where(np.abs(at) <= (window - 1) / 4, 1 - 6 * far**2 * (1 - far), 2 * (1 - far) ** 3).tolist()
    known = {"bartlett": np.bartlett, "hann": np.hanning, "hamming": np.hamming, "blackman": np.blackman}
    if win_type not in known:
        raise ValueError(f"unknown win_type {win_type!r}")
    return np.maximum(known[win_type](window), 0.0).tolist()


def _weighted(spec: RollingSpec, x: Column, by: WindowSpec) -> Column:
    """Weighted sum or mean; the last weight belongs to the last row of the frame."""
    first, _ = spec.reach
    terms = [(F.lag(x, -(first + i)).over(by), w)
             for i, w in enumerate(weights(spec.win_type, spec.window, spec.std, spec.shape))]
    total = sum((F.coalesce(v * w, F.lit(0.0)) for v, w in terms), F.lit(0.0))
    if spec.func == "sum":
        return total
    mass = sum((F.when(v.isNotNull(), F.lit(w)).otherwise(0.0) for v, w in terms), F.lit(0.0))
    return F.try_divide(total, mass)


def _finite(source: str) -> Column:
    """The source as doubles; NaN and infinities are missing."""
    x = F.col(f"`{source}`").cast("double")
    return F.when(F.abs(x) < float("inf"), x)


def _result(spec: RollingSpec, by: WindowSpec) -> Column:
    """The feature over its frame, without filter and shift."""
    x = _finite(spec.source)
    frame = by.rowsBetween(blocks.FROM_START, 0) if spec.window is None else by.rowsBetween(*spec.reach)
    held = F.count(F.lit(1) if spec.func == "count" else x).over(frame)
    if spec.win_type:
        value = _weighted(spec, x, by)
    elif spec.func is None:
        value = quantile_of(_sorted_frame(x, frame), spec.quantile)
    else:
        value = FUNCTIONS[spec.func](x, frame)
    return F.when(held >= spec.least, value)


def _features(df: DataFrame, specs: Sequence[RollingSpec], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """All specs over series that fit one task: one exchange and one sort serve them."""
    by = Window.partitionBy(*keys).orderBy(*order)
    sliding = sum(s.cost for s in specs) > WIDE
    wide = [s for s in specs if sliding and s.cost]
    narrow = [s for s in specs if s not in wide]
    if narrow:
        df = df.select("*", *[_result(s, by).alias(s.column) for s in narrow])
    if not wide:
        return df

    def compute(rows: pa.Table, starts: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
        sources = {s.source: kernels.numbers(rows, s.source) for s in wide}
        sets = {}
        for s in wide:
            first, last = (None, 0) if s.window is None else s.reach
            begin, end = kernels.frames(starts, ends, first, last)
            x = sources[s.source]
            if s.win_type:
                taps = weights(s.win_type, s.window, s.std, s.shape)
                yield kernels.slide_weighted(x, starts, ends, begin, end, last, taps, s.func, s.least)
            elif isinstance(s.func, Mergeable):
                yield s.func.results(kernels.doubled_frames(s.func.of_values(x), begin, end, s.func.join), s.least)
            elif s.func in kernels.MERGED and s.window is not None:
                frame = s.source, first, last
                if frame not in sets:
                    moments = max(_MOMENT.get(o.func, 0) for o in wide if o.window is not None and (o.source, *o.reach) == frame)
                    sets[frame] = kernels.merged_frames(x, starts, ends, begin, end, last - first + 1, moments)
                yield kernels.result_of(s.func, sets[frame], s.least)
            else:
                yield kernels.slide(x, begin, end, s.func, s.quantile, s.least)

    fields = [T.StructField(s.column, T.DoubleType()) for s in wide]
    return kernels.over_whole_series(df, keys, order, fields, compute)


def _bounded(df: DataFrame, specs: Sequence[RollingSpec], ids: list[str], order: Sequence[str],
             max_rows: int, found: blocks.LongSeries | None) -> DataFrame:
    """Bounded frames of long series: all specs share the pieces and their halo."""
    back = max(0, *(-s.reach[0] for s in specs))
    ahead = max(0, *(s.reach[1] for s in specs))

    return blocks.over_series(df, ids, order, back, ahead,
                              lambda rows, keys: _features(rows, specs, keys, order), max_rows, found)


def _ordered(df: DataFrame, specs: Sequence[RollingSpec], ids: list[str], order: Sequence[str], max_rows: int,
             found: blocks.LongSeries | None) -> DataFrame:
    """Expanding quantiles and ranks: long series over blocks, the others whole."""
    found = blocks.long_series(df, ids, order, max_rows) if found is None else found
    if not found:
        return _features(df, specs, ids, order)
    out = _features(blocks.others(df, ids, found), specs, ids, order)
    rows = blocks.only(df, ids, found)
    for source in dict.fromkeys(s.source for s in specs):
        mine = [s for s in specs if s.source == source]
        quantiles = {s.column: (0.5 if s.func == "median" else s.quantile, s.least) for s in mine if s.func != "rank"}
        ranks = {s.column: s.least for s in mine if s.func == "rank"}
        rows = growing.expanding_order(rows, _finite(source), quantiles, ranks, ids, order, max_rows, found)
    return out.unionByName(rows)


def _custom(df: DataFrame, specs: Sequence[RollingSpec], ids: list[str], order: Sequence[str], max_rows: int,
            found: blocks.LongSeries | None) -> DataFrame:
    """Expanding custom functions, block by block where a series is long."""
    found = blocks.long_series(df, ids, order, max_rows) if found is None else found
    if not found:
        return _features(df, specs, ids, order)
    for source in dict.fromkeys(s.source for s in specs):
        wanted = {s.column: (s.func, s.least) for s in specs if s.source == source}
        df = mergeable.expanding(df, _finite(source), wanted, ids, order, max_rows, found)
    return df


# Highest central moment a function of an expanding frame needs.
_MOMENT = {"std": 2, "var": 2, "sem": 2, "skew": 3, "kurt": 4}


def _growing(df: DataFrame, specs: Sequence[RollingSpec], ids: list[str], order: Sequence[str],
             max_rows: int, found: blocks.LongSeries | None) -> DataFrame:
    """Expanding frames of long series, from running totals over blocks; quantiles and ranks by ``growing``, custom
    functions by ``mergeable``."""
    custom = [s for s in specs if isinstance(s.func, Mergeable)]
    if custom:
        df = _custom(df, custom, ids, order, max_rows, found)
        specs = [s for s in specs if s not in custom]
        if not specs:
            return df
    ordered = [s for s in specs if s.func in HOLISTIC]
    if ordered:
        df = _ordered(df, ordered, ids, order, max_rows, found)
        specs = [s for s in specs if s not in ordered]
        if not specs:
            return df
    made = list(df.columns)
    moments = {s.source: 0 for s in specs}
    for spec in specs:
        moments[spec.source] = max(moments[spec.source], _MOMENT.get(spec.func, 0))
    totals = {"__rows": ("sum", F.lit(1))}
    centred = [x for x, p in moments.items() if p]
    if centred:
        # Powers of the distance to the mean of the series: the shift keeps the sums well conditioned.
        centre = reliable(df.groupBy(*ids).agg(
            *[F.avg(_finite(x)).alias(f"__centre_{x}") for x in centred]))
        df = blocks.lookup(df, blocks.hinted(centre, centre.count()), ids, "left")
    for source, highest in moments.items():
        x = _finite(source)
        totals[f"__held_{source}"] = ("sum", F.when(x.isNotNull(), 1).otherwise(0))
        for kind in ("sum", "min", "max"):
            totals[f"__{kind}_{source}"] = (kind, x)
        for p in range(1, highest + 1):
            totals[f"__{p}_{source}"] = ("sum", F.pow(x - F.col(f"`__centre_{source}`"), p))
    df = blocks.run_totals(df, ids, order, totals, max_rows=max_rows, found=found)

    def value(spec: RollingSpec) -> Column:
        n = F.col(f"`__held_{spec.source}`")
        s = {p: F.try_divide(F.col(f"`__{p}_{spec.source}`"), n) for p in range(1, moments[spec.source] + 1)}
        if spec.func in ("sum", "min", "max"):
            result = F.col(f"`__{spec.func}_{spec.source}`")
        elif spec.func == "mean":
            result = F.try_divide(F.col(f"`__sum_{spec.source}`"), n)
        elif spec.func == "count":
            result = n.cast("double")
        else:
            m2 = F.greatest(s[2] - s[1] ** 2, F.lit(0.0))
            variance = F.when(n > 1, F.try_divide(m2 * n, n - 1))
            if spec.func == "var":
                result = variance
            elif spec.func == "std":
                result = F.sqrt(variance)
            elif spec.func == "sem":
                result = F.sqrt(variance) / F.sqrt(F.nullif(n - 1, F.lit(0)))
            elif spec.func == "skew":
                m3 = s[3] - 3 * s[1] * s[2] + 2 * s[1] ** 3
                result = skewness(n, F.try_divide(m3, F.pow(m2, 1.5)), m2)
            else:
                m4 = s[4] - 4 * s[1] * s[3] + 6 * s[1] ** 2 * s[2] - 3 * s[1] ** 4
                result = kurtosis(n, F.try_divide(m4, m2 ** 2) - 3, m2)
        held = F.col("__rows") if spec.func == "count" else n
        return F.when(held >= spec.least, result).alias(spec.column)

    return df.select(*[F.col(f"`{c}`") for c in made], *[value(s) for s in specs])


def _by_filter(specs: Sequence[RollingSpec]) -> dict[tuple, list[RollingSpec]]:
    groups: dict[tuple, list[RollingSpec]] = {}
    for spec in specs:
        groups.setdefault((spec.filter_column, spec.filter_value), []).append(spec)
    return groups


def _apply(df: DataFrame, specs: Sequence[RollingSpec], ids: list[str],
           features: Callable[[DataFrame, list[RollingSpec], list[str]], DataFrame]) -> DataFrame:
    """Add the features filter by filter.  Rows that match a filter form a series of their own."""
    for (column, wanted), group in _by_filter(specs).items():
        if column is None:
            df = features(df, group, ids)
            continue
        kept = df.columns
        matching = F.coalesce(F.col(f"`{column}`") == F.lit(wanted), F.lit(False))
        df = features(df.withColumn("__match", matching), group, [*ids, "__match"])
        df = df.select(*[F.col(f"`{c}`") for c in kept],
                       *[F.when(F.col("__match"), F.col(f"`{s.column}`")).alias(s.column) for s in group])
    return df


def rolling(df: DataFrame, specs: Sequence[RollingSpec], ids: Sequence[str] = ("id",),
            order: Sequence[str] = ("time",), max_rows: int = blocks.MAX_ROWS,
            found: blocks.LongSeries | None = None, keep: Sequence[str] | None = None) -> DataFrame:
    """Add one column per spec.  ``order`` must be a total order within a series.  ``found`` passes on a
    check of the same series.  ``keep`` names the other columns of the result, all by default: wide frames run in
    Python, which Spark cannot prune, so what is not kept neither goes there nor is read."""
    ids, order = list(ids), list(order)
    for spec in specs:
        for column in (spec.source, spec.filter_column):
            if column is not None and column not in df.columns:
                raise KeyError(column)
    shifts = {s.column: s.shift for s in specs if s.shift}
    if keep is not None:
        named = dict.fromkeys([*ids, *order, *keep])
        needed = dict.fromkeys([*named, *(s.source for s in specs), *(s.filter_column for s in specs if s.filter_column)])
        out = rolling(df.select(*[F.col(f"`{c}`") for c in needed]), specs, ids, order, max_rows, found)
        return out.select(*[F.col(f"`{c}`") for c in [*named, *(s.column for s in specs)]])

    def in_one(rows: DataFrame, group: list[RollingSpec], keys: list[str]) -> DataFrame:
        return _features(rows, group, keys, order)

    found = blocks.long_series(df, ids, order, max_rows) if found is None else found

    def in_pieces(rows: DataFrame, group: list[RollingSpec], keys: list[str]) -> DataFrame:
        known = found if keys == ids else None
        bounded = [s for s in group if s.window is not None]
        if bounded:
            rows = _bounded(rows, bounded, keys, order, max_rows, known)
        growing = [s for s in group if s.window is None]
        return _growing(rows, growing, keys, order, max_rows, known) if growing else rows

    if not found:
        if len(_by_filter(specs)) + bool(shifts) > 1:
            df = df.repartition(*ids)  # one exchange serves every window below
        df = _apply(df, specs, ids, in_one)
        return _lagged(df, shifts, ids, order) if shifts else df
    df = _apply(df, specs, ids, in_pieces)
    return shift(df, shifts, ids, order, max_rows, found) if shifts else df


def _lagged(rows: DataFrame, columns: dict[str, int], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    by = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumns({c: F.lag(F.col(f"`{c}`"), n).over(by) for c, n in columns.items()})


def shift(df: DataFrame, columns: dict[str, int], ids: Sequence[str] = ("id",),
          order: Sequence[str] = ("time",), max_rows: int = blocks.MAX_ROWS,
          found: blocks.LongSeries | None = None) -> DataFrame:
    """Replace each column by its value ``n`` rows earlier (later if negative) in the series."""
    back, ahead = max(0, *columns.values()), max(0, *(-n for n in columns.values()))
    return blocks.over_series(df, ids, order, back, ahead,
                              lambda rows, keys: _lagged(rows, columns, keys, order), max_rows, found)


def diff(df: DataFrame, column: str, name: str, ids: Sequence[str] = ("id",),
         order: Sequence[str] = ("time",), max_rows: int = blocks.MAX_ROWS) -> DataFrame:
    """Add the difference to the previous row of the series."""
    def add(rows: DataFrame, keys: list[str]) -> DataFrame:
        by = Window.partitionBy(*keys).orderBy(*order)
        x = F.col(f"`{column}`")
        return rows.withColumn(name, x - F.lag(x, 1).over(by))

    return blocks.over_series(df, ids, order, 1, 0, add, max_rows)
