"""Whole series handed to numpy or pandas, many per Arrow batch.

Spark does the exchange and the sort, as for a window; a task then streams through its sorted rows and
computes on all series that are complete in a batch.  Used where a window would redo its frame for every
row: wide frames, and quantiles and ranks, which a pandas kernel slides in logarithmic time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pandas.api.indexers import BaseIndexer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# (rows, first row of each series, row after its last) -> new columns
Compute = Callable[[pa.Table, np.ndarray, np.ndarray], Sequence[np.ndarray]]


def over_whole_series(df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[T.StructField],
                      compute: Compute) -> DataFrame:
    """Add the columns that ``compute`` makes of complete series in their order."""
    numbered = df.withColumn("__row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = df.columns

    def finish(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches)
        if not rows.num_rows:
            return
        starts = np.flatnonzero(rows["__row"].to_numpy() == 1)
        made = compute(rows, starts, np.append(starts[1:], rows.num_rows))
        rows = rows.select(kept)
        for field, values in zip(fields, made):
            kind = pa.float32() if isinstance(field.dataType, T.FloatType) else pa.float64()
            rows = rows.append_column(field.name, pa.array(values, kind, from_pandas=True))
        yield from rows.to_batches()

    return numbered.mapInArrow(_whole(finish), T.StructType([*df.schema.fields, *fields]))


def _whole(finish: Callable[[list[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """Hand on sorted rows numbered by __row as soon as a batch completes their group."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_groups: list[pa.RecordBatch] = []
        for batch in batches:
            starts = np.flatnonzero(batch["__row"].to_numpy() == 1)
            if len(starts):
                yield from finish([*open_groups, batch.slice(0, starts[-1])])
                open_groups, batch = [], batch.slice(starts[-1])
            open_groups.append(batch)
        if open_groups:
            yield from finish(open_groups)

    return run


# (columns, first row of each group, row after its last) -> rows made of each group, new columns
Make = Callable[[dict[str, np.ndarray], np.ndarray, np.ndarray], tuple[Sequence[int], Sequence[np.ndarray]]]


def over_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str], kept: Sequence[str], fields: Sequence[T.StructField],
                make: Make) -> DataFrame:
    """New rows of complete groups, many groups per Arrow batch, so that small ones do not each cost a call of Python.

    ``kept`` are columns that are the same throughout a group and stand in its new rows, before ``fields``.  ``make`` gets
    the others; integers with NULL come as floats.
    """
    numbered = df.withColumn("__row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    used = [c for c in df.columns if not isinstance(df.schema[c].dataType, (T.StringType, T.BinaryType))]
    kinds = {T.LongType: pa.int64(), T.DoubleType: pa.float64()}

    def finish(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(batches)
        if not rows.num_rows:
            return
        starts = np.flatnonzero(rows["__row"].to_numpy() == 1)
        counts, made = make({c: rows[c].to_numpy() for c in used}, starts, np.append(starts[1:], rows.num_rows))
        out = rows.select(list(kept)).take(pa.array(np.repeat(starts, counts)))
        for field, values in zip(fields, made):
            out = out.append_column(field.name, pa.array(np.asarray(values), kinds[type(field.dataType)]))
        yield from out.to_batches()

    return numbered.mapInArrow(_whole(finish), T.StructType([*[df.schema[c] for c in kept], *fields]))


def one_by_one(make: Callable[[dict[str, np.ndarray]], Sequence[np.ndarray]], fields: Sequence[T.StructField]) -> Make:
    """A function of the columns of one group, for all groups of a batch."""
    kinds = {T.LongType: "int64", T.DoubleType: "float64"}

    def run(columns: dict[str, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
        parts = [make({c: v[a:b] for c, v in columns.items()}) for a, b in zip(starts.tolist(), ends.tolist())]
        made = [np.concatenate([np.asarray(p[i]).astype(kinds[type(f.dataType)]) for p in parts]) for i, f in enumerate(fields)]
        return [len(p[0]) for p in parts], made

    return run


def numbers(rows: pa.Table, column: str) -> np.ndarray:
    """A column as doubles, missing and infinite values as NaN."""
    x = rows[column].to_numpy().astype("float64")
    return np.where(np.isfinite(x), x, np.nan)


# What frames can be merged from: count, sum, mean and central moments, least and greatest value.
MERGED = ("sum", "mean", "min", "max", "std", "var", "sem", "skew", "kurt")


def _merge(a: dict[str, np.ndarray], b: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """What two sets of values give together: moments about the common mean, without subtracting totals."""
    n = a["n"] + b["n"]
    some = np.maximum(n, 1)
    out = {"n": n, "sum": a["sum"] + b["sum"], "min": np.fmin(a["min"], b["min"]), "max": np.fmax(a["max"], b["max"])}
    if "mean" in a:
        d = np.where((a["n"] > 0) & (b["n"] > 0), b["mean"] - a["mean"], 0.0)
        share = b["n"] / some
        out["mean"] = np.where(a["n"] > 0, a["mean"] + d * share, b["mean"])
        out["m2"] = a["m2"] + b["m2"] + d * d * a["n"] * share
        if "m3" in a:
            out["m3"] = (a["m3"] + b["m3"] + d**3 * a["n"] * share * (a["n"] - b["n"]) / some
                         + 3 * d * (a["n"] * b["m2"] - b["n"] * a["m2"]) / some)
        if "m4" in a:
            na, nb = a["n"], b["n"]
            out["m4"] = (a["m4"] + b["m4"] + d**4 * na * share * (na * na - na * nb + nb * nb) / (some * some)
                         + 6 * d * d * (na * na * b["m2"] + nb * nb * a["m2"]) / (some * some)
                         + 4 * d * (na * b["m3"] - nb * a["m3"]) / some)
    return out


def _single(x: np.ndarray, moments: int) -> dict[str, np.ndarray]:
    """Sets of one value, or of none where it is missing."""
    known = ~np.isnan(x)
    out = {"n": known.astype("float64"), "sum": np.where(known, x, 0.0), "min": x, "max": x}
    if moments >= 2:
        out["mean"] = out["sum"]
        out |= {f"m{p}": np.zeros(len(x)) for p in range(2, moments + 1)}
    return out


def merged_frames(x: np.ndarray, starts: np.ndarray, ends: np.ndarray, begin: np.ndarray, end: np.ndarray, width: int,
                  moments: int) -> dict[str, np.ndarray]:
    """Count, sum, extremes and moments of every frame of at most ``width`` rows.

    Each series is cut into chunks of ``width`` rows.  Inside a chunk sets grow row by row, from its start and from its
    end, for all chunks of all series at once.  A frame is the end of one chunk and the start of the next, so nothing
    is ever taken away again and nothing outside the frame plays a part.  Very wide frames go by ``doubled_frames``.
    """
    if width > DOUBLING:
        with np.errstate(invalid="ignore", over="ignore"):
            out = doubled_frames(_single(x, moments), begin, end, _merge)
        return out
    first = np.concatenate([np.arange(a, b, width) for a, b in zip(starts, ends)]).astype("int64")
    last = np.minimum(first + width, np.repeat(ends, -(-(ends - starts) // width)))
    chunk = np.repeat(np.arange(len(first)), last - first)
    ones = _single(x, moments)
    ahead, behind = ({k: v.copy() for k, v in ones.items()} for _ in range(2))
    for step in range(1, int((last - first).max(initial=1))):
        for store, at, by in ((ahead, first + step, -1), (behind, last - 1 - step, 1)):
            at = at[(first + step) < last]
            both = _merge({k: v[at + by] for k, v in store.items()}, {k: v[at] for k, v in ones.items()})
            for k, v in both.items():
                store[k][at] = v
    held = end > begin
    lo, hi = np.where(held, begin, 0), np.where(held, end - 1, 0)
    whole = _merge({k: v[lo] for k, v in behind.items()}, {k: v[hi] for k, v in ahead.items()})
    same = chunk[lo] == chunk[hi]
    from_start = same & (lo == first[chunk[lo]])
    out = {k: np.where(from_start, ahead[k][hi], np.where(same, behind[k][lo], v)) for k, v in whole.items()}
    out["n"] = np.where(held, out["n"], 0.0)
    return out


#: Width of a frame above which sets of doubling size take over from growing ones; measured.
DOUBLING = 2_000


def doubled_frames(ones: dict[str, np.ndarray], begin: np.ndarray, end: np.ndarray,
                   merge: Callable[[dict, dict], dict]) -> dict[str, np.ndarray]:
    """States of frames ``begin`` to before ``end`` from those of single rows, zeros for empty frames.

    Sets of 1, 2, 4, ... rows from each row on are merged from two of half the size; a frame is put together from its
    start on, from the sets that the binary digits of its length name.  So the work per row grows with the logarithm
    of the widest frame, and each value enters a frame once, in order.
    """
    length = np.asarray(end) - np.asarray(begin)
    out = {k: np.zeros(len(length)) for k in ones}
    at, started = np.asarray(begin).copy(), np.zeros(len(length), bool)
    sets, size, n = ones, 1, len(next(iter(ones.values())))
    while size <= length.max(initial=0):
        rows = np.flatnonzero(length & size)
        if len(rows):
            part = {k: v[at[rows]] for k, v in sets.items()}
            both = merge({k: v[rows] for k, v in out.items()}, part)
            for k, v in out.items():
                v[rows] = np.where(started[rows], both[k], part[k])
            started[rows] = True
            at[rows] += size
        size *= 2
        if size <= length.max(initial=0):
            # Sets that reach beyond the last row are wrong and belong to no frame.
            there = np.minimum(np.arange(n) + size // 2, n - 1)
            sets = merge(sets, {k: v[there] for k, v in sets.items()})
    return out


def result_of(func: str, sets: dict[str, np.ndarray], least: int) -> np.ndarray:
    """A function of ``MERGED`` from the sets of the frames that hold ``least`` values."""
    n = sets["n"]
    with np.errstate(invalid="ignore", divide="ignore"):
        if func in ("sum", "min", "max"):
            value = sets[func]
        elif func == "mean":
            value = sets["sum"] / n
        else:
            variance = np.where(n > 1, sets["m2"] / (n - 1), np.nan)
            if func == "var":
                value = variance
            elif func == "std":
                value = np.sqrt(variance)
            elif func == "sem":
                value = np.where(n > 1, np.sqrt(variance) / np.sqrt(n - 1), np.nan)
            elif func == "skew":
                g1 = np.sqrt(n) * sets["m3"] / sets["m2"] ** 1.5
                value = np.where(n >= 3, np.where(sets["m2"] == 0, 0.0, g1 * np.sqrt(n * (n - 1)) / (n - 2)), np.nan)
            else:
                g2 = n * sets["m4"] / sets["m2"] ** 2 - 3
                value = np.where(n >= 4, np.where(sets["m2"] == 0, -3.0, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6)), np.nan)
    return np.where(n >= max(1, least), value, np.nan)


class _Frames(BaseIndexer):
    """Frames given row by row."""

    def get_window_bounds(self, num_values=0, min_periods=None, center=None, closed=None, step=None):
        return self.begin, self.end


def frames(starts: np.ndarray, ends: np.ndarray, first: int | None, last: int) -> tuple[np.ndarray, np.ndarray]:
    """First row and row after the last of each frame, inside its series; ``first`` None is the series start."""
    sizes = ends - starts
    low, high = np.repeat(starts, sizes), np.repeat(ends, sizes)
    at = np.arange(len(low))
    begin = low if first is None else np.clip(at + first, low, high)
    return begin.astype("int64"), np.maximum(begin, np.clip(at + last + 1, low, high)).astype("int64")


def slide(x: np.ndarray, begin: np.ndarray, end: np.ndarray, func: str | Callable | None, q: float | None,
          least: int) -> np.ndarray:
    """A median, rank, quantile or custom function of each frame that holds ``least`` values; rows, for count.

    These only compare values, or see one frame alone: a custom function gets it with its missing values.
    """
    if func == "count":
        held = np.concatenate([[0], np.cumsum(~np.isnan(x))])
        return np.where(end - begin >= least, (held[end] - held[begin]).astype("float64"), np.nan)
    frame = pd.Series(x).rolling(_Frames(begin=begin, end=end), min_periods=max(1, least))
    if func is None:
        return frame.quantile(q).to_numpy()
    return (frame.apply(func, raw=False) if callable(func) else getattr(frame, func)()).to_numpy()


def slide_rank(x: np.ndarray, begin: np.ndarray, end: np.ndarray, method: str) -> np.ndarray:
    """The rank of the last value of each frame in it, the least or the greatest among ties."""
    return pd.Series(x).rolling(_Frames(begin=begin, end=end), min_periods=1).rank(method).to_numpy()


#: Values and weights above which a convolution goes by transforms of blocks.
DIRECT = 128


def convolved(x: np.ndarray, taps: np.ndarray) -> np.ndarray:
    """The full convolution.  Long ones go by overlap-save: blocks of the values, each with as many of the values before
    it as there are weights, are transformed on their own, so the time per value grows with the logarithm of the weights."""
    if min(len(x), len(taps)) <= DIRECT:
        return np.convolve(x, taps)
    reach = len(taps) - 1
    size = 1 << (4 * len(taps) - 1).bit_length()
    step = size - reach
    total = len(x) + reach
    spectrum = np.fft.rfft(taps, size)
    padded = np.concatenate([np.zeros(reach), x, np.zeros(size + reach)])
    out = np.empty(-(-total // step) * step)
    for lo in range(0, total, step):
        block = padded[lo:lo + size]
        out[lo:lo + step] = np.fft.irfft(np.fft.rfft(block, size) * spectrum, size)[reach:]
    return out[:total]


def slide_weighted(x: np.ndarray, starts: np.ndarray, ends: np.ndarray, begin: np.ndarray, end: np.ndarray, ahead: int,
                   weights: Sequence[float], func: str, least: int) -> np.ndarray:
    """Weighted sum, mean, var or std of frames whose last weight belongs to the row ``ahead`` of the current one.

    Convolutions of the values, of their squares and of what is known give them for all rows of a series.  Values are
    centred on the mean of their series first, so that squares do not drown the spread.
    """
    taps = np.asarray(weights, "float64")[::-1]  # the last weight meets the row at hand
    total, mass, square = (np.zeros(len(x)) for _ in range(3))
    known = ~np.isnan(x)
    for a, b in zip(starts, ends):
        here = known[a:b]
        centre = x[a:b][here].mean() if here.any() else 0.0
        d = np.where(here, x[a:b] - centre, 0.0)
        take = lambda values, n=b - a: convolved(values, taps)[ahead:ahead + n]
        mass[a:b] = take(here.astype("float64"))
        moved = take(d)
        total[a:b] = moved + centre * mass[a:b]
        if func in ("var", "std"):
            some = np.where(mass[a:b] > 0, mass[a:b], 1.0)
            whole = take(d * d)
            rest = whole - moved * moved / some
            square[a:b] = np.where(rest > 1e-12 * whole, rest, 0.0)  # below that it is rounding
    held = np.concatenate([[0], np.cumsum(known)])
    held = held[end] - held[begin]
    with np.errstate(invalid="ignore", divide="ignore"):
        weighed = np.abs(mass) > 1e-12 * np.abs(taps).sum()
        value = total if func == "sum" else np.where(weighed, total / mass, np.nan)
        if func in ("var", "std"):
            n = len(taps)
            value = np.where(held > 1, square * n / ((n - 1) * mass) if n > 1 else np.nan, 0.0)
            value = np.where(weighed, np.sqrt(value) if func == "std" else value, np.nan)
    return np.where(held >= least, value, np.nan)
