"""Denoising of whole series: low-pass by Fourier transform, hard threshold of wavelet coefficients.

Short series are transformed whole, many per task.  A series above ``max_rows`` is spread:

* the low-pass is a circular convolution with a known kernel, done with a transform of length
  columns x rows, so that every task transforms one row or one column of that matrix;
* the wavelet transform goes level by level over blocks with a halo, until what is left is short.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.operators import blocks, kernels
from seriesmill.operators.lookups import union_rows
from seriesmill.operators.wavelets import Wavelet, wavelet as bank_of
from seriesmill.storage import kept as written, reliable

# Sample spacing, default threshold, and the factor from mean absolute deviation to sigma.
SPACING = 1e-5
DEFAULT_THRESHOLD = 1e8
DEVIATION_FACTOR = 0.6745
DEFAULT_WAVELET = "db4"


# ---------------------------------------------------------------- one series in one task

def kept_bins(n: int, threshold: float) -> int:
    """Highest frequency bin that is not above the threshold, at most n // 2."""
    frequencies_per_bin = 1.0 / (n * SPACING)
    k = min(n // 2, max(0, math.floor(threshold / frequencies_per_bin)))
    while k < n // 2 and (k + 1) * frequencies_per_bin <= threshold:
        k += 1
    while k > 0 and k * frequencies_per_bin > threshold:
        k -= 1
    return k


def low_pass(x: np.ndarray, threshold: float) -> np.ndarray:
    bins = np.fft.rfft(x)
    bins[kept_bins(len(x), threshold) + 1:] = 0
    return np.fft.irfft(bins, n=len(x))


def analyse(x: np.ndarray, bank: Wavelet) -> tuple[np.ndarray, np.ndarray]:
    """One level of the periodic transform; an odd series repeats its last sample."""
    if len(x) % 2:
        x = np.append(x, x[-1])
    at = (2 * np.arange(len(x) // 2)[:, None] + np.arange(bank.taps)) % len(x)
    return x[at] @ bank.low, x[at] @ bank.high


def interleave(approx: np.ndarray, detail: np.ndarray, bank: Wavelet) -> np.ndarray:
    """Samples of the coefficients after the first ones of the halo, which only reach into them."""
    count = len(approx) - bank.halo
    x = np.zeros(2 * count)
    for k in range(bank.taps):
        at = slice(bank.halo - k // 2, bank.halo - k // 2 + count)
        x[k % 2::2] += bank.low[k] * approx[at] + bank.high[k] * detail[at]
    return x


def synthesise(approx: np.ndarray, detail: np.ndarray, n: int, bank: Wavelet) -> np.ndarray:
    """Undo ``analyse`` for a series of n samples."""
    around = np.arange(-bank.halo, len(approx)) % len(approx)
    return interleave(approx[around], detail[around], bank)[:n]


def depth(n: int, bank: Wavelet) -> int:
    """Levels of the full transform of n samples."""
    return max(0, (n // (bank.taps - 1)).bit_length() - 1)


def limit_of(deviation: float, n: int) -> float:
    """Universal threshold from the mean absolute deviation of a detail level."""
    return deviation / DEVIATION_FACTOR * math.sqrt(2 * math.log(n))


def hard_threshold(x: np.ndarray, levels: int, limit: float | Callable[[list[np.ndarray]], float],
                   bank: Wavelet) -> np.ndarray:
    """Transform ``levels`` deep, zero the details below the limit, transform back."""
    approx, details, lengths = x, [], []
    for _ in range(levels):
        lengths.append(len(approx))
        approx, detail = analyse(approx, bank)
        details.append(detail)
    if callable(limit):
        limit = limit(details)
    for n, detail in zip(reversed(lengths), reversed(details)):
        approx = synthesise(approx, np.where(np.abs(detail) < limit, 0.0, detail), n, bank)
    return approx


def wavelet_array(x: np.ndarray, level: int = 1, wavelet: str = DEFAULT_WAVELET) -> np.ndarray:
    bank = bank_of(wavelet)
    levels = depth(len(x), bank)
    if not levels:
        return x
    if level > levels:
        raise ValueError(f"a series has fewer than {level} levels")

    def universal(details: list[np.ndarray]) -> float:
        d = details[level - 1]
        return limit_of(float(np.mean(np.abs(d - np.mean(d)))), len(x))

    return hard_threshold(x, levels, universal, bank)


def _per_series(df: DataFrame, column: str, name: str, ids: Sequence[str], order: Sequence[str],
                fn: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    def compute(rows: pa.Table, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        x = rows[column].to_numpy().astype("float64")
        return [np.concatenate([fn(x[a:b]) for a, b in zip(starts, ends)]).astype("float32")]

    return kernels.over_whole_series(df, ids, order, [T.StructField(name, T.FloatType())], compute)


# ---------------------------------------------------------------- one series over many tasks

def _indexed(df: DataFrame, column: str, ids: Sequence[str], order: Sequence[str], found: blocks.LongSeries,
             max_rows: int) -> DataFrame:
    """Rows of the long series with __pos, __n and __x, kept so that positions stay as they are."""
    rows = blocks.only(df, ids, found)
    rows = blocks.number_rows(rows, ids, order, "__pos", max_rows, found)
    sizes = blocks.hinted(found.table.select(*ids, F.col("__n").cast("long").alias("__n")), found.n_series)
    rows = blocks.lookup(rows, sizes, ids, "left")
    return written(rows.withColumn("__x", F.col(f"`{column}`").cast("double")))


def _filled(df: DataFrame, column: str) -> DataFrame:
    """Rows whose column raises an error where it has no finite value: one such sample would spoil its whole series."""
    x = F.col(f"`{column}`")
    known = x.isNotNull() & (F.abs(x.cast("double")) < float("inf"))
    return df.withColumn(column, F.when(known, x).otherwise(
        F.raise_error(F.lit(f"{column} has missing or infinite samples; fill them first"))))


def _shape(n: int) -> tuple[int, int]:
    """Rows and columns of a transform that holds the linear convolution of n samples."""
    bits = math.ceil(math.log2(2 * n - 1))
    return 2 ** (bits // 2), 2 ** (bits - bits // 2)


def _turns(a: np.ndarray, b: int, m: int) -> np.ndarray:
    """exp(-2 pi i a b / m) for a b below m, so that the product is exact."""
    return np.exp(-2j * np.pi * (a * b) / m)


def _kernel(d: np.ndarray, n: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """Circular kernel that keeps the bins 0 .. bins of n samples, at the offsets d; one row per series."""
    # The product is reduced to one turn before it is rounded; beyond 2 ** 31 samples it needs wide integers.
    exact = d.astype(object) if n.max() > 2**31 else d
    wide = ((2 * bins + 1) * exact % (2 * n)).astype("float64")
    with np.errstate(invalid="ignore", divide="ignore"):
        value = np.sin(np.pi * wide / n) / (n * np.sin(np.pi * d / n))
    return np.where(d % n == 0, (2 * bins + 1) / n, value)


def _low_pass_long(rows: DataFrame, ids: list[str], threshold: float) -> DataFrame:
    """(ids, __pos, __y): three exchanges, every group about sqrt(2 n) values."""
    def by_shape(n: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple]:
        """Groups of series with transforms of one shape: their numbers, rows, places among the groups, and the shape."""
        sizes = np.unique(n[starts])
        shapes = np.array([_shape(int(size)) for size in sizes])[np.searchsorted(sizes, n[starts])]
        lengths = ends - starts
        for shape in np.unique(shapes, axis=0):
            of = np.flatnonzero((shapes == shape).all(axis=1))
            at = np.repeat(starts[of] - np.cumsum(lengths[of]) + lengths[of], lengths[of]) + np.arange(lengths[of].sum())
            yield of, at, np.repeat(np.arange(len(of)), lengths[of]), int(shape[0]), int(shape[1])

    def joined(groups: int, parts: list[tuple]) -> tuple[np.ndarray, list[np.ndarray]]:
        """New rows of each group, from matrices with one row per group."""
        counts = np.zeros(groups, np.int64)
        for of, made in parts:
            counts[of] = made[0].shape[1]
        first, out = np.cumsum(counts) - counts, [np.empty(counts.sum(), m.dtype) for m in parts[0][1]]
        for of, made in parts:
            at = first[of][:, None] + np.arange(made[0].shape[1])
            for column, values in zip(out, made):
                column[at] = values
        return counts, out

    def down(columns: dict[str, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> tuple:
        parts = []
        for of, at, group, height, width in by_shape(columns["__n"], starts, ends):
            m = height * width
            n, j = columns["__n"][starts[of]][:, None], columns["__j"][starts[of]][:, None]
            x = np.zeros((len(of), height))
            x[group, columns["__pos"][at] // width] = columns["__x"][at]
            sizes = np.unique(n)
            bins = np.array([kept_bins(int(size), threshold) for size in sizes])[np.searchsorted(sizes, n)]
            place = np.arange(height, dtype="int64") * width + j
            offset = np.where(place < n, place, place - m)
            g = np.where(np.abs(offset) < n, _kernel(offset, n, bins), 0.0)
            turn = _turns(np.arange(height), j, m)
            fx, fg = np.fft.fft(x) * turn, np.fft.fft(g) * turn
            i = np.broadcast_to(np.arange(height), x.shape)
            parts.append((of, [i, np.broadcast_to(j, x.shape), fx.real, fx.imag, fg.real, fg.imag]))
        return joined(len(starts), parts)

    def across(columns: dict[str, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> tuple:
        parts = []
        for of, at, group, height, width in by_shape(columns["__n"], starts, ends):
            i = columns["__i"][starts[of]][:, None]
            x, g = np.zeros((len(of), width), dtype=complex), np.zeros((len(of), width), dtype=complex)
            x[group, columns["__j"][at]] = columns["__a"][at] + 1j * columns["__b"][at]
            g[group, columns["__j"][at]] = columns["__c"][at] + 1j * columns["__d"][at]
            y = np.fft.ifft(np.fft.fft(x) * np.fft.fft(g)) * np.conj(_turns(np.arange(width), i, height * width))
            parts.append((of, [np.broadcast_to(i, x.shape), np.broadcast_to(np.arange(width), x.shape), y.real, y.imag]))
        return joined(len(starts), parts)

    def up(columns: dict[str, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> tuple:
        parts = []
        for of, at, group, height, width in by_shape(columns["__n"], starts, ends):
            y = np.zeros((len(of), height), dtype=complex)
            y[group, columns["__i"][at]] = columns["__a"][at] + 1j * columns["__b"][at]
            place = np.arange(height, dtype="int64") * width + columns["__j"][starts[of]][:, None]
            parts.append((of, [place, np.fft.ifft(y).real]))
        counts, (place, y) = joined(len(starts), parts)
        inside = place < np.repeat(columns["__n"][starts], counts)
        return np.bincount(np.repeat(np.arange(len(starts)), counts)[inside], minlength=len(starts)), [place[inside], y[inside]]

    def fields(*names: str) -> list[T.StructField]:
        return [T.StructField(c, T.LongType() if c in ("__i", "__j", "__pos") else T.DoubleType()) for c in names]

    n = F.col("__n").cast("double")
    bits = F.ceil(F.log2(2 * n - 1))
    width = F.pow(F.lit(2.0), bits - F.floor(bits / 2)).cast("long")
    start = rows.select(*ids, "__n", "__pos", "__x", (F.col("__pos") % width).alias("__j"))
    group = [*ids, "__n"]
    first = kernels.over_groups(start, [*ids, "__j"], ["__pos"], group, fields("__i", "__j", "__a", "__b", "__c", "__d"), down)
    second = kernels.over_groups(first, [*ids, "__i"], ["__j"], group, fields("__i", "__j", "__a", "__b"), across)
    return kernels.over_groups(second, [*ids, "__j"], ["__i"], ids, fields("__pos", "__y"), up)


def fft_denoise(df: DataFrame, column: str, name: str | None = None, threshold: float = DEFAULT_THRESHOLD,
                ids: Sequence[str] = ("id",), order: Sequence[str] = ("time",),
                max_rows: int = blocks.MAX_ROWS, found: blocks.LongSeries | None = None) -> DataFrame:
    """Drop all frequencies above the threshold.  A missing or infinite sample is an error: fill them before."""
    ids, name = list(ids), name or f"{column}_fft"
    if threshold >= 1 / (2 * SPACING):
        # Nothing lies above the highest frequency a series can hold.
        return df.withColumn(name, F.col(f"`{column}`").cast("float"))
    df = _filled(df, column)
    found = blocks.long_series(df, ids, order, max_rows) if found is None else found
    short = blocks.others(df, ids, found) if found else df
    out = _per_series(short, column, name, ids, order, lambda x: low_pass(x, threshold))
    if not found:
        return out
    rows = _indexed(df, column, ids, order, found, max_rows)
    return out.unionByName(_filled_in(rows, _low_pass_long(rows, ids, threshold), ids, name))


def _filled_in(rows: DataFrame, values: DataFrame, ids: list[str], name: str) -> DataFrame:
    """Long rows with their new value, found by position."""
    values = values.select(*ids, "__pos", F.nullif("__y", F.lit(float("nan"))).cast("float").alias(name))
    return blocks.lookup(rows, values, [*ids, "__pos"], "left").drop("__pos", "__n", "__x")


def _blocked(rows: DataFrame, ids: list[str], size: int, before: int, after: int) -> DataFrame:
    """Spread (ids, __n, __pos, ...) over blocks of ``size`` positions of a circle of ``__n``, each with the
    rows just before and after it.  Adds __block and __at, the position as the block sees it."""
    n, pos = F.col("__n"), F.col("__pos")
    own, last = F.floor(pos / size), F.floor((n - 1) / size)

    def copy(block: Column, at: Column) -> Column:
        return F.struct(block.cast("long").alias("__block"), at.cast("long").alias("__at"))

    zero = F.lit(0)
    to_previous = (own > 0) & (pos - own * size < after)
    to_next = (own < last) & ((own + 1) * size - pos <= before)
    # Across the seam; a last block shorter than the halo lets it reach the block before, too.
    to_last, to_first = pos < after, pos >= n - before
    to_last_but_one = (last > 0) & (pos + n < last * size + after)
    copies = F.array_compact(F.array(
        copy(own, pos),
        F.when(to_previous, copy(own - 1, pos)), F.when(to_next, copy(own + 1, pos)),
        F.when(to_last, copy(last, pos + n)), F.when(to_last_but_one, copy(last - 1, pos + n)),
        F.when(to_first, copy(zero, pos - n)),
    ))
    shared = to_previous | to_next | to_last | to_last_but_one | to_first
    spread = rows.withColumn("__c", F.explode(F.when(shared, copies).otherwise(F.array(copy(own, pos)))))
    return spread.select(*rows.columns, "__c.__block", "__c.__at")


def _level_down(rows: DataFrame, ids: list[str], size: int, bank: Wavelet) -> DataFrame:
    """One analysis level of (ids, __n, __pos, __x): (ids, __n, __pos, __a, __d), __n halved and rounded up."""
    odd = (F.col("__n") % 2 == 1) & (F.col("__pos") == F.col("__n") - 1)
    places = F.when(odd, F.array(F.col("__pos"), F.col("__pos") + 1)).otherwise(F.array(F.col("__pos")))
    even = rows.withColumn("__pos", F.explode(places)).withColumn("__n", F.col("__n") + F.col("__n") % 2)
    spread = _blocked(even, ids, size, 0, bank.taps - 2)
    fields = [T.StructField("__n", T.LongType()), T.StructField("__pos", T.LongType()),
              T.StructField("__a", T.DoubleType()), T.StructField("__d", T.DoubleType())]

    def run(columns: dict[str, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> tuple:
        n, start, x = columns["__n"][starts], columns["__block"][starts] * size, columns["__x"]
        counts = (np.minimum(start + size, n) - start) // 2
        place = _within(counts)
        at = (np.repeat(starts, counts) + 2 * place)[:, None] + np.arange(bank.taps)
        return counts, [np.repeat(n // 2, counts), np.repeat(start // 2, counts) + place, x[at] @ bank.low, x[at] @ bank.high]

    return kernels.over_groups(spread, [*ids, "__block"], ["__at"], ids, fields, run)


def _within(counts: np.ndarray) -> np.ndarray:
    """Place of each row in its group, from 0."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _level_up(rows: DataFrame, ids: list[str], size: int, bank: Wavelet) -> DataFrame:
    """Undo ``_level_down`` for (ids, __n, __pos, __a, __d): (ids, __pos, __x), with the repeated sample."""
    spread = _blocked(rows, ids, size // 2, bank.halo, 0)
    fields = [T.StructField("__pos", T.LongType()), T.StructField("__x", T.DoubleType())]

    def run(columns: dict[str, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> tuple:
        # Halos lie between the blocks; they are computed, too, and left out.
        counts = ends - starts - bank.halo
        wide = np.repeat(starts + bank.halo, counts) + _within(counts)
        x = interleave(columns["__a"], columns["__d"], bank).reshape(-1, 2)[wide - bank.halo].ravel()
        place = np.repeat(columns["__block"][starts] * size, 2 * counts) + _within(2 * counts)
        return 2 * counts, [place, x]

    return kernels.over_groups(spread, [*ids, "__block"], ["__at"], ids, fields, run)


def _wavelet_long(rows: DataFrame, ids: list[str], level: int, max_rows: int, bank: Wavelet) -> DataFrame:
    """(ids, __pos, __y), denoised.

    Each level halves the rows.  A series goes down until one task can take its remaining levels at once.
    """
    size = max(max_rows + max_rows % 2, 4 * bank.taps)
    sizes = reliable(rows.select(*ids, F.col("__n").alias("__size")).distinct())
    n_series, longest = sizes.agg(F.count(F.lit(1)), F.max("__size")).first()

    def sized(df: DataFrame) -> DataFrame:
        return blocks.lookup(df, blocks.hinted(sizes, n_series), ids, "left")

    current, details, waiting = rows.select(*ids, "__n", "__pos", "__x"), [], []
    while longest > size:
        waiting.append(current.where(F.col("__n") <= size))
        details.append(written(_level_down(current.where(F.col("__n") > size), ids, size, bank)))
        current = details[-1].select(*ids, "__n", "__pos", F.col("__a").alias("__x"))
        longest = (longest + 1) // 2
    waiting.append(current)

    # The threshold of each series, from one of its detail levels.
    d = F.col("__d")
    deviations = []
    if level <= len(details):
        fine = details[level - 1]
        means = reliable(fine.groupBy(*ids).agg(F.avg(d).alias("__mean")))
        spread = blocks.lookup(fine, blocks.hinted(means, n_series), ids, "left")
        deviations.append(spread.groupBy(*ids).agg(F.avg(F.abs(d - F.col("__mean"))).alias("__dev")))
    dev_fields = [T.StructField("__dev", T.DoubleType())]

    def deviation_after(done: int) -> kernels.Make:
        def run(series: dict[str, np.ndarray]) -> list[np.ndarray]:
            x = series["__x"]
            if level > depth(int(series["__size"][0]), bank):
                raise ValueError(f"a series has fewer than {level} levels")
            for _ in range(level - done):
                x, fine = analyse(x, bank)
            return [np.array([np.mean(np.abs(fine - np.mean(fine)))])]
        return kernels.one_by_one(run, dev_fields)

    for done, approx in enumerate(waiting[:level]):
        deviations.append(kernels.over_groups(sized(approx), ids, ["__pos"], ids, dev_fields, deviation_after(done)))
    limits = reliable(sized(union_rows(*deviations)).select(*ids, "__size", (
        F.col("__dev") / DEVIATION_FACTOR * F.sqrt(2 * F.ln("__size"))).alias("__limit")))

    def limited(df: DataFrame) -> DataFrame:
        return blocks.lookup(df, blocks.hinted(limits, n_series), ids, "left")

    out_fields = [T.StructField("__pos", T.LongType()), T.StructField("__x", T.DoubleType())]

    def finish_after(done: int) -> kernels.Make:
        def run(series: dict[str, np.ndarray]) -> list[np.ndarray]:
            levels = depth(int(series["__size"][0]), bank) - done
            return [series["__pos"], hard_threshold(series["__x"], levels, float(series["__limit"][0]), bank)]
        return kernels.one_by_one(run, out_fields)

    finished = [kernels.over_groups(limited(approx), ids, ["__pos"], ids, out_fields, finish_after(done))
                for done, approx in enumerate(waiting)]
    smooth = finished.pop()
    for done in range(len(details) - 1, -1, -1):
        kept = limited(details[done]).select(
            *ids, "__n", "__pos", "__size", F.when(F.abs(d) >= F.col("__limit"), d).otherwise(
                F.when(d.isNotNull() & ~F.isnan(d), F.lit(0.0)).otherwise(d)).alias("__d"))
        pairs = blocks.lookup(kept, smooth, [*ids, "__pos"], "left").withColumnRenamed("__x", "__a")
        upper = sized(_level_up(pairs.drop("__size"), ids, size, bank))
        length = F.ceil(F.col("__size") / 2**done)
        smooth = upper.where(F.col("__pos") < length).select(*ids, "__pos", "__x").unionByName(finished[done])
    return smooth.withColumnRenamed("__x", "__y")


def wavelet_denoise(df: DataFrame, column: str, name: str | None = None, level: int = 1,
                    ids: Sequence[str] = ("id",), order: Sequence[str] = ("time",),
                    max_rows: int = blocks.MAX_ROWS, found: blocks.LongSeries | None = None,
                    wavelet: str = DEFAULT_WAVELET) -> DataFrame:
    """Hard-threshold all detail coefficients of a periodic transform by ``wavelet`` (haar, db1 to db10, sym2 to sym8).

    ``level`` picks the detail (1 is the finest) that the noise is estimated from.  A series too short for
    one level passes unchanged.  A missing or infinite sample is an error: fill them before.
    """
    if level < 1:
        raise ValueError("level counts from 1")
    bank, ids, name = bank_of(wavelet), list(ids), name or f"{column}_wavelet"
    df = _filled(df, column)
    found = blocks.long_series(df, ids, order, max_rows) if found is None else found
    short = blocks.others(df, ids, found) if found else df
    out = _per_series(short, column, name, ids, order, lambda x: wavelet_array(x, level, wavelet))
    if not found:
        return out
    rows = _indexed(df, column, ids, order, found, max_rows)
    return out.unionByName(_filled_in(rows, _wavelet_long(rows, ids, level, max_rows, bank), ids, name))
