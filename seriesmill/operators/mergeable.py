"""Custom functions of frames as states that merge: made from single values, joined in their order, turned into a number.

A function of this form needs no Python call per row: sets of 1, 2, 4, ... neighbouring rows are joined for all rows of a
task at once, so a frame of any width takes as many vector operations as its width has binary digits.  And it has no
limit to the length of a series: blocks of a long one are summed up by their states.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.operators import blocks, kernels
from seriesmill.storage import reliable

States = dict[str, np.ndarray]
HELD = "held"


@dataclass(frozen=True)
class Mergeable:
    """A function of the known values of a frame, in their order.

    ``single`` makes the states of single values: named arrays of doubles, one entry per value.  ``merge`` joins states
    of neighbouring frames, the earlier ones first, entry by entry; it must be associative.  ``finish`` gives the
    results.  None of them sees a missing value or an empty frame.
    """

    name: str
    single: Callable[[np.ndarray], States]
    merge: Callable[[States, States], States]
    finish: Callable[[States], np.ndarray]

    @property
    def __name__(self) -> str:
        return self.name

    def of_values(self, x: np.ndarray) -> States:
        known = ~np.isnan(x)
        return {**{k: np.asarray(v, "float64") for k, v in self.single(np.where(known, x, 0.0)).items()}, HELD: known.astype("float64")}

    def join(self, a: States, b: States) -> States:
        """States of both together; one that holds no value adds nothing."""
        with np.errstate(all="ignore"):
            both = self.merge({k: v for k, v in a.items() if k != HELD}, {k: v for k, v in b.items() if k != HELD})
        out = {k: np.where(a[HELD] == 0, b[k], np.where(b[HELD] == 0, a[k], v)) for k, v in both.items()}
        return {**out, HELD: a[HELD] + b[HELD]}

    def results(self, states: States, least: int) -> np.ndarray:
        with np.errstate(all="ignore"):
            value = np.asarray(self.finish({k: v for k, v in states.items() if k != HELD}), "float64")
        return np.where(states[HELD] >= max(1, least), value, np.nan)

    @property
    def parts(self) -> list[str]:
        return [*self.single(np.zeros(1)), HELD]


def expanding(df: DataFrame, source: Column, wanted: dict[str, tuple[Mergeable, int]], ids: Sequence[str], order: Sequence[str],
              max_rows: int, found: blocks.LongSeries) -> DataFrame:
    """Rows with, by name, functions (function, least values) of all rows up to each, for series that may be long: each
    block of a long series is summed up to one state, and its rows go on from that of the blocks before it."""
    ids, order = list(ids), list(order)
    rows, _, n_blocks = blocks.cut(df.withColumn("__x", source), ids, order, found, max_rows)
    key = [*ids, blocks.BLOCK]
    columns = {(name, part): f"__{k}_{part}" for k, (name, (m, _)) in enumerate(wanted.items()) for part in m.parts}
    state = [T.StructField(c, T.DoubleType()) for c in columns.values()]

    def states_of(pdf: pd.DataFrame, begin: np.ndarray, end: np.ndarray) -> dict[str, np.ndarray]:
        out = {}
        for name, (m, _) in wanted.items():
            sets = kernels.doubled_frames(m.of_values(pdf["__x"].to_numpy("float64")), begin, end, m.join)
            out |= {columns[name, part]: values for part, values in sets.items()}
        return out

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, na_position="first")
        made = states_of(pdf, np.array([0]), np.array([len(pdf)]))
        return pd.DataFrame({**{c: pdf[c].iloc[:1].to_numpy() for c in key}, **made})

    def before(pdf: pd.DataFrame) -> pd.DataFrame:
        """The state of all earlier blocks of a series, for each of its blocks."""
        pdf = pdf.sort_values(blocks.BLOCK)
        n, out = len(pdf), {c: pdf[c].to_numpy() for c in key}
        for name, (m, _) in wanted.items():
            own = {part: pdf[columns[name, part]].to_numpy("float64") for part in m.parts}
            sets = kernels.doubled_frames(own, np.zeros(n, np.int64), np.arange(n), m.join)
            out |= {columns[name, part]: values for part, values in sets.items()}
        return pd.DataFrame(out)

    long_rows = rows.where(F.col(blocks.BLOCK).isNotNull()).select(*dict.fromkeys([*key, *order]), "__x")
    schema = T.StructType([*[rows.schema[c] for c in key], *state])
    sums = reliable(long_rows.groupBy(*key).applyInPandas(whole, schema))  # one row per block
    carried = reliable(sums.groupBy(*ids).applyInPandas(before, schema))
    placed = blocks.lookup(rows, blocks.hinted(carried, n_blocks), key, "left")

    def compute(table: pa.Table, starts: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
        x = kernels.numbers(table, "__x")
        begin, end = kernels.frames(starts, ends, None, 0)
        for name, (m, least) in wanted.items():
            here = kernels.doubled_frames(m.of_values(x), begin, end, m.join)
            earlier = {p: np.nan_to_num(table[columns[name, p]].to_numpy().astype("float64")) for p in m.parts}
            yield m.results(m.join(earlier, here), least)

    made = [T.StructField(name, T.DoubleType()) for name in wanted]
    out = kernels.over_whole_series(placed, key, order, made, compute)
    return out.select(*[F.col(f"`{c}`") for c in [*df.columns, *wanted]])
