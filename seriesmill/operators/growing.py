"""Quantiles and ranks among all earlier rows, for series of any length.

A long series is cut twice: into blocks of rows in its order, and into blocks of values.  A table of counts, one
number for each pair of blocks, says how many earlier values lie below a block of values.  What it cannot say is found
inside one block of either kind. Of a block of values, tasks get its distinct values with their number in each block of
rows, so a value may occur any number of times, and no task holds more than a few blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.operators import blocks, kernels
from seriesmill.storage import reliable

LONG, DOUBLE = T.LongType(), T.DoubleType()

#: Row blocks, and value blocks, on a side of a coarse cell of counts.
SPAN = 1000


def _fields(*longs: str, **more: T.DataType) -> list[T.StructField]:
    return [T.StructField(n, t) for n, t in {**dict.fromkeys(longs, LONG), **more}.items()]


def _by_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], kept: Sequence[str], fields: list[T.StructField],
              make: Callable[[dict[str, np.ndarray]], Sequence[np.ndarray]]) -> DataFrame:
    return kernels.over_groups(df, keys, order, kept, fields, kernels.one_by_one(make, fields))


def _columns(found: list[tuple], n: int) -> list[np.ndarray]:
    """Rows as their n columns."""
    return list(np.array(found, np.int64).reshape(-1, n).T)


def _coarse(block: str) -> Column:
    return F.floor(F.col(block) / SPAN).cast("long")


def _grid(rows: np.ndarray, values: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows and values with the places of both, and counts of each pair."""
    row, at = np.unique(rows, return_inverse=True)
    value, by = np.unique(values, return_inverse=True)
    counts = np.zeros((len(row), len(value)), np.int64)
    np.add.at(counts, (at, by), n.astype("int64"))
    return row, value, at, by, counts


def _corner(cells: DataFrame, ids: list[str], within: list[str], row: str, value: str, name: str) -> DataFrame:
    """For each cell, the sum over those of its group in earlier rows and lower values."""
    def run(group: dict[str, np.ndarray]) -> list[np.ndarray]:
        _, _, at, by, counts = _grid(group[row], group[value], group["__n"])
        sums = np.pad(counts, ((1, 0), (1, 0))).cumsum(0).cumsum(1)
        return [group[row], group[value], sums[at, by]]

    return _by_group(cells, [*ids, *within], [row, value], [*ids, *within], _fields(row, value, name), run)


def _carried(cells: DataFrame, wanted: DataFrame, ids: list[str], within: list[str], row: str, value: str) -> DataFrame:
    """For each wanted row of a group, the sums by value over all earlier rows, where there are any."""
    def run(group: dict[str, np.ndarray]) -> list[np.ndarray]:
        asked = np.isnan(group[value])
        rows, values, _, _, counts = _grid(group[row][~asked], group[value][~asked], group["__n"][~asked])
        upto, out = np.cumsum(counts, 0), []
        for r in np.unique(group[row][asked]).tolist():
            k = int(np.searchsorted(rows, r))
            if k:
                some = np.flatnonzero(upto[k - 1])
                out += zip([r] * len(some), values[some].tolist(), upto[k - 1][some].tolist())
        return _columns(out, 3)

    both = cells.select(*ids, *within, row, value, "__n").unionByName(wanted.select(*ids, *within, row).distinct(), allowMissingColumns=True)
    return _by_group(both, [*ids, *within], [row], [*ids, *within], _fields(row, value, "__n"), run)


def _narrowed(asks: DataFrame, cells: DataFrame, carried: DataFrame, ids: list[str], within: list[str], value: str) -> DataFrame:
    """For each row block that asks for the ranks __low to __high among earlier rows, __below of which lie below its group,
    the values of the group that hold them, each with how many earlier rows lie below it."""
    def run(group: dict[str, np.ndarray]) -> list[np.ndarray]:
        asking, out = ~np.isnan(group["__low"]), []
        if asking.any():
            # What is carried into the group stands before all its row blocks.
            held = {c: group[c][~asking] for c in ("__b", value, "__n")}
            rows, values, _, _, counts = _grid(np.nan_to_num(held["__b"], nan=-1), held[value], held["__n"])
            sums = np.cumsum(counts, 0)
            asked = [group[c][asking].astype("int64").tolist() for c in ("__b", "__low", "__high", "__below")]
            for b, low, high, below in zip(*asked):
                earlier = sums[int(np.searchsorted(rows, b)) - 1]
                upto = below + np.cumsum(earlier)
                hit = np.flatnonzero((earlier > 0) & (upto > low) & (upto - earlier <= high))
                out += zip([b] * len(hit), values[hit].tolist(), (upto - earlier)[hit].tolist(), [low] * len(hit), [high] * len(hit))
        return _columns(out, 5)

    all_ = asks.select(*ids, *within, "__b", "__below", "__low", "__high").unionByName(
        cells.select(*ids, *within, "__b", value, "__n"), allowMissingColumns=True).unionByName(
        carried.select(*ids, *within, value, "__n"), allowMissingColumns=True)
    return _by_group(all_, [*ids, *within], ["__b"], [*ids, *within], _fields("__b", value, "__below", "__low", "__high"), run)


class _Counts:
    """How many rows each pair of a row block and a value block holds, in cells, coarse cells of SPAN x SPAN pairs, and the
    strips between. Sums over earlier rows are put together from these, so no group holds more than SPAN x SPAN
    numbers as long as a series has at most SPAN x SPAN blocks."""

    def __init__(self, cells: DataFrame, ids: list[str]) -> None:
        def summed(*keys: str) -> DataFrame:
            return self.cells.groupBy(*ids, *keys).agg(F.sum("__n").alias("__n"))

        self.ids = ids
        self.cells = reliable(cells.withColumns({"__cb": _coarse("__b"), "__cv": _coarse("__v")}))
        self.coarse, self.by_row, self.by_value = summed("__cb", "__cv"), summed("__cb", "__b", "__cv"), summed("__cb", "__cv", "__v")

    def below(self) -> DataFrame:
        """__below of each cell: rows of earlier row blocks in lower value blocks."""
        ids = self.ids
        parts = [
            (_corner(self.by_value, ids, ["__cv"], "__cb", "__v", "__part1"), ["__cb", "__cv", "__v"]),
            (_corner(self.by_row, ids, ["__cb"], "__b", "__cv", "__part2"), ["__cb", "__b", "__cv"]),
            (_corner(self.coarse, ids, [], "__cb", "__cv", "__part3"), ["__cb", "__cv"]),
        ]
        out = _corner(self.cells, ids, ["__cb", "__cv"], "__b", "__v", "__part0")
        for part, keys in parts:
            out = blocks.lookup(out, part, [*ids, *keys], "left")
        return reliable(out.select(*ids, "__b", "__v", sum((F.col(f"__part{k}") for k in range(1, 4)), F.col("__part0")).alias("__below")))

    def holding(self, asks: DataFrame) -> DataFrame:
        """For each row block with ranks __low to __high among earlier rows, the value blocks that hold them, with __below."""
        ids = self.ids
        asks = asks.withColumn("__cb", _coarse("__b"))
        before = _carried(self.coarse, asks, ids, [], "__cb", "__cv")
        near = reliable(_narrowed(asks, self.by_row, before, ids, ["__cb"], "__cv"))
        before = _carried(self.by_value, near, ids, ["__cv"], "__cb", "__v")
        return reliable(_narrowed(near, self.cells, before, ids, ["__cb", "__cv"], "__v"))


class _Ranked:
    """Values that become active one by one, some from the start as often as ``active`` says, and the k-th smallest
    active one: a tree of counts over sorted places."""

    def __init__(self, values: np.ndarray, active: np.ndarray) -> None:
        self.order = np.argsort(values, kind="stable")
        self.values = values[self.order]
        self.place = np.empty(len(values), np.int64)
        self.place[self.order] = np.arange(1, len(values) + 1)
        total = np.concatenate([[0], np.cumsum(active[self.order])])
        at = np.arange(1, len(values) + 1)
        self.tree = [0, *(total[at] - total[at - (at & -at)]).tolist()]
        self.top = 1 << len(values).bit_length()

    def add(self, k: int) -> None:
        at, tree = int(self.place[k]), self.tree
        while at < len(tree):
            tree[at] += 1
            at += at & -at

    def smallest(self, k: int) -> float:
        """The active value with ``k`` active ones before it."""
        at, step, tree = 0, self.top, self.tree
        while step:
            far = at + step
            if far < len(tree) and tree[far] <= k:
                at, k = far, k - tree[far]
            step >>= 1
        return float(self.values[at])


def _expanding_quantile(x: np.ndarray, earlier: np.ndarray, times: np.ndarray, below: int, before: int, q: float, least: int) -> np.ndarray:
    """Quantiles after each of the new values ``x``, when ``before`` values came earlier: ``below`` that are smaller than
    all that matter, then ``earlier``, each as many ``times``, then larger ones."""
    known = ~np.isnan(x)
    ranked = _Ranked(np.concatenate([earlier, x[known]]), np.concatenate([times, np.zeros(int(known.sum()), np.int64)]))
    out, n, k = np.full(len(x), np.nan), before, len(earlier)
    for i, here in enumerate(known.tolist()):
        if here:
            ranked.add(k)
            n, k = n + 1, k + 1
        if n >= max(1, least):
            at = q * (n - 1)
            low = int(np.floor(at))
            a = ranked.smallest(low - below)
            out[i] = a if at == low else a + (ranked.smallest(low + 1 - below) - a) * (at - low)
    return out


def _cut_values(rows: DataFrame, ids: list[str], max_rows: int) -> DataFrame:
    """Rows with a value, with __v, a block of values that grows with them; equal values share one."""
    known = rows.where(F.col("__x").isNotNull()).select(*ids, "__pos", "__b", "__x")
    found = blocks.long_series(known, ids, ["__x"], max_rows)
    if not found:
        return known.withColumn("__v", F.lit(0).cast("long"))
    parts, sizes, n_blocks = blocks.cut(known, ids, ["__x"], found, max_rows, alike_together=True)
    # Numbered by the rows before them, so that small neighbours share a number and there are no more than row blocks.
    before = F.sum("__n").over(Window.partitionBy(*ids).orderBy(blocks.BLOCK).rowsBetween(blocks.FROM_START, -1))
    numbers = reliable(sizes.select(*ids, blocks.BLOCK, F.floor(F.coalesce(before, F.lit(0)) / max_rows).cast("long").alias("__v")))
    placed = blocks.lookup(parts, blocks.hinted(numbers, n_blocks), [*ids, blocks.BLOCK], "left")
    return placed.withColumn("__v", F.coalesce("__v", F.lit(0).cast("long"))).drop(blocks.BLOCK)


def expanding_order(df: DataFrame, source: Column, quantiles: dict[str, tuple[float, int]], ranks: dict[str, int],
                    ids: Sequence[str], order: Sequence[str], max_rows: int, found: blocks.LongSeries) -> DataFrame:
    """Rows of long series with, by name, quantiles (q, least values) and ranks (least values) of ``source`` among all
    rows up to each."""
    ids = list(ids)
    rows = blocks.number_rows(df, ids, order, "__pos", max_rows, found)
    rows = reliable(rows.withColumns({"__x": source, "__b": F.floor(F.col("__pos") / max_rows).cast("long")}))
    narrow = rows.select(*ids, "__pos", "__b", "__x")
    distinct = reliable(_cut_values(narrow, ids, max_rows).groupBy(*ids, "__b", "__v", "__x").agg(F.count(F.lit(1)).alias("__n")))
    counts = _Counts(distinct.groupBy(*ids, "__b", "__v").agg(F.sum("__n").alias("__n")), ids)
    earlier = F.sum("__held").over(Window.partitionBy(*ids).orderBy("__b").rowsBetween(blocks.FROM_START, -1))
    every = narrow.groupBy(*ids, "__b").agg(F.count("__x").alias("__held"))
    every = reliable(every.withColumn("__before", F.coalesce(earlier, F.lit(0))))
    out = rows
    for name, (q, least) in quantiles.items():
        out = blocks.lookup(out, _quantiles(narrow, distinct, counts, every, ids, name, q, least), [*ids, "__pos"], "left")
    if ranks:
        out = blocks.lookup(out, _ranks(narrow, distinct, counts, every, ids, ranks), [*ids, "__pos"], "left")
    made = [*quantiles, *ranks]
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[F.nullif(F.col(f"`{c}`"), F.lit(float("nan"))).alias(c) for c in made])


def _quantiles(narrow: DataFrame, distinct: DataFrame, counts: _Counts, every: DataFrame, ids: list[str], name: str,
               q: float, least: int) -> DataFrame:
    # Each row block needs the value blocks of the ranks that its quantiles can have among earlier values.
    before, held = F.col("__before"), F.col("__held")
    low = F.least(F.greatest(F.lit(0), F.floor(F.lit(q) * before) - held - 1), before - 1)
    high = F.least(before - 1, F.floor(F.lit(q) * (before + held)) + 1)
    asks = every.where(before > 0).select(*ids, "__b", F.lit(0).cast("long").alias("__below"), low.cast("long").alias("__low"),
                                          high.cast("long").alias("__high"))
    wanted = counts.holding(asks)
    to = wanted.select(*ids, F.col("__b").alias("__to"), "__v")
    sent = blocks.lookup(distinct, to, [*ids, "__v"], "inner").where("__b < __to")
    sent = sent.groupBy(*ids, F.col("__to").alias("__b"), "__x").agg(F.sum("__n").alias("__n"))
    least_below = wanted.groupBy(*ids, "__b").agg(F.min("__below").alias("__below"))
    base = blocks.lookup(every.select(*ids, "__b", "__before"), least_below, [*ids, "__b"], "left").fillna({"__below": 0})
    all_ = blocks.lookup(narrow.select(*ids, "__b", "__pos", "__x").unionByName(sent, allowMissingColumns=True), base, [*ids, "__b"], "left")

    def select(group: dict[str, np.ndarray]) -> list[np.ndarray]:
        new = ~np.isnan(group["__pos"])
        earlier, times = group["__x"][~new], group["__n"][~new].astype("int64")
        return [group["__pos"][new], _expanding_quantile(group["__x"][new], earlier, times, int(group["__below"][0]),
                                                         int(group["__before"][0]), q, least)]

    return _by_group(all_, [*ids, "__b"], ["__pos"], ids, _fields("__pos", **{name: DOUBLE}), select)


def _ranks(narrow: DataFrame, distinct: DataFrame, counts: _Counts, every: DataFrame, ids: list[str], ranks: dict[str, int]) -> DataFrame:
    table = blocks.lookup(counts.below(), every.select(*ids, "__b", "__before"), [*ids, "__b"], "left")
    placed = blocks.lookup(distinct, table, [*ids, "__b", "__v"], "left")

    def among_values(pdf: pd.DataFrame) -> pd.DataFrame:
        """Of the same block of values, earlier blocks of rows: how many are smaller, how many equal."""
        pdf = pdf.sort_values(["__b", "__x"])
        values, place = np.unique(pdf["__x"].to_numpy(), return_inverse=True)
        n, edges = pdf["__n"].to_numpy(), np.flatnonzero(np.diff(pdf["__b"].to_numpy())) + 1
        less, equal, seen = [], [], np.zeros(len(values), np.int64)
        for at, more in zip(np.split(place, edges), np.split(n, edges)):
            equal.append(seen[at])
            less.append(np.cumsum(seen)[at] - equal[-1])
            seen[at] += more
        return pdf.assign(__below=pdf["__below"] + np.concatenate(less), __equal=np.concatenate(equal))[made.names]

    made = T.StructType([*[narrow.schema[c] for c in ids], *_fields("__b", __x=DOUBLE, __below=LONG, __equal=LONG, __before=LONG)])
    partly = placed.groupBy(*ids, "__v").applyInPandas(among_values, made)
    known = narrow.where(F.col("__x").isNotNull()).select(*ids, "__pos", "__b", "__x")
    partly = blocks.lookup(known, partly, [*ids, "__b", "__x"], "left")

    def among_rows(columns: dict[str, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> tuple:
        """Of the same block of rows, earlier ones; a tie counts half."""
        begin, end = kernels.frames(starts, ends, None, 0)
        first, last = (kernels.slide_rank(columns["__x"], begin, end, method) for method in ("min", "max"))
        same = last - first + 1 + columns["__equal"]
        value = columns["__below"] + first - 1 + (same + 1) / 2
        held = columns["__before"] + end - begin
        return ends - starts, [columns["__pos"], *[np.where(held >= max(1, least), value, np.nan) for least in ranks.values()]]

    return kernels.over_groups(partly, [*ids, "__b"], ["__pos"], ids, _fields("__pos", **{n: DOUBLE for n in ranks}), among_rows)
