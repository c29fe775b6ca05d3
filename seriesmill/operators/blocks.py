"""Ordered work on series of any length.

A series is all rows that share the id columns, ordered by the order columns.  Most series are short
and one window per series is the right plan.  A series longer than ``max_rows`` must not land in one
task, so it is cut into contiguous blocks of bounded size:

* frames of bounded reach run on pieces (runs of blocks) that carry a halo of the neighbouring blocks;
* running totals run inside each block and add what the earlier blocks sum up to.

Both are exact, need one exchange of the rows, and leave short series whole.  Which plan is used is
decided by one aggregate over the id and order columns.  Only tables of one row per block are kept.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.storage import reliable

BLOCK, PIECE = "__block", "__piece"

# Rows of one series that a single task may hold.
MAX_ROWS = 1_000_000
# Rows up to which a lookup table is broadcast.
BROADCAST_ROWS = 4_000_000
# Rows up to which a table of one row per block or series is: it passes through the driver.
HINT_ROWS = 100_000
# Bytes up to which a lookup table is, whatever its rows.
BROADCAST_BYTES = 256 << 20

FROM_START = Window.unboundedPreceding


@dataclass(frozen=True)
class LongSeries:
    """Series above the limit: one row each (ids, __n, __lo, __hi), at most rows / max_rows of them.

    False if there are none.  A check can be handed to every operator on the same series.
    """

    n_series: int
    table: DataFrame | None = None

    def __bool__(self) -> bool:
        return self.n_series > 0


def width(table: DataFrame) -> Column:
    """Bytes of a row, about: fixed types by their size, strings by their length, others by that of their text."""
    total = F.lit(16).cast("long")
    for f in table.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + 8 + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + 16 + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            total = total + 16
    return total


def small(table: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """May the table be broadcast, by its counted rows and bytes?"""
    n, size = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(width(table)), F.lit(0))).first()
    return n <= rows and size <= BROADCAST_BYTES


def hinted(table: DataFrame, rows: int) -> DataFrame:
    """Broadcast a table of known size if it is small; otherwise both sides are exchanged, at any number of rows."""
    return F.broadcast(table) if rows <= HINT_ROWS else table.hint("merge")


def micros(df: DataFrame, column: str) -> Column:
    """A time, interval or numeric column as a number, independent of the session time zone."""
    dtype = df.schema[column].dataType
    c = F.col(f"`{column}`")
    if isinstance(dtype, T.TimestampNTZType):
        since = c - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return (since.cast("interval second").cast("decimal(20,6)") * 1_000_000).cast("long")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("long") * 86_400_000_000
    if isinstance(dtype, T.DayTimeIntervalType):
        return (c.cast("interval second").cast("decimal(20,6)") * 1_000_000).cast("long")
    if isinstance(dtype, T.NumericType):
        return c
    raise TypeError(f"{column} must be a time or numeric column, not {dtype.simpleString()}")


def ticks_per_second(df: DataFrame, column: str) -> int:
    """Units of ``micros`` in a second: numbers are seconds, times are microseconds."""
    return 1 if isinstance(df.schema[column].dataType, T.NumericType) else 1_000_000


def lookup(df: DataFrame, table: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys that may be NULL; the key columns of ``table`` are not kept."""
    right = table.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`__right_{k}`")) for k in keys]
    joined = df.join(right, functools.reduce(operator.and_, same), how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.drop(*[f"__right_{k}" for k in keys])


def long_series(df: DataFrame, ids: Sequence[str] = ("id",), order: Sequence[str] = ("time",),
                max_rows: int = MAX_ROWS) -> LongSeries:
    """Find the series with more than ``max_rows`` rows.  One map-side combined aggregate."""
    at = micros(df, order[0]).cast("double")
    sizes = df.groupBy(*ids).agg(
        F.count(F.lit(1)).alias("__n"), F.min(at).alias("__lo"), F.max(at).alias("__hi")
    )
    above = F.col("__n") > max_rows
    n_series = sizes.agg(F.count_if(above)).first()[0]
    return LongSeries(n_series, reliable(sizes.where(above)) if n_series else None)


class Cut(NamedTuple):
    """Rows with a block key that grows with the order, NULL for short series; rows __n of each block."""

    rows: DataFrame
    sizes: DataFrame
    n_blocks: int


# Where a value stands in the order of a window: NULL, -Infinity, finite, Infinity, NaN.
_EDGES = 6  # block numbers besides those of the spans


def _standing(at: Column) -> Column:
    return (F.when(at.isNull(), 0).when(at == float("-inf"), 1).when(F.isnan(at), 4)
            .when(at == float("inf"), 3).otherwise(2))


def _cut_columns(df: DataFrame, order: Sequence[str], alike_together: bool) -> list[Column]:
    """What blocks can be cut along: the order columns up to the first that is no number or time and, if there is
    none, a hash of the row, since rows that tie in all of them come in any order.  ``alike_together`` keeps ties in
    one block."""
    out = []
    for column in order:
        try:
            out.append(micros(df, column).cast("double"))
        except TypeError:
            return out
    if alike_together:
        return out
    plain = [F.col(f"`{f.name}`") for f in df.schema if isinstance(f.dataType, T.AtomicType)]
    return [*out, F.xxhash64(*plain).cast("double")]


def cut(df: DataFrame, ids: Sequence[str], order: Sequence[str], found: LongSeries, max_rows: int,
        alike_together: bool = False) -> Cut:
    """Cut the long series into blocks.

    Blocks are equal spans of the first order column; rows without a finite value stand in blocks of their own, where
    the order puts them.  A block that still holds more than 2 * max_rows rows is cut again, along the next order
    column where the first is the same for all its rows, until none does or all its rows are alike.
    """
    along = _cut_columns(df, order, alike_together)
    kept = list(df.columns)
    spans = F.ceil(F.col("__n") / max_rows).cast("long")

    def differs(j: int) -> Column:
        return (F.col(f"__least{j}") < F.col(f"__most{j}")) | F.coalesce(F.col(f"__lo{j}") < F.col(f"__hi{j}"), F.lit(False))

    def stats(rows: DataFrame) -> DataFrame:
        """One row per block; __by is the column to cut along, NULL if the block is done."""
        made = [F.count(F.lit(1)).alias("__n")]
        for j, at in enumerate(along):
            finite = F.when(_standing(at) == 2, at)
            made += [F.min(finite).alias(f"__lo{j}"), F.max(finite).alias(f"__hi{j}"),
                     F.min(_standing(at)).alias(f"__least{j}"), F.max(_standing(at)).alias(f"__most{j}")]
        by = functools.reduce(lambda rest, j: F.when(differs(j), F.lit(j)).otherwise(rest), reversed(range(len(along))),
                              F.lit(None).cast("int"))
        sizes = rows.where(F.col(BLOCK).isNotNull()).groupBy(*ids, BLOCK).agg(*made)
        return reliable(sizes.withColumn("__by", F.when(F.col("__n") > 2 * max_rows, by)))

    def part(at: Column, lo: Column, hi: Column) -> Column:
        """Place of a row among the parts of its block."""
        inside = F.coalesce(F.width_bucket(at, lo, hi, spans), F.lit(0)).cast("long") + 2
        standing = _standing(at)
        return F.when(standing < 2, standing).when(standing == 2, inside).otherwise(standing + 1 + spans)

    marked = hinted(found.table.select(*ids, F.lit(0).cast("long").alias(BLOCK)), found.n_series)
    rows, before = lookup(df, marked, ids, "left"), 0
    while True:
        sizes = stats(rows)
        n_blocks, n_wide = sizes.agg(F.count(F.lit(1)), F.count("__by")).first()
        if not n_wide:
            return Cut(rows, sizes.select(*ids, BLOCK, "__n"), n_blocks)
        if n_blocks <= before:
            raise RuntimeError("a long series cannot be cut further along its order columns")
        before = n_blocks
        # Number the blocks anew, leaving room for the parts of the wide ones.
        wide = F.col("__by").isNotNull()
        room = F.sum(F.when(wide, spans + _EDGES).otherwise(1)).over(
            Window.partitionBy(*ids).orderBy(BLOCK).rowsBetween(FROM_START, -1))
        low, high = (functools.reduce(lambda rest, j, s=side: F.when(F.col("__by") == j, F.col(f"__{s}{j}")).otherwise(rest),
                                      range(len(along)), F.lit(None).cast("double")) for side in ("lo", "hi"))
        places = sizes.select(*ids, BLOCK, "__n", "__by", low.alias("__lo"), high.alias("__hi"),
                              F.coalesce(room, F.lit(0)).cast("long").alias("__start"))
        rows = lookup(rows, hinted(places, n_blocks), [*ids, BLOCK], "left")
        at = functools.reduce(lambda rest, j: F.when(F.col("__by") == j, along[j]).otherwise(rest), range(len(along)),
                              F.lit(None).cast("double"))
        placed = F.col("__start") + F.when(wide, part(at, F.col("__lo"), F.col("__hi"))).otherwise(0)
        rows = rows.select(*[F.col(f"`{c}`") for c in kept], placed.alias(BLOCK))


def only(df: DataFrame, ids: Sequence[str], found: LongSeries) -> DataFrame:
    """Rows of the series above the limit."""
    return lookup(df, hinted(found.table.select(*ids), found.n_series), ids, "left_semi")


def others(df: DataFrame, ids: Sequence[str], found: LongSeries) -> DataFrame:
    """Rows of the series within the limit."""
    return lookup(df, hinted(found.table.select(*ids), found.n_series), ids, "left_anti")


# How a running value is formed inside a block and how blocks add up.
# kind: (over rows, over blocks, both together)
_RUNNING: dict[str, tuple[Callable, Callable, Callable]] = {
    "sum": (F.sum, F.sum, lambda here, before: F.when(
        here.isNotNull() | before.isNotNull(),
        F.coalesce(here, F.lit(0)) + F.coalesce(before, F.lit(0)))),
    "min": (F.min, F.min, lambda here, before: F.least(here, before)),
    "max": (F.max, F.max, lambda here, before: F.greatest(here, before)),
    "last": (lambda x: F.last(x, True), lambda x: F.last(x, True), lambda here, before: F.coalesce(here, before)),
}


def _per_block(kind: str, x: Column, order: Sequence[Column], backwards: bool) -> Column:
    if kind != "last":
        return _RUNNING[kind][0](x)
    pick = F.min_by if backwards else F.max_by
    return pick(x, F.when(x.isNotNull(), F.struct(*order)))


def run_totals(df: DataFrame, ids: Sequence[str], order: Sequence[str],
               columns: dict[str, tuple[str, Column]], backwards: bool = False,
               max_rows: int = MAX_ROWS, found: LongSeries | None = None) -> DataFrame:
    """Add running values from the first row of each series up to the current one.

    ``columns`` maps a name to (kind, expression), kind one of sum, min, max, last; ``last`` is the latest
    value that is not NULL.  ``backwards`` runs from the last row instead.  ``found`` passes on a check of
    the same series.
    """
    direction = F.desc if backwards else F.asc
    found = long_series(df, ids, order, max_rows) if found is None else found

    def running(kind: str, x: Column, keys: Sequence[str]) -> Column:
        w = Window.partitionBy(*keys).orderBy(*[direction(c) for c in order]).rowsBetween(FROM_START, 0)
        return _RUNNING[kind][0](x).over(w)

    if not found:
        return df.select("*", *[running(kind, x, ids).alias(name) for name, (kind, x) in columns.items()])

    rows, _, n_blocks = cut(df, ids, order, found, max_rows)
    key = [*ids, BLOCK]
    by = [F.col(c) for c in order]
    earlier = Window.partitionBy(*ids).orderBy(direction(BLOCK)).rowsBetween(FROM_START, -1)
    per_block = rows.where(F.col(BLOCK).isNotNull()).groupBy(*key).agg(
        *[_per_block(kind, x, by, backwards).alias(name) for name, (kind, x) in columns.items()]
    )
    carried = reliable(per_block.select(
        *key, *[_RUNNING[kind][1](F.col(name)).over(earlier).alias(f"__before_{name}")
                for name, (kind, _) in columns.items()]
    ))
    return lookup(rows, hinted(carried, n_blocks), key, "left").select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[_RUNNING[kind][2](running(kind, x, key), F.col(f"__before_{name}")).alias(name)
          for name, (kind, x) in columns.items()],
    )


def number_rows(df: DataFrame, ids: Sequence[str], order: Sequence[str], name: str,
                max_rows: int = MAX_ROWS, found: LongSeries | None = None) -> DataFrame:
    """Add the position of each row in its series, from 0."""
    out = run_totals(df, ids, order, {name: ("sum", F.lit(1).cast("long"))}, max_rows=max_rows, found=found)
    return out.withColumn(name, F.col(name) - 1)


def over_series(df: DataFrame, ids: Sequence[str], order: Sequence[str], back: int, ahead: int,
                add: Callable[[DataFrame, list[str]], DataFrame], max_rows: int = MAX_ROWS,
                found: LongSeries | None = None) -> DataFrame:
    """Run ``add(rows, partition columns)`` where each result needs at most ``back`` rows before it and
    ``ahead`` rows after it in its series.  Long series are handed over piece by piece with that halo.
    ``found`` passes on a check of the same series."""
    found = long_series(df, ids, order, max_rows) if found is None else found
    if not found:
        return add(df, list(ids))
    # Small blocks, so that a halo of whole blocks stays small next to a piece.
    rows, sizes, n_blocks = cut(df, ids, order, found, max(1, max_rows // 8))
    key = [*ids, BLOCK]
    size = max(max_rows, back + ahead)
    along = Window.partitionBy(*ids).orderBy(BLOCK)
    placed = sizes.select(
        *key, F.col("__n").alias("n"),
        F.coalesce(F.sum("__n").over(along.rowsBetween(FROM_START, -1)), F.lit(0)).alias("start"),
        F.max("__n").over(Window.partitionBy(*ids)).alias("most"),
    )
    # A piece holds the blocks that start in its range of positions.  A block also goes to every piece
    # with a row at most ``back`` after its end or ``ahead`` before its start.
    first = F.when(F.lit(ahead) > 0, F.greatest(F.col("start") - F.col("most") - ahead, F.lit(0)))
    pieces = reliable(placed.select(
        *key,
        F.floor(F.col("start") / size).alias("__own"),
        F.floor(F.coalesce(first, F.col("start")) / size).alias("__first"),
        F.floor((F.col("start") + F.greatest(F.col("n") + back - 1, F.lit(0))) / size).alias("__last"),
    ))
    spread = lookup(rows, hinted(pieces, n_blocks), key, "left").drop(BLOCK)
    spread = spread.withColumn(PIECE, F.explode(F.when(
        F.col("__own").isNotNull(), F.sequence("__first", "__last")).otherwise(F.array(F.lit(0).cast("long")))))
    done = add(spread.drop("__first", "__last"), [*ids, PIECE])
    return done.where(F.coalesce("__own", F.lit(0)) == F.col(PIECE)).drop("__own", PIECE)
