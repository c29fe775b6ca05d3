"""Common time step and resampling to a regular step."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.operators import blocks
from seriesmill.operators.blocks import micros, ticks_per_second
from seriesmill.operators.windows import diff

DAY = 86_400
# Buckets made from one row; longer gaps grow in two steps.
GRID_ROWS = 100_000


def common_timestep(df: DataFrame, times: Sequence[str] = ("time",), ids: Sequence[str] = ("id",),
                    per_series: bool = False, max_rows: int = blocks.MAX_ROWS) -> DataFrame:
    """Most frequent step between neighbouring rows of a series, in whole seconds, as ``time_step``.

    The smallest wins ties; over several time columns the smallest of their steps counts.
    """
    if not times:
        raise ValueError("name at least one time column")
    by = list(ids) if per_series else []
    steps = []
    for time in times:
        ticks = df.select(*ids, micros(df, time).alias("__t"))
        gaps = diff(ticks, "__t", "__d", ids, ["__t"], max_rows).where(F.col("__d").isNotNull())
        counts = gaps.groupBy(*by, "__d").agg(F.count(F.lit(1)).alias("__n"))
        mode = F.min(F.struct(-F.col("__n"), F.col("__d")))["__d"]
        steps.append(counts.groupBy(*by).agg((mode / ticks_per_second(df, time)).cast("long").alias("time_step")))
    out = steps[0]
    for other in steps[1:]:
        out = out.unionByName(other)
    return out.groupBy(*by).agg(F.min("time_step").alias("time_step")) if len(steps) > 1 else out


def resample_mean(df: DataFrame, time_step: int | None = None, time: str = "time", ids: Sequence[str] = ("id",),
                  columns: Sequence[str] | None = None, max_rows: int = blocks.MAX_ROWS) -> DataFrame:
    """Mean of the numeric columns in fixed buckets of ``time_step`` seconds, empty buckets as NULL.

    Buckets are closed and labelled on the left and count from midnight of the first day of each series.
    """
    ids = list(ids)
    if columns is None:
        columns = [c for c in df.columns if c not in (*ids, time)]
    other = [c for c in columns if not isinstance(df.schema[c].dataType, T.NumericType)]
    if other:
        raise TypeError(f"cannot average {other}")
    if time_step is None:
        time_step = common_timestep(df, [time], ids, max_rows=max_rows).first()["time_step"]
        if not time_step:
            raise ValueError("rows are less than a second apart or alone; give time_step")
    unit = ticks_per_second(df, time)
    step, day = time_step * unit, DAY * unit
    # Midnights are whole days apart, so rows can be summed in cells that divide both the step and a day
    # before the origin of their series is known.
    cell = math.gcd(time_step, DAY) * unit

    def whole(x: Column, size: int) -> Column:
        return (F.floor(x / F.lit(size)) * size).cast("long")

    t = micros(df, time)
    sums = df.groupBy(*ids, whole(t, cell).alias("__t")).agg(
        *[F.sum(F.col(f"`{c}`").cast("double")).alias(f"__s{i}") for i, c in enumerate(columns)],
        *[F.count(f"`{c}`").alias(f"__n{i}") for i, c in enumerate(columns)],
    )
    if time_step == cell // unit:
        buckets = sums
    else:
        # Cells divide steps and days, so the first one stands for the first row.
        days = sums.groupBy(*ids).agg(whole(F.min("__t"), day).alias("__day"))
        bucket = F.floor((F.col("__t") - F.col("__day")) / F.lit(step)).cast("long")
        placed = blocks.lookup(sums, days, ids, "left").withColumn("__t", F.col("__day") + bucket * step)
        buckets = placed.groupBy(*ids, "__t").agg(*[F.sum(c).alias(c) for c in sums.columns if c not in (*ids, "__t")])

    def up_to_next(rows: DataFrame, keys: list[str]) -> DataFrame:
        return rows.withColumn("__next", F.lead("__t").over(Window.partitionBy(*keys).orderBy("__t")))

    # A bucket with rows also makes the empty ones up to the next, so a task only holds buckets with rows.
    found = blocks.long_series(df, ids, [time], max_rows)
    gaps = blocks.over_series(buckets, ids, ["__t"], 0, 1, up_to_next, max_rows, found)
    size = F.when(F.col("__t").isNotNull() & F.col("__next").isNotNull(), F.floor((F.col("__next") - F.col("__t")) / F.lit(step)))
    gaps = gaps.withColumn("__size", F.coalesce(size, F.lit(1)).cast("long")).withColumn(
        "__c", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__size") - 1, F.lit(GRID_ROWS).cast("long"))))
    # A long gap leaves in chunks, so that its rows are made by many tasks.
    full = gaps.repartition(*ids, "__t", "__c").withColumn("__i", F.explode(F.sequence(
        "__c", F.least(F.col("__size"), F.col("__c") + GRID_ROWS) - 1)))
    full = full.select(*ids, (F.col("__t") + F.col("__i") * step).alias("__t"), *[
        F.when(F.col("__i") == 0, F.try_divide(f"__s{i}", f"__n{i}")).alias(c) for i, c in enumerate(columns)])
    dtype = df.schema[time].dataType
    start = F.col("__t") if unit == 1 else F.timestamp_micros("__t")
    if isinstance(dtype, T.TimestampNTZType):
        start = (F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
                 + F.make_dt_interval(secs=(F.col("__t") / F.lit(1_000_000)).cast("decimal(18,6)")))
    return full.select(*ids, start.cast(dtype).alias(time), *columns)
