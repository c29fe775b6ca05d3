"""Label, group and prediction lookups, set operations on ids, and row filters."""

from __future__ import annotations

import functools
import operator
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.scalar import map_code
from seriesmill.operators import blocks
from seriesmill.schema import TARGET_CODES, UNDEFINED
from seriesmill.storage import reliable


def attach(df: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left",
           max_rows: int = blocks.MAX_ROWS, broadcast_rows: int = blocks.BROADCAST_ROWS) -> DataFrame:
    """Join rows to a table with one row per key.

    The table is broadcast if its counted rows and bytes allow.  Beyond that the rows are shuffled, except those of
    keys with more than ``max_rows`` rows: these keys are few, and their part of the table is broadcast if it passes
    the same check.  Rows without a key match nothing and are spread.
    """
    on = list(on)
    if blocks.small(table, broadcast_rows):
        return df.join(F.broadcast(table), on, how)
    heavy = df.where(_all_known(on)).groupBy(*on).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > max_rows).select(*on)
    heavy = reliable(heavy)
    few = None if heavy.isEmpty() else table.join(heavy, on, "left_semi")
    if few is None or not blocks.small(few, broadcast_rows):
        return _spread_join(df, table, on, how)
    keys = F.broadcast(heavy)  # its rows are no more than those of few and of df / max_rows
    return (df.join(keys, on, "left_semi").join(F.broadcast(few), on, how)
            .unionByName(_spread_join(df.join(keys, on, "left_anti"), table, on, how)))


def _all_known(on: Sequence[str]) -> Column:
    return functools.reduce(operator.and_, [F.col(f"`{c}`").isNotNull() for c in on])


def _spread_join(df: DataFrame, table: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """A join on keys whose rows without a key, which match nothing, do not meet in one task."""
    def salted(rows: DataFrame) -> DataFrame:
        spread = F.pmod(F.monotonically_increasing_id(), F.lit(1 << 16))
        return rows.withColumn("__salt", F.when(_all_known(on), F.lit(0).cast("long")).otherwise(spread + 1))

    return salted(df).join(salted(table), [*on, "__salt"], how).drop("__salt")


def _last_per_key(table: DataFrame, key: str, value: str, order: str | None) -> DataFrame:
    """One value per key: the last by ``order``.  Without an order a key may repeat only with the same value."""
    if order is not None:
        return table.select(key, value, F.col(f"`{order}`").alias("__at")).groupBy(key).agg(F.max_by(value, "__at").alias(value))
    seen = table.select(key, value).groupBy(key).agg(
        F.min(value).alias("__lo"), F.max(value).alias("__hi"), F.count(value).alias("__known"), F.count(F.lit(1)).alias("__n"))
    alike = (F.col("__known") == 0) | ((F.col("__known") == F.col("__n")) & (F.col("__lo") == F.col("__hi")))
    several = F.concat(F.lit(f"several values of {value} for {key} "), F.col(f"`{key}`").cast("string"), F.lit("; give an order"))
    return seen.select(key, F.when(alike, F.col("__lo")).otherwise(F.raise_error(several).cast(table.schema[value].dataType)).alias(value))


def mark_target(df: DataFrame, labels: DataFrame, key: str = "id", target: str = "target",
                order: str | None = None, codes: Mapping[str, int] = TARGET_CODES) -> DataFrame:
    """Add the target code of each measurement; unknown or unlabelled is UNDEFINED.

    The last label of a key by ``order`` wins; labels read with ``position`` have one of their place in the files.
    Without an order, a key with several labels is an error.
    """
    coded = _last_per_key(labels.withColumn(target, map_code(F.col(target), codes)), key, target, order)
    marked = attach(df.drop(target), coded, [key])
    return marked.withColumn(target, F.coalesce(F.col(target), F.lit(UNDEFINED)).cast("int"))


def decode_groups(df: DataFrame, mapping: DataFrame, group: str = "group_id", name: str = "name",
                  order: str | None = None) -> DataFrame:
    """Add the name of each group number.  ``mapping`` is (name, number or array of numbers); the last
    name of a number by ``order`` wins, and without an order several are an error."""
    if isinstance(mapping.schema[group].dataType, T.ArrayType):
        mapping = mapping.withColumn(group, F.explode(group))
    return attach(df, _last_per_key(mapping, group, name, order), [group])


def attach_predictions(df: DataFrame, predictions: DataFrame, on: Sequence[str] = ("id", "time")) -> DataFrame:
    """Rows and predictions side by side, matched on the row key; unmatched rows of both stay."""
    return _spread_join(df, predictions, list(on), "full_outer")


def audit_missing(expected: DataFrame, processed: DataFrame, key: str = "id") -> DataFrame:
    """One row per expected id: ``done`` if it was processed."""
    seen = processed.select(key).distinct().withColumn("done", F.lit(True))
    ids = expected.select(key).distinct()
    return ids.join(seen, key, "left").withColumn("done", F.coalesce("done", F.lit(False)))


def missing_ids(expected: DataFrame, processed: DataFrame, key: str = "id") -> DataFrame:
    return expected.select(key).distinct().join(processed.select(key).distinct(), key, "left_anti")


def union_rows(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by column name; absent columns are NULL."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def distinct_ids(df: DataFrame, key: str = "id") -> DataFrame:
    return df.select(key).distinct()


def except_ids(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    return left.select(key).subtract(right.select(key))


def intersect_ids(left: DataFrame, right: DataFrame, key: str = "id") -> DataFrame:
    return left.select(key).intersect(right.select(key))


def value_counts(df: DataFrame, column: str, more_than: int = 0) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > more_than)


def filter_eq(df: DataFrame, column: str, value) -> DataFrame:
    """Rows equal to the value; missing never matches."""
    return df.where(F.col(f"`{column}`") == F.lit(value))


def filter_in(df: DataFrame, keys: DataFrame, key: str = "id", keep: bool = True) -> DataFrame:
    """Rows whose key is (or, with ``keep=False``, is not) among the keys."""
    return attach(df, keys.select(key).distinct(), [key], "left_semi" if keep else "left_anti")


def threshold(score: Column, at: float = 0.5) -> Column:
    """1 above the threshold, else 0; a missing score is 0."""
    return F.when(score > at, 1).otherwise(0)
