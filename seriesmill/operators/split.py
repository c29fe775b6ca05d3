"""Splitting by measurement: held-out groups, group numbers and balanced folds.  No group is ever split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.scalar import normalize_name
from seriesmill.operators import blocks
from seriesmill.operators.lookups import attach
from seriesmill.storage import reliable

SEED = 42


def _seeded(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(f"`{key}`").cast("string")))


# Ids of one hash prefix that are sorted in one place; a fuller prefix is looked at more closely.
FEW_IDS = 100_000


def _last_sampled(ids: DataFrame, n: int, key: str) -> tuple | None:
    """Hash and id of the n-th of distinct hashed ids, None if there are fewer.  The n-th hash is found by counting prefixes,
    at most 65,536 of them at a time, until few ids are left to sort."""
    left, prefix = n, ""
    while left > FEW_IDS:
        here = ids.where(F.col("__hash").startswith(prefix)) if prefix else ids
        counts = here.groupBy(F.substring("__hash", 1, len(prefix) + 4).alias("p")).count().orderBy("p").collect()
        if sum(r["count"] for r in counts) < left:
            return None
        for p, count in counts:
            if left <= count:
                break
            left -= count
        prefix = p
        if count <= FEW_IDS or len(prefix) >= 32:
            break
    first = ids.where(F.col("__hash").startswith(prefix)).orderBy("__hash", key).limit(left)
    n, last = first.agg(F.count(F.lit(1)), F.max(F.struct("__hash", key))).first()
    return tuple(last) if n == left else None


def _hashed(df: DataFrame, key: str, seed: int) -> DataFrame:
    return df.select(key).where(F.col(f"`{key}`").isNotNull()).distinct().withColumn("__hash", _seeded(key, seed))


def _up_to(last: tuple | None, hash_: Column, value: Column) -> Column:
    if last is None:
        return F.lit(True)
    return (hash_ < F.lit(last[0])) | ((hash_ == F.lit(last[0])) & (value <= F.lit(last[1])))


def sample_ids(df: DataFrame, n: int = 1, key: str = "id", seed: int = SEED) -> DataFrame:
    """``n`` ids in the order of a seeded hash: the same under any partitioning.

    Only the hash of the n-th is looked for, and the ids up to it are filtered: however many are asked for, they stay
    spread.
    """
    ids = _hashed(df, key, seed)
    if n <= 0:
        return ids.limit(0).select(key)
    if n > FEW_IDS:
        ids = reliable(ids)  # counted more than once
    return ids.where(_up_to(_last_sampled(ids, n, key), F.col("__hash"), F.col(f"`{key}`"))).select(key)


def group_holdout(df: DataFrame, n_test: int = 1, test_ids: Sequence | None = None, key: str = "id",
                  seed: int = SEED) -> DataFrame:
    """Add ``split``: test for the named or sampled measurements, train for the rest.  Sampled ones are told by the hash of
    each row's id, without a join."""
    if test_ids is None:
        ids = _hashed(df, key, seed)
        if n_test <= 0:
            return df.withColumn("split", F.lit("train"))
        last = _last_sampled(reliable(ids) if n_test > FEW_IDS else ids, n_test, key)
        held = F.col(f"`{key}`").isNotNull() & _up_to(last, _seeded(key, seed), F.col(f"`{key}`"))
        return df.withColumn("split", F.when(held, "test").otherwise("train"))
    chosen = df.sparkSession.createDataFrame([(i,) for i in test_ids], T.StructType([df.schema[key]])).distinct()
    marked = attach(df, chosen.withColumn("split", F.lit("test")), [key])
    return marked.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("split", F.lit("train")).alias("split"))


def numbered(rows: DataFrame, by: str, name: str) -> DataFrame:
    """Rows with their place from 0 in the order of a column: a spread sort, at every size."""
    kept = rows.columns
    # Ids of monotonically_increasing_id hold the partition above 33 bits of position.
    rows = reliable(rows.orderBy(by).withColumn("__id", F.monotonically_increasing_id()))
    part, place = F.shiftright("__id", 33), F.col("__id").bitwiseAND((1 << 33) - 1)
    rows = rows.select(*kept, part.alias("__part"), place.alias("__place"))
    counts = rows.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))  # one row per partition
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(blocks.FROM_START, -1))
    starts = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__start"))
    return rows.join(F.broadcast(starts), "__part").select(*kept, (F.col("__start") + F.col("__place")).alias(name))


def group_numbers(df: DataFrame, key: str = "id", name: str = "group_id") -> DataFrame:
    """(name, number): a dense bigint from 0 for each distinct normalised name, in name order."""
    names = df.select(normalize_name(F.col(f"`{key}`").cast("string")).alias("name")).distinct()
    return numbered(names, "name", name)


def group_ids(df: DataFrame, key: str = "id", name: str = "group_id",
              max_rows: int = blocks.MAX_ROWS) -> DataFrame:
    """Add the group number of each row; names that agree after normalising share one."""
    numbers = group_numbers(df, key, name).withColumnRenamed("name", "__name")
    named = df.withColumn("__name", normalize_name(F.col(f"`{key}`").cast("string")))
    return attach(named, numbers, ["__name"], max_rows=max_rows).drop("__name")


def _rounds(loads: list[int], size: int, count: int) -> list[tuple[int, int, list[int]]]:
    """Deal ``count`` groups of ``size`` rows, each to the lightest fold, lowest number on ties.

    Folds take turns while no heavier fold is reached, so the outcome is a few runs (start, stop, turns):
    item r of a run goes to ``turns[(r - start) % len(turns)]``.  ``loads`` is brought up to date.
    """
    runs, start = [], 0
    while start < count:
        turns = sorted(range(len(loads)), key=lambda f: (loads[f], f))
        low, first = loads[turns[0]], turns[0]
        active = [f for f in turns if (loads[f], f) < (low + size, first)]
        rest = turns[len(active):]
        # Full rounds before the lightest of the others has its turn.
        full = max(1, (loads[rest[0]] - low - 1) // size) if rest else -(-(count - start) // len(active))
        stop = min(count, start + full * len(active))
        for i, f in enumerate(active):
            loads[f] += size * ((stop - start - i + len(active) - 1) // len(active))
        runs.append((start, stop, active))
        start = stop
    return runs


def fold_assignment(df: DataFrame, n_splits: int = 2, key: str = "id",
                    max_rows: int = blocks.MAX_ROWS) -> DataFrame:
    """(key, fold): groups dealt largest first, each to the lightest fold, ties by key.

    The dealing only needs how many groups there are of each size; the sizes are at most sqrt(2 * rows)
    different numbers.  Each group then finds its fold from its place among the groups of its size.
    """
    sizes = reliable(df.groupBy(key).agg(F.count(F.lit(1)).alias("__size")))
    loads, runs = [0] * n_splits, []
    for size, count in sizes.groupBy("__size").count().orderBy(F.desc("__size")).collect():
        runs += [(size, *run) for run in _rounds(loads, size, count)]
    schema = "__size long, __start long, __stop long, __turns array<int>"
    table = df.sparkSession.createDataFrame(runs, schema).groupBy("__size").agg(
        F.collect_list(F.struct("__start", "__stop", "__turns")).alias("__runs"))
    if isinstance(df.schema[key].dataType, T.NumericType):
        order = [key]
    else:
        sizes = numbered(sizes, key, "__order")
        order = ["__order"]
    ranked = blocks.number_rows(sizes, ["__size"], order, "__place", max_rows)
    ranked = ranked.join(blocks.hinted(table, len(runs)), "__size")
    place = F.col("__place")
    run = F.get(F.filter("__runs", lambda r: (r["__start"] <= place) & (place < r["__stop"])), F.lit(0))
    fold = F.get(run["__turns"], ((place - run["__start"]) % F.size(run["__turns"])).cast("int"))
    return ranked.select(key, fold.alias("fold"))


def group_kfold(df: DataFrame, n_splits: int = 2, key: str = "id", max_rows: int = blocks.MAX_ROWS) -> DataFrame:
    """Add ``fold``: no measurement is in two folds, folds are balanced by rows."""
    if n_splits < 2:
        raise ValueError("at least two folds")
    return attach(df, fold_assignment(df, n_splits, key, max_rows), [key], max_rows=max_rows)
