"""Cases at the edges: odd order values, frames beside other series, bounds that do not fit, code that must travel."""

import os
import subprocess
import sys
import textwrap

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.functions.scalar import total_seconds
from seriesmill.operators import blocks, clean, kernels, lookups, split, windows
from seriesmill.operators.windows import RollingSpec, rolling

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
INF, NAN = float("inf"), float("nan")


def series_with(times):
    return [("a", t, k, float(k % 7)) for k, t in enumerate(times)]


@pytest.mark.parametrize("times", [
    [*range(60), NAN], [*range(60), INF], [-INF, *range(60)], [None, *range(60)], [None] * 25 + [*range(30)] + [INF] * 30 + [NAN] * 30,
    [5.0] * 80, [1.0] * 40 + [2.0] * 40, [1e300, *range(60), -1e300],
], ids=["nan", "inf", "minus inf", "null", "all edges", "one time", "two times", "far apart"])
def test_cut_ends_and_equals_the_uncut(spark, times):
    rows = series_with([None if t is None else float(t) for t in times])
    df = spark.createDataFrame(rows, "id string, time double, seq int, x double").repartition(4)
    specs = [RollingSpec("x", "sum", window=5, min_periods=1, name="s")]
    whole = rolling(df, specs, order=["time", "seq"])
    cut = rolling(df, specs, order=["time", "seq"], max_rows=10)
    key = lambda r: r["seq"]
    assert [r["s"] for r in sorted(cut.collect(), key=key)] == [r["s"] for r in sorted(whole.collect(), key=key)]
    totals = blocks.run_totals(df, ["id"], ["time", "seq"], {"t": ("sum", F.col("x"))}, max_rows=10)
    want = blocks.run_totals(df, ["id"], ["time", "seq"], {"t": ("sum", F.col("x"))})
    assert [r["t"] for r in sorted(totals.collect(), key=key)] == [r["t"] for r in sorted(want.collect(), key=key)]


def test_blocks_of_equal_times_are_cut(spark):
    df = spark.createDataFrame(series_with([1.0] * 100), "id string, time double, seq int, x double")
    found = blocks.long_series(df, ["id"], ["time"], 10)
    for order in (["time", "seq"], ["time"]):
        assert blocks.cut(df, ["id"], order, found, 10).sizes.agg(F.max("__n")).first()[0] <= 20


def test_rows_that_are_alike_stay_together(spark):
    df = spark.createDataFrame([("a", 1.0)] * 50, "id string, time double")
    found = blocks.long_series(df, ["id"], ["time"], 10)
    assert blocks.cut(df, ["id"], ["time"], found, 10).n_blocks == 1


def brute(x, func, window, least):
    out = []
    for k in range(len(x)):
        v = x[max(0, k - window + 1):k + 1]
        v = v[~np.isnan(v)]
        n, d = len(v), v - v.mean() if len(v) else v
        m2, m3, m4 = ((d**p).sum() for p in (2, 3, 4))
        if n < max(1, least):
            out.append(np.nan)
        elif func in ("sum", "mean", "min", "max"):
            out.append(getattr(np, func)(v))
        elif func == "skew":
            out.append(np.nan if n < 3 else 0.0 if m2 == 0 else np.sqrt(n) * m3 / m2**1.5 * np.sqrt(n * (n - 1)) / (n - 2))
        elif func == "kurt":
            out.append(np.nan if n < 4 else -3.0 if m2 == 0 else (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * (n * m4 / m2**2 - 3) + 6))
        else:
            var = m2 / (n - 1) if n > 1 else np.nan
            out.append({"var": var, "std": np.sqrt(var), "sem": np.sqrt(var) / np.sqrt(n - 1) if n > 1 else np.nan}[func])
    return np.array(out)


@pytest.mark.parametrize("window", [1, 2, 7, 30, 500])
def test_frames_see_only_themselves(window):
    """Beside series of other levels, after an outlier, and alone: the same to the last bit, and right."""
    rng = np.random.default_rng(1)
    quiet, loud = rng.normal(0, 1e-3, 90), rng.normal(90_000, 1, 70)
    jump = np.concatenate([rng.normal(0, 1e-3, 40), [1e7], rng.normal(100, 1, 40)])
    gaps = np.where(rng.random(60) < 0.3, np.nan, rng.normal(5, 2, 60))
    parts = [quiet, loud, jump, gaps, np.full(20, 3.0)]

    def run(series):
        x = np.concatenate(series)
        ends = np.cumsum([len(s) for s in series])
        starts = ends - [len(s) for s in series]
        begin, end = kernels.frames(starts, ends, 1 - window, 0)
        sets = kernels.merged_frames(x, starts, ends, begin, end, window, 4)
        return {f: np.split(kernels.result_of(f, sets, 1), ends[:-1]) for f in kernels.MERGED}

    together = run(parts)
    for k, part in enumerate(parts):
        alone = run([part])
        for func in kernels.MERGED:
            assert np.array_equal(alone[func][0], together[func][k], equal_nan=True)
            if func in ("skew", "kurt") and k in (2, 4):
                continue  # a flat frame or one outlier: the plain sums are what is not exact
            np.testing.assert_allclose(together[func][k], brute(part, func, window, 1), rtol=1e-6, atol=1e-12)


@pytest.mark.parametrize(("center", "closed"), [(True, "right"), (False, "both"), (False, "neither"), (True, "left")])
def test_merged_frames_of_other_shapes(center, closed):
    rng = np.random.default_rng(2)
    x, starts, ends = rng.normal(0, 1, 50), np.array([0, 30]), np.array([30, 50])
    first, last = RollingSpec("x", "sum", window=6, center=center, closed=closed).reach
    begin, end = kernels.frames(starts, ends, first, last)
    sets = kernels.merged_frames(x, starts, ends, begin, end, last - first + 1, 2)
    want = [x[a:b].sum() if b > a else np.nan for a, b in zip(begin, end)]
    np.testing.assert_allclose(kernels.result_of("sum", sets, 1), want, atol=1e-12)


def test_both_engines_agree(spark, series_df, monkeypatch):
    specs = [RollingSpec("x", f, window=40, min_periods=4, name=f"y_{f}") for f in kernels.MERGED]
    rows = {}
    for limit in (0, 10**9):
        monkeypatch.setattr(windows, "WIDE", limit)
        rows[limit] = sorted(rolling(series_df, specs).collect(), key=lambda r: (r["id"], r["time"]))
    for spec in specs:
        a, b = (np.array([r[spec.name] for r in rows[limit]], dtype="float64") for limit in (0, 10**9))
        np.testing.assert_allclose(a, b, rtol=1e-7, atol=1e-9)


def test_kept_columns_are_all_that_travels(spark):
    df = spark.range(50).selectExpr("'a' AS id", "id AS time", "CAST(id AS double) AS x", "repeat('p', 1000) AS payload", "id % 2 AS k")
    out = rolling(df, [RollingSpec("x", "median", window=90, min_periods=1, name="m")], keep=["k"])
    assert out.columns == ["id", "time", "k", "m"]
    assert "payload" not in out._jdf.queryExecution().optimizedPlan().toString() and "repeat" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_clip_of_narrow_integers(spark):
    df = spark.sql("SELECT CAST(x AS tinyint) AS x FROM VALUES (-128), (-1), (5), (127), (NULL) t(x)")
    value = lambda lo, hi: [r[0] for r in clean.clip(df, {"x": (lo, hi)}).orderBy(F.col("x").asc_nulls_last()).collect()]
    assert value(0, 1000) == [0, 0, 5, 127, None] and clean.clip(df, {"x": (0, 1000)}).dtypes == [("x", "tinyint")]
    assert value(200, None) == [200] * 4 + [None]
    assert value(0.5, 5.5) == [0.5, 0.5, 5.0, 5.5, None]
    assert value(-INF, INF) == [-128, -1, 5, 127, None]


def test_total_seconds_of_numbers_and_times(spark):
    numbers = spark.sql("SELECT 1.0D AS a, 11.0D AS b")
    assert numbers.select(total_seconds(numbers, "a", "b")).first()[0] == 10
    times = spark.sql("SELECT TIMESTAMP'2024-01-01 00:00:00' AS a, TIMESTAMP'2024-01-01 00:00:10.5' AS b")
    assert times.select(total_seconds(times, "a", "b")).first()[0] == 10.5


def test_rows_without_key(spark):
    df = spark.createDataFrame([(None, k) for k in range(50)] + [("a", 1), ("b", 2)], "id string, x int")
    table = spark.createDataFrame([("a", 10), (None, 20)], "id string, y int")
    for how, n in (("left", 52), ("left_semi", 1), ("left_anti", 51)):
        out = lookups.attach(df, table, ["id"], how, broadcast_rows=0)
        assert out.count() == n == df.join(table, "id", how).count() and "__salt" not in out.columns
    assert lookups.attach_predictions(df, table, ["id"]).count() == 53


def test_wide_tables_are_not_broadcast(spark, monkeypatch):
    table = spark.range(10).selectExpr("id", "repeat('x', 1000) AS payload")
    assert blocks.small(table)
    monkeypatch.setattr(blocks, "BROADCAST_BYTES", 5000)
    assert not blocks.small(table)


@pytest.mark.parametrize("n", [0, 1, 7, 39, 40, 60])
def test_sample_by_threshold(spark, monkeypatch, n):
    monkeypatch.setattr(split, "FEW_IDS", 2)
    df = spark.range(120).selectExpr("concat('i', id % 40) AS id")
    want = df.distinct().orderBy(split._seeded("id", 42), "id").limit(n)
    assert {r[0] for r in split.sample_ids(df, n).collect()} == {r[0] for r in want.collect()}


def test_folds_of_string_ids_by_name(spark):
    df = spark.createDataFrame([(c, k) for c in "bdface" for k in range(3)], "id string, x int")
    folds = {r["id"]: r["fold"] for r in split.fold_assignment(df, 2).collect()}
    assert folds == {"a": 0, "b": 1, "c": 0, "d": 1, "e": 0, "f": 1}


def test_code_reaches_workers(tmp_path):
    """From another working directory, with the repository known to the driver only."""
    code = f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        import __spark_entry__ as entry
        from pyspark.sql import SparkSession
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        print("rows", entry.entry(spark).count())
    """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "rows " in done.stdout, done.stderr[-2000:]
