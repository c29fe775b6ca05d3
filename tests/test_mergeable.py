"""Custom functions as merging states, frames by doubling, weighted frames by convolution, file order, malformed lines."""

import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.operators import kernels, lookups
from seriesmill.operators.mergeable import Mergeable
from seriesmill.operators.windows import RollingSpec, rolling, weights
from seriesmill.sources import files

PATH = Mergeable("path", lambda x: {"first": x, "last": x, "way": 0 * x},
                 lambda a, b: {"first": a["first"], "last": b["last"], "way": a["way"] + b["way"] + np.abs(b["first"] - a["last"])},
                 lambda s: s["way"])
LOGSUM = Mergeable("logsum", lambda x: {"s": np.log1p(np.abs(x))}, lambda a, b: {"s": a["s"] + b["s"]}, lambda s: np.exp(s["s"]))


def way(values):
    known = [v for v in values if v == v]
    return sum(abs(b - a) for a, b in zip(known, known[1:]))


@pytest.mark.parametrize("max_rows", [1_000_000, 30])
def test_custom_states(series, series_df, max_rows):
    """Bounded and growing frames, shifted and filtered ones, over whole series and over blocks."""
    specs = [RollingSpec("x", PATH, min_periods=2, name="grown"), RollingSpec("x", PATH, window=7, min_periods=2, name="near"),
             RollingSpec("x", PATH, min_periods=1, filter_column="kind", filter_value="u", name="mine"),
             RollingSpec("x", PATH, min_periods=2, shift=1, name="late")]
    rows = rolling(series_df, specs, max_rows=max_rows).orderBy("id", "time").collect()
    held = lambda values: sum(v == v for v in values)
    want = {s.name: [] for s in specs}
    for _, g in series.sort_values(["id", "time"]).groupby("id"):
        x, kind = g["x"].tolist(), g["kind"].tolist()
        grown = [way(x[:k + 1]) if held(x[:k + 1]) >= 2 else None for k in range(len(x))]
        want["grown"] += grown
        want["late"] += [None, *grown[:-1]]
        want["near"] += [way(x[max(0, k - 6):k + 1]) if held(x[max(0, k - 6):k + 1]) >= 2 else None for k in range(len(x))]
        mine = [[v for v, q in zip(x[:k + 1], kind) if q == "u"] for k in range(len(x))]
        want["mine"] += [way(m) if q == "u" and held(m) >= 1 else None for m, q in zip(mine, kind)]
    for name, values in want.items():
        np.testing.assert_allclose(np.array([r[name] for r in rows], float), np.array(values, float), rtol=1e-9, err_msg=name)


def test_custom_names_and_refusal(series_df):
    assert RollingSpec("x", PATH, window=5).column == "x_path_5_0"
    for rows in (10, 1_000_000):  # whatever the size
        with pytest.raises(TypeError, match="Mergeable"):
            rolling(series_df, [RollingSpec("x", lambda v: 0.0)], max_rows=rows)


def test_states_see_no_missing_values():
    seen = []
    spy = Mergeable("spy", lambda x: {"s": x}, lambda a, b: seen.append((a, b)) or {"s": a["s"] + b["s"]}, lambda s: s["s"])
    x = np.array([np.nan, 1.0, np.nan, 2.0, np.nan])
    begin, end = np.array([0, 0, 0, 1, 4]), np.array([5, 1, 2, 4, 5])
    out = spy.results(kernels.doubled_frames(spy.of_values(x), begin, end, spy.join), 1)
    np.testing.assert_array_equal(out, [3, np.nan, 1, 3, np.nan])
    assert not any(np.isnan(v).any() for a, b in seen for s in (a, b) for v in s.values())


@pytest.mark.parametrize("width", [1, 2, 3, 64, 100, 333])
def test_doubled_frames_are_merged_frames(width, monkeypatch):
    rng = np.random.default_rng(width)
    x = rng.normal(5, 2, 400)
    x[rng.random(400) < 0.2] = np.nan
    starts, ends = np.array([0, 50, 51, 300]), np.array([50, 51, 300, 400])
    begin, end = kernels.frames(starts, ends, -(width - 1), 0)
    one = kernels.merged_frames(x, starts, ends, begin, end, width, 4)
    monkeypatch.setattr(kernels, "DOUBLING", 0)
    two = kernels.merged_frames(x, starts, ends, begin, end, width, 4)
    for func in kernels.MERGED:
        np.testing.assert_allclose(kernels.result_of(func, one, 1), kernels.result_of(func, two, 1), rtol=1e-6, atol=1e-9, err_msg=func)


def test_very_wide_frames_cost_little_more():
    x = np.random.default_rng(1).normal(0, 1, 200_000)
    starts, ends = np.array([0]), np.array([len(x)])

    def took(width):
        begin, end = kernels.frames(starts, ends, -(width - 1), 0)
        start = time.perf_counter()
        kernels.merged_frames(x, starts, ends, begin, end, width, 2)
        return time.perf_counter() - start

    took(500)
    assert min(took(50_000) for _ in range(3)) < 4 * min(took(500) for _ in range(3))


NAMES = [("boxcar", {}), ("triang", {}), ("bartlett", {}), ("hann", {}), ("hamming", {}), ("blackman", {}), ("cosine", {}), ("parzen", {}),
         ("gaussian", {"std": 3.0}), ("kaiser", {"shape": 4.0}), ("exponential", {"shape": 3.0})]


def weighted_by_hand(x, w, k, ahead, func, least):
    pairs = [(w[j], x[k + ahead - len(w) + 1 + j]) for j in range(len(w)) if 0 <= k + ahead - len(w) + 1 + j < len(x)]
    pairs = [(a, v) for a, v in pairs if v == v]
    total, mass = sum(a * v for a, v in pairs), sum(a for a, _ in pairs)
    if len(pairs) < least:
        return None
    if func == "sum":
        return total
    if mass < 1e-12 * sum(w):
        return None
    if func == "mean":
        return total / mass
    if len(pairs) == 1:
        return 0.0
    square = sum(a * (v - total / mass) ** 2 for a, v in pairs)
    var = square * len(w) / ((len(w) - 1) * mass)
    return var if func == "var" else var**0.5


@pytest.mark.parametrize(("name", "more"), NAMES)
def test_weighted_frames(series, series_df, name, more):
    w = weights(name, 40, **more)
    assert np.allclose(w, w[::-1]) and max(w) <= 1 + 1e-12 and min(w) >= -1e-12 and len(weights(name, 1, **more)) == 1
    specs = [RollingSpec("x", f, window=40, min_periods=2, win_type=name, center=c, name=f"{f}{int(c)}", **more)
             for f in ("sum", "mean", "var", "std") for c in (False, True)]
    rows = rolling(series_df, specs).orderBy("id", "time").collect()
    values = [g["x"].tolist() for _, g in series.sort_values(["id", "time"]).groupby("id")]
    for s in specs:
        want = [weighted_by_hand(x, w, k, 19 if s.center else 0, s.func, 2) for x in values for k in range(len(x))]
        np.testing.assert_allclose(np.array([r[s.name] for r in rows], float), np.array(want, float), rtol=1e-7, atol=1e-9, err_msg=s.name)


def test_weighted_frames_of_pieces(series_df):
    spec = RollingSpec("x", "std", window=40, min_periods=2, win_type="hann", name="y")
    whole, cut = ([r["y"] for r in rolling(series_df, [spec], max_rows=n).orderBy("id", "time").collect()] for n in (10**6, 30))
    np.testing.assert_allclose(np.array(whole, float), np.array(cut, float), rtol=1e-7)


def test_known_weights():
    np.testing.assert_allclose(weights("hann", 5), [0, 0.5, 1, 0.5, 0], atol=1e-12)
    np.testing.assert_allclose(weights("parzen", 4), [1 / 32, 23 / 32, 23 / 32, 1 / 32])
    np.testing.assert_allclose(weights("cosine", 3), [0.5, 1, 0.5])
    np.testing.assert_allclose(weights("exponential", 3, shape=2.0), [np.exp(-0.5), 1, np.exp(-0.5)])
    for bad in (("unknown", {}), ("kaiser", {}), ("gaussian", {})):
        with pytest.raises(ValueError):
            weights(bad[0], 5, **bad[1])


@pytest.mark.parametrize(("n", "taps"), [(1000, 200), (5000, 1000), (300, 2000), (129, 129), (10, 500)])
def test_convolution(n, taps):
    rng = np.random.default_rng(n)
    x, w = rng.normal(size=n), rng.random(taps)
    np.testing.assert_allclose(kernels.convolved(x, w), np.convolve(x, w), rtol=1e-9, atol=1e-9)


def test_weighted_time_does_not_grow_with_the_window():
    x = np.random.default_rng(1).normal(size=300_000)

    def took(taps):
        w = np.hanning(taps)
        start = time.perf_counter()
        kernels.convolved(x, w)
        return time.perf_counter() - start

    took(1000)
    assert min(took(20_000) for _ in range(3)) < 4 * min(took(1000) for _ in range(3))


# File order and malformed lines

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("target", T.StringType())])
NUMBERS = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType())])


def test_last_file_wins(spark, tmp_path):
    (tmp_path / "b.csv").write_text("id,target\n1,OD\n2,ID\n2,OD\n")
    (tmp_path / "a.csv").write_text("id,target\n1,ID\n3,ID\n")
    read = files.read_csv(spark, f"{tmp_path}/*.csv", SCHEMA, position="place")
    rows = spark.createDataFrame([("1",), ("2",), ("3",), ("4",), (None,)], "id string")
    found = {r["id"]: r["target"] for r in lookups.mark_target(rows, read, order="place").collect()}
    assert found == {"1": 0, "2": 0, "3": 1, "4": -1, None: -1}


def test_repeated_key_without_order(spark):
    rows = spark.createDataFrame([(1,), (2,)], "group_id int")
    mapping = spark.createDataFrame([("x", 1), ("x", 1), ("y", 2)], "name string, group_id int")
    assert sorted(tuple(r) for r in lookups.decode_groups(rows, mapping).collect()) == [(1, "x"), (2, "y")]
    for name in ("z", None):
        twice = mapping.unionByName(spark.createDataFrame([(name, 2)], mapping.schema))
        with pytest.raises(Exception, match="several values of name for group_id 2"):
            lookups.decode_groups(rows, twice).collect()


@pytest.mark.parametrize("line", ["b,oops", "c,3,4", "d"])
def test_malformed_lines(spark, tmp_path, line):
    path = tmp_path / "x.csv"
    path.write_text(f"a,b\ng,1\n{line}\nh,\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE"):
        files.read_csv(spark, str(path), NUMBERS).select("a").collect()
    good, bad = files.read_csv_parts(spark, str(path), NUMBERS)
    assert [tuple(r) for r in good.collect()] == [("g", 1), ("h", None)]
    assert [(r["file"].rsplit("/")[-1], r["line"]) for r in bad.collect()] == [("x.csv", line)]
    assert bad.count() == 1 and good.count() == 2
