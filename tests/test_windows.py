"""Windows against pandas, series by series, with and without cutting long series."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import blocks, growing, windows
from seriesmill.operators.windows import FUNCTIONS, RollingSpec, diff, rolling, shift, weights

NEVER, CUT = 10_000, 20


def got(df, columns):
    pdf = df.select("id", "time", *columns).toPandas()
    return pdf.sort_values(["id", "time"]).reset_index(drop=True)


def want(series, fn):
    ordered = series.sort_values(["id", "time"])
    return pd.concat([fn(g) for _, g in ordered.groupby("id")]).to_numpy(dtype=float)


def same(a, b, tol=1e-7):
    np.testing.assert_allclose(a.to_numpy(dtype=float), b, rtol=tol, atol=tol)


@pytest.fixture(params=["windows", "kernels"])
def engine(request, monkeypatch):
    """Run with every frame as a Spark window, or with every frame in a sliding kernel."""
    limit = 10**9 if request.param == "windows" else 0
    monkeypatch.setattr(windows, "WIDE", limit)


@pytest.mark.parametrize("max_rows", [NEVER, CUT])
def test_rolling_functions(series, series_df, max_rows, engine):
    specs = [RollingSpec("x", f, window=9, min_periods=4, name=f) for f in FUNCTIONS]
    specs.append(RollingSpec("x", quantile=0.3, window=9, min_periods=4, name="q"))
    out = got(rolling(series_df, specs, max_rows=max_rows), [s.name for s in specs])
    assert len(out) == len(series)
    for f in FUNCTIONS:
        same(out[f], want(series, lambda g: getattr(g.x.rolling(9, min_periods=4), f)()), 1e-6)
    same(out["q"], want(series, lambda g: g.x.rolling(9, min_periods=4).quantile(0.3)))


@pytest.mark.parametrize("max_rows", [NEVER, CUT])
@pytest.mark.parametrize("window", [3, 4])
def test_frames(series, series_df, window, max_rows, engine):
    cases = [(c, k) for c in (False, True) for k in ("right", "left", "both", "neither")]
    specs = [RollingSpec("x", "sum", window=window, min_periods=1, center=c, closed=k, name=f"{c}_{k}")
             for c, k in cases]
    out = got(rolling(series_df, specs, max_rows=max_rows), [s.name for s in specs])
    for (c, k), spec in zip(cases, specs):
        same(out[spec.name], want(series, lambda g: g.x.rolling(window, 1, center=c, closed=k).sum()))


@pytest.mark.parametrize("max_rows", [NEVER, CUT])
def test_expanding(series, series_df, max_rows):
    funcs = ["sum", "mean", "min", "max", "std", "var", "count", "skew", "kurt", "sem"]
    if max_rows == NEVER:
        funcs += ["median", "rank"]
    specs = [RollingSpec("x", f, name=f, min_periods=2) for f in funcs]
    out = got(rolling(series_df, specs, max_rows=max_rows), funcs)
    for f in funcs:
        same(out[f], want(series, lambda g: getattr(g.x.expanding(2), f)()), 1e-6)


@pytest.mark.parametrize("span", [2, 1000])
def test_expanding_order_of_a_long_series(spark, series, monkeypatch, span):
    """Over blocks as in one piece, with ties and gaps, whatever the size of the coarse cells."""
    monkeypatch.setattr(growing, "SPAN", span)
    pdf = series.assign(x=series["x"].round(-1), seq=range(len(series)))
    rows = [tuple(None if v != v else v for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "id string, time double, x double, kind string, seq long").repartition(5)
    specs = [RollingSpec("x", "median", min_periods=2, name="m"), RollingSpec("x", quantile=0.9, name="q"),
             RollingSpec("x", "rank", min_periods=3, name="r"), RollingSpec("x", "mean", name="a"),
             RollingSpec("x", "median", filter_column="kind", filter_value="u", name="f")]
    key = lambda r: r["seq"]
    whole, cut = (sorted(rolling(df, specs, order=["time", "seq"], **kw).collect(), key=key) for kw in ({}, {"max_rows": 30}))
    for spec in specs:
        a, b = (np.array([r[spec.column] for r in out], dtype="float64") for out in (whole, cut))
        np.testing.assert_allclose(a, b, rtol=1e-9)


def test_one_value_in_most_rows_of_a_long_series(spark, monkeypatch, tmp_path):
    """No task gets all rows that have one value; results are those of the uncut series."""
    from pyspark.sql.group import GroupedData

    as_it_is = GroupedData.applyInPandas

    def watched(self, func, schema):
        def run(pdf):
            if "__x" in pdf.columns:
                (tmp_path / f"{len(pdf):06d}").touch()
            return func(pdf)
        return as_it_is(self, run, schema)

    monkeypatch.setattr(GroupedData, "applyInPandas", watched)
    rng = np.random.default_rng(5)
    x = np.where(rng.random(3000) < 0.4, 0.0, np.round(rng.normal(0, 20, 3000), 1))
    df = spark.createDataFrame([("a", float(k), v) for k, v in enumerate(x.tolist())], "id string, time double, x double")
    specs = [RollingSpec("x", f, min_periods=2, name=f) for f in ("median", "rank")]
    out = rolling(df, specs, max_rows=100).orderBy("time").toPandas()
    grown = pd.Series(x).expanding(2)
    np.testing.assert_allclose(out["median"], grown.median())
    np.testing.assert_allclose(out["rank"], grown.rank())
    assert max(int(f.name) for f in tmp_path.iterdir()) <= 500


@pytest.mark.parametrize("max_rows", [NEVER, CUT])
@pytest.mark.parametrize("n", [0, 2, -3])
def test_filter_and_shift(series, series_df, n, max_rows):
    specs = [
        RollingSpec("x", "mean", window=3, min_periods=1, filter_column="kind", filter_value="u", shift=n,
                    name="f"),
        RollingSpec("x", "max", window=4, min_periods=1, name="plain"),
        RollingSpec("x", "sum", min_periods=1, filter_column="kind", filter_value="v", name="grow"),
    ]

    def reference(g, kind, fn):
        return fn(g.x[g.kind == kind]).reindex(g.index)

    out = got(rolling(series_df, specs, max_rows=max_rows), ["f", "plain", "grow"])
    same(out["f"], want(series, lambda g: reference(g, "u", lambda s: s.rolling(3, 1).mean()).shift(n)))
    same(out["plain"], want(series, lambda g: g.x.rolling(4, 1).max()))
    same(out["grow"], want(series, lambda g: reference(g, "v", lambda s: s.expanding(1).sum())))


@pytest.mark.parametrize("max_rows", [NEVER, CUT])
def test_shift_and_diff(series, series_df, max_rows):
    out = got(diff(series_df, "x", "d", max_rows=max_rows), ["d"])
    same(out["d"], want(series, lambda g: g.x.diff()))
    moved = got(shift(series_df, {"x": -2}, max_rows=max_rows), ["x"])
    same(moved["x"], want(series, lambda g: g.x.shift(-2)))


def test_min_periods_defaults_to_the_window(spark, engine):
    rows = [("a", float(i), v) for i, v in enumerate([None, 1.0, 2.0, None, 4.0, 5.0, 6.0])]
    df = spark.createDataFrame(rows, "id string, time double, x double")
    out = got(rolling(df, [RollingSpec("x", "mean", window=3, name="m")]), ["m"])["m"]
    assert out.isna().tolist() == [True] * 6 + [False] and out.iloc[6] == 5.0
    counted = got(rolling(df.limit(3), [RollingSpec("x", "count", window=2, name="n")]), ["n"])["n"]
    assert np.isnan(counted[0]) and counted.tolist()[1:] == [1.0, 2.0]


@pytest.mark.parametrize("max_rows", [NEVER, CUT])
@pytest.mark.parametrize("center", [False, True])
def test_weighted(series, series_df, center, max_rows, engine):
    w = np.array(weights("triang", 5))
    specs = [RollingSpec("x", f, window=5, min_periods=2, win_type="triang", center=center, name=f)
             for f in ("sum", "mean")]
    out = got(rolling(series_df, specs, max_rows=max_rows), ["sum", "mean"])

    def weighted(g, mean):
        x, result = g.x.to_numpy(), []
        for i in range(len(x)):
            at = np.arange(5) + i - 4 + (2 if center else 0)
            inside = (at >= 0) & (at < len(x))
            v, u = x[at[inside]], w[inside]
            ok = ~np.isnan(v)
            total = (v[ok] * u[ok]).sum()
            result.append(np.nan if ok.sum() < 2 else total / u[ok].sum() if mean else total)
        return pd.Series(result)

    same(out["sum"], want(series, lambda g: weighted(g, False)))
    same(out["mean"], want(series, lambda g: weighted(g, True)))


@pytest.mark.parametrize("closed, center", [("right", False), ("both", True), ("left", False)])
def test_windows_longer_than_pieces(series, series_df, closed, center, engine):
    spec = RollingSpec("x", "mean", window=61, min_periods=2, closed=closed, center=center, name="m")
    out = got(rolling(series_df, [spec], max_rows=10), ["m"])
    same(out["m"], want(series, lambda g: g.x.rolling(61, 2, center=center, closed=closed).mean()))


def test_weights():
    assert weights("boxcar", 3) == [1, 1, 1]
    np.testing.assert_allclose(weights("triang", 5), [1 / 3, 2 / 3, 1, 2 / 3, 1 / 3])
    np.testing.assert_allclose(weights("triang", 4), [0.25, 0.75, 0.75, 0.25])
    np.testing.assert_allclose(weights("gaussian", 3, 1.0), [np.exp(-0.5), 1, np.exp(-0.5)])


@pytest.mark.parametrize("max_rows", [NEVER, CUT])
def test_custom_function(series, series_df, max_rows):
    def spread(v: pd.Series) -> float:
        return float(v.max() - v.min())

    spec = RollingSpec("x", spread, window=5, min_periods=2)
    assert spec.column == "x_spread_5_2_0"
    out = got(rolling(series_df, [spec], max_rows=max_rows), [spec.column])
    expected = want(series, lambda g: g.x.rolling(5, 2).apply(lambda v: np.nanmax(v) - np.nanmin(v)))
    same(out[spec.column], expected)


def test_spec_is_checked(series_df):
    with pytest.raises(AttributeError):
        RollingSpec("x")
    with pytest.raises(TypeError):
        RollingSpec("x", "sum", center=True)
    with pytest.raises(KeyError):
        rolling(series_df, [RollingSpec("nope", "sum")])
    for bad in (dict(func="mode"), dict(quantile=1.5), dict(func="sum", window=0),
                dict(func="sum", window=2, closed="up"), dict(func="max", window=2, win_type="triang")):
        with pytest.raises(ValueError):
            RollingSpec("x", **bad)


@pytest.mark.parametrize("backwards", [False, True])
def test_running_totals(series, series_df, backwards):
    columns = {"s": ("sum", F.col("x")), "lo": ("min", F.col("x")), "hi": ("max", F.col("x")),
               "seen": ("last", F.col("x"))}
    out = got(blocks.run_totals(series_df, ["id"], ["time"], columns, backwards, CUT), list(columns))

    def turned(fn):
        def run(g):
            x = g.x[::-1] if backwards else g.x
            return fn(x)[::-1] if backwards else fn(x)
        return run

    same(out["s"], want(series, turned(lambda x: x.expanding(1).sum())))
    same(out["lo"], want(series, turned(lambda x: x.expanding(1).min())))
    same(out["hi"], want(series, turned(lambda x: x.expanding(1).max())))
    same(out["seen"], want(series, turned(lambda x: x.ffill())))


def test_blocks_are_bounded(series, series_df):
    found = blocks.long_series(series_df, ["id"], ["time"], CUT)
    assert found.n_series == 2
    rows, sizes, n_blocks = blocks.cut(series_df, ["id"], ["time"], found, CUT)
    sizes = [r["__n"] for r in sizes.collect()]
    assert max(sizes) <= 2 * CUT and len(sizes) == n_blocks and sum(sizes) == 180
    assert rows.count() == len(series) and rows.where(F.col(blocks.BLOCK).isNull()).count() == 1


@pytest.mark.parametrize("batch", [1, 7, 10_000])
def test_kernels_do_not_depend_on_batches(spark, series, series_df, batch, monkeypatch):
    monkeypatch.setattr(windows, "WIDE", 0)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        out = got(rolling(series_df, [RollingSpec("x", "median", window=30, min_periods=1, center=True, name="m")]), ["m"])
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    same(out["m"], want(series, lambda g: g.x.rolling(30, 1, center=True).median()))


@pytest.mark.parametrize("n", [0, 1])
def test_infinities_are_missing(spark, engine, n):
    rows = [("a", 0.0, float("inf")), ("a", 1.0, 1.0), ("a", 2.0, float("nan")), ("a", 3.0, 3.0)]
    df = spark.createDataFrame(rows, "id string, time double, x double")
    out = got(rolling(df, [RollingSpec("x", "mean", window=4, min_periods=n, name="m")]), ["m"])["m"]
    assert np.isnan(out[0]) and out.tolist()[1:] == [1, 1, 2]


def test_one_check_serves_many_operators(series, series_df):
    found = blocks.long_series(series_df, max_rows=CUT)
    spec = [RollingSpec("x", "mean", window=9, min_periods=1, shift=1, name="m"), RollingSpec("x", "sum", name="s")]
    out = got(rolling(series_df, spec, max_rows=CUT, found=found), ["m", "s"])
    same(out["m"], want(series, lambda g: g.x.rolling(9, 1).mean().shift(1)))
    same(out["s"], want(series, lambda g: g.x.expanding(1).sum()))
    assert found and not blocks.long_series(series_df, max_rows=NEVER)


def test_null_ids_form_a_series(spark):
    df = spark.range(90).selectExpr("if(id % 3 = 0, 'a', null) as id", "id as time", "1.0D as x")
    spec = [RollingSpec("x", "sum", window=50, min_periods=1, name="s")]
    out = rolling(df, spec, max_rows=7).groupBy("id").agg(F.max("s")).collect()
    assert dict((r[0], r[1]) for r in out) == {"a": 30.0, None: 50.0}
