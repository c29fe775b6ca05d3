"""Windows, denoising and resampling."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from seriesmill.operators import resample, signal
from seriesmill.operators.mergeable import Mergeable
from seriesmill.operators.windows import RollingSpec, diff, rolling, shift
from workload.tables import measurements, neat, query, rounded, with_m

# Rows per series for the queries named _blocked: below the size of the series in the tables, so that they
# run over blocks.
BLOCK_ROWS = 24

ROLL = "(PARTITION BY id ORDER BY time ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)"
GROW = "(PARTITION BY id ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def frame_sql(func: str, over: str) -> str:
    """A function of ch0 over a frame, without the rule on how many values it needs."""
    n = f"count(ch0) OVER {over}"
    if func in ("skew", "kurt"):
        least, flat, fn = (3, 0, "skewness") if func == "skew" else (4, -3, "kurtosis")
        return (f"CASE WHEN {n} >= {least} THEN CASE WHEN var_pop(ch0) OVER {over} = 0 THEN {flat} "
                f"ELSE {fn}(ch0) OVER {over} END END")
    if func == "sem":
        return f"stddev_samp(ch0) OVER {over} / sqrt(nullif({n} - 1, 0))"
    if func == "rank":
        values = f"list(ch0) OVER {over}"
        return (f"CASE WHEN ch0 IS NOT NULL THEN len(list_filter({values}, lambda v: v < ch0)) "
                f"+ (len(list_filter({values}, lambda v: v = ch0)) + 1) / 2.0 END")
    name = {"mean": "avg", "std": "stddev_samp", "var": "var_samp"}.get(func, func)
    return f"{name}(ch0) OVER {over}"


def least_sql(value: str, over: str, least: int, digits: int, held: str = "count(ch0)") -> str:
    held_value = f"CASE WHEN {held} OVER {over} >= {least} THEN CAST({value} AS DOUBLE) END"
    if digits is None:
        return f"CAST(CAST({held_value} AS FLOAT) AS DOUBLE) + 0.0"
    return f"round({held_value}, {digits}) + 0.0"


def feature(spark, sf_dir, *specs, digits=6, max_rows=None):
    kw = {} if max_rows is None else {"max_rows": max_rows}
    out = rolling(measurements(spark, sf_dir).select("id", "time", "ch0", "kind"), specs, **kw)
    return rounded(out.select("id", "time", *[s.column for s in specs]), digits, *[s.column for s in specs])


# Digits are chosen so that a mean of cents never ends in an exact half; variances go to single precision.
DIGITS = {"sum": 6, "mean": 8, "median": 6, "min": 6, "max": 6, "std": 6, "var": None, "count": 6, "skew": 4,
          "kurt": 4, "sem": 6, "rank": 6}

for _func, _digits in DIGITS.items():
    _value = frame_sql(_func, ROLL)
    _held = "count(*)" if _func == "count" else "count(ch0)"
    query(f"rolling_{_func}", with_m(
        f"SELECT id, time, {least_sql(_value, ROLL, 3, _digits, _held)} AS y FROM m"))(
        lambda spark, sf_dir, f=_func, d=_digits: feature(
            spark, sf_dir, RollingSpec("ch0", f, window=10, min_periods=3, name="y"), digits=d))


@query("rolling_quantile", with_m(
    f"SELECT id, time, {least_sql(f'quantile_cont(ch0, 0.3) OVER {ROLL}', ROLL, 3, 6)} AS y FROM m"))
def rolling_quantile(spark, sf_dir):
    return feature(spark, sf_dir, RollingSpec("ch0", quantile=0.3, window=10, min_periods=3, name="y"))


# Recordings whose levels lie seven orders of magnitude apart, in one task.
SCALED = "value * CASE id % 3 WHEN 0 THEN 0.001D WHEN 1 THEN 10000D ELSE 1D END"
SCALED_SQL = SCALED.replace("0.001D", "CAST(0.001 AS DOUBLE)").replace("10000D", "CAST(10000 AS DOUBLE)").replace("1D", "CAST(1 AS DOUBLE)")
LEVELS = ["sum", "mean", "min", "max", "std", "var", "sem", "skew", "kurt", "median"]
_WIDE = "(PARTITION BY id ORDER BY time ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)"


def level_digits(func: str) -> int | None:
    return 3 if func in ("skew", "kurt") else None


@query("rolling_wide_levels", with_m(
    "SELECT id, time, " + ", ".join(f"{least_sql(frame_sql(f, _WIDE), _WIDE, 5, level_digits(f))} AS y_{f}" for f in LEVELS)
    + " FROM s", f"s AS (SELECT id, time, {SCALED_SQL} AS ch0 FROM m)"))
def rolling_wide_levels(spark, sf_dir):
    """Wide frames of many functions: each value depends on its own frame only, whatever lies beside it."""
    specs = [RollingSpec("ch0", f, window=60, min_periods=5, name=f"y_{f}") for f in LEVELS]
    out = rolling(measurements(spark, sf_dir).select("id", "time", F.expr(SCALED).alias("ch0")), specs)
    for f in LEVELS:
        out = rounded(out, level_digits(f), f"y_{f}")
    return out.select("id", "time", *[s.column for s in specs])


ROLLED = ["sum", "mean", "median", "min", "max", "std", "skew", "kurt", "sem", "rank", "count"]


def many(spark, sf_dir, funcs, window, max_rows=None):
    specs = [RollingSpec("ch0", f, window=window, min_periods=3, name=f"y_{f}") for f in funcs]
    kw = {} if max_rows is None else {"max_rows": max_rows}
    out = rolling(measurements(spark, sf_dir).select("id", "time", "ch0"), specs, **kw)
    return out.select("id", "time", *[neat(F.col(s.column), DIGITS[s.func]).alias(s.column) for s in specs])


def many_sql(funcs, over):
    columns = [
        least_sql(frame_sql(f, over), over, 3, DIGITS[f], "count(*)" if f == "count" else "count(ch0)")
        + f" AS y_{f}" for f in funcs
    ]
    return with_m(f"SELECT id, time, {', '.join(columns)} FROM m")


@query("rolling_blocked", many_sql(ROLLED, ROLL))
def rolling_blocked(spark, sf_dir):
    """All functions over series cut into pieces with a halo."""
    return many(spark, sf_dir, ROLLED, 10, BLOCK_ROWS)


for _func, _spec in (("median", {"func": "median"}), ("quantile", {"quantile": 0.9}), ("rank", {"func": "rank"})):
    _value = f"quantile_cont(ch0, 0.9) OVER {GROW}" if _func == "quantile" else frame_sql(_func, GROW)
    query(f"expanding_{_func}_blocked", with_m(f"SELECT id, time, {least_sql(_value, GROW, 3, 6)} AS y FROM m"))(
        lambda spark, sf_dir, spec=_spec: feature(
            spark, sf_dir, RollingSpec("ch0", min_periods=3, name="y", **spec), max_rows=BLOCK_ROWS))

GROWN = ["sum", "mean", "min", "max", "std", "var", "count", "sem", "skew", "kurt"]


@query("expanding", many_sql([*GROWN, "median", "rank"], GROW))
def expanding(spark, sf_dir):
    return many(spark, sf_dir, [*GROWN, "median", "rank"], None)


@query("expanding_blocked", many_sql(GROWN, GROW))
def expanding_blocked(spark, sf_dir):
    """The functions that add up, from running totals over blocks."""
    return many(spark, sf_dir, GROWN, None, BLOCK_ROWS)


@query("expanding_quantile", with_m(
    f"SELECT id, time, {least_sql(f'quantile_cont(ch0, 0.9) OVER {GROW}', GROW, 1, 6)} AS y FROM m"))
def expanding_quantile(spark, sf_dir):
    return feature(spark, sf_dir, RollingSpec("ch0", quantile=0.9, name="y"))


_FIVE = "(PARTITION BY id ORDER BY time ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"


@query("min_periods", with_m(
    f"SELECT id, time, {least_sql(f'avg(ch0) OVER {_FIVE}', _FIVE, 5, 6)} AS whole, "
    f"{least_sql(f'avg(ch0) OVER {_FIVE}', _FIVE, 1, 6)} AS some FROM m"))
def min_periods(spark, sf_dir):
    return feature(spark, sf_dir, RollingSpec("ch0", "mean", window=5, name="whole"),
                   RollingSpec("ch0", "mean", window=5, min_periods=1, name="some"))


_MATCH = "(PARTITION BY id, kind = 'view' ORDER BY time ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
_FILTERED = f"f AS (SELECT id, time, CASE WHEN kind = 'view' THEN avg(ch0) OVER {_MATCH} END AS y FROM m)"


def filtered(spark, sf_dir, n, max_rows=None):
    spec = RollingSpec("ch0", "mean", window=3, min_periods=1, filter_column="kind", filter_value="view",
                       shift=n, name="y")
    return feature(spark, sf_dir, spec, max_rows=max_rows)


@query("filtered_rolling", with_m("SELECT id, time, round(y, 6) + 0.0 AS y FROM f", _FILTERED))
def filtered_rolling(spark, sf_dir):
    return filtered(spark, sf_dir, 0)


_SHIFTED = with_m("SELECT id, time, round(lag(y, 2) OVER (PARTITION BY id ORDER BY time), 6) + 0.0 AS y FROM f",
                  _FILTERED)


@query("filtered_rolling_shift", _SHIFTED)
def filtered_rolling_shift(spark, sf_dir):
    return filtered(spark, sf_dir, 2)


@query("filtered_rolling_shift_blocked", _SHIFTED)
def filtered_rolling_shift_blocked(spark, sf_dir):
    return filtered(spark, sf_dir, 2, BLOCK_ROWS)


@query("shift", with_m("""
    SELECT id, time, lead(ch0, 3) OVER (PARTITION BY id ORDER BY time) AS ch0,
           lag(ch1, 1) OVER (PARTITION BY id ORDER BY time) AS ch1 FROM m"""))
def shifted(spark, sf_dir):
    return shift(measurements(spark, sf_dir).select("id", "time", "ch0", "ch1"), {"ch0": -3, "ch1": 1})


def bounded_sql(name: str, first: int, last: int) -> str:
    ends = [f"{abs(e)} {'PRECEDING' if e < 0 else 'FOLLOWING'}" if e else "CURRENT ROW" for e in (first, last)]
    over = f"(PARTITION BY id ORDER BY time ROWS BETWEEN {ends[0]} AND {ends[1]})"
    return f"{least_sql(f'sum(ch0) OVER {over}', over, 1, 6)} AS {name}"


@query("frame_center", with_m(
    f"SELECT id, time, {bounded_sql('w4', -2, 1)}, {bounded_sql('w5', -2, 2)} FROM m"))
def frame_center(spark, sf_dir):
    return feature(spark, sf_dir, *[
        RollingSpec("ch0", "sum", window=w, min_periods=1, center=True, name=f"w{w}") for w in (4, 5)])


_CLOSED = {"right": (-3, 0), "left": (-4, -1), "both": (-4, 0), "neither": (-3, -1)}


@query("frame_closed", with_m("SELECT id, time, " + ", ".join(
    bounded_sql(f"y_{c}", *ends) for c, ends in _CLOSED.items()) + " FROM m"))
def frame_closed(spark, sf_dir):
    return feature(spark, sf_dir, *[
        RollingSpec("ch0", "sum", window=4, min_periods=1, closed=c, name=f"y_{c}") for c in _CLOSED])


#: A function that Spark does not have, as states that merge.
SPREAD = Mergeable("spread", lambda x: {"lo": x, "hi": x},
                   lambda a, b: {"lo": np.minimum(a["lo"], b["lo"]), "hi": np.maximum(a["hi"], b["hi"])}, lambda s: s["hi"] - s["lo"])
#: The sum of steps between neighbouring known values: depends on their order.
PATH = Mergeable("path", lambda x: {"first": x, "last": x, "way": 0 * x},
                 lambda a, b: {"first": a["first"], "last": b["last"], "way": a["way"] + b["way"] + np.abs(b["first"] - a["last"])},
                 lambda s: s["way"])


def spread_sql(over: str) -> str:
    return least_sql(f"max(ch0) OVER {over} - min(ch0) OVER {over}", over, 3, 6)


@query("rolling_udaf", with_m(f"SELECT id, time, {spread_sql(ROLL)} AS y FROM m"))
def rolling_udaf(spark, sf_dir):
    return feature(spark, sf_dir, RollingSpec("ch0", SPREAD, window=10, min_periods=3, name="y"))


def _series_spread(v: pd.Series) -> float:
    return float(v.max() - v.min())


@query("rolling_udaf_series", with_m(f"SELECT id, time, {spread_sql(ROLL)} AS y FROM m"))
def rolling_udaf_series(spark, sf_dir):
    """Any function of a pandas Series, called for each frame."""
    return feature(spark, sf_dir, RollingSpec("ch0", _series_spread, window=10, min_periods=3, name="y"))


_PATHS = with_m(f"""SELECT id, time, {spread_sql(GROW)} AS spread,
           round(CASE WHEN count(ch0) OVER {GROW} >= 2 THEN coalesce(sum(step) OVER {GROW}, 0) END, 6) + 0.0 AS way FROM s""",
    """s AS (SELECT m.id, m.time, m.ch0, k.step FROM m LEFT JOIN (
               SELECT id, time, abs(ch0 - lag(ch0) OVER (PARTITION BY id ORDER BY time)) AS step FROM m WHERE ch0 IS NOT NULL) k
           ON k.id = m.id AND k.time = m.time)""")


def _grown(spark, sf_dir, max_rows=None):
    return feature(spark, sf_dir, RollingSpec("ch0", SPREAD, min_periods=3, name="spread"),
                   RollingSpec("ch0", PATH, min_periods=2, name="way"), max_rows=max_rows)


@query("expanding_udaf", _PATHS)
def expanding_udaf(spark, sf_dir):
    """Custom functions of all earlier rows."""
    return _grown(spark, sf_dir)


@query("expanding_udaf_blocked", _PATHS)
def expanding_udaf_blocked(spark, sf_dir):
    """The same over blocks that are summed up by their states."""
    return _grown(spark, sf_dir, BLOCK_ROWS)


_HANN = """
    p AS (SELECT id, time, ch0, row_number() OVER (PARTITION BY id ORDER BY time) AS k FROM m),
    w AS (SELECT a.id, a.time, b.ch0 AS x, 0.5 - 0.5 * cos(2 * pi() * (999 - (a.k - b.k)) / 999) AS w
          FROM p a JOIN p b ON a.id = b.id AND b.k BETWEEN a.k - 999 AND a.k),
    t AS (SELECT id, time, sum(w * x) / nullif(sum(w) FILTER (WHERE x IS NOT NULL), 0) AS mean FROM w GROUP BY ALL),
    v AS (SELECT w.id, w.time, count(x) AS held, any_value(mean) AS mean,
                 sqrt(sum(w * (x - mean) ** 2) * 1000 / (999 * sum(w) FILTER (WHERE x IS NOT NULL))) AS std
          FROM w JOIN t ON t.id = w.id AND t.time = w.time GROUP BY ALL)"""


@query("rolling_weighted_wide", with_m("""
    SELECT id, time, CASE WHEN held >= 3 THEN round(mean, 5) + 0.0 END AS mean, CASE WHEN held >= 3 THEN round(std, 5) + 0.0 END AS std
    FROM v""", _HANN.strip()))
def rolling_weighted_wide(spark, sf_dir):
    """Weights of a thousand rows, by convolution."""
    return feature(spark, sf_dir, *[RollingSpec("ch0", f, window=1000, min_periods=3, win_type="hann", name=f) for f in ("mean", "std")],
                   digits=5)


@query("rolling_very_wide", with_m("SELECT id, time, " + ", ".join(
    least_sql(frame_sql(f, GROW), GROW, 3, DIGITS[f]) + f" AS {f}" for f in ("sum", "std", "max")) + " FROM m"))
def rolling_very_wide(spark, sf_dir):
    """Frames of 50,000 rows, more than any series here has."""
    specs = [RollingSpec("ch0", f, window=50_000, min_periods=3, name=f) for f in ("sum", "std", "max")]
    return feature(spark, sf_dir, *specs, digits=6)


_BY = "OVER (PARTITION BY id ORDER BY time)"
_TERMS = [(f"lag(ch0, {4 - i}) {_BY}", w) for i, w in enumerate(["1/3.0", "2/3.0", "1.0", "2/3.0", "1/3.0"])]
_TOTAL = " + ".join(f"coalesce({v} * {w}, 0)" for v, w in _TERMS)
_MASS = " + ".join(f"CASE WHEN {v} IS NULL THEN 0 ELSE {w} END" for v, w in _TERMS)


@query("rolling_weighted", with_m(
    f"SELECT id, time, {least_sql(_TOTAL, _FIVE, 2, 5)} AS total, "
    f"{least_sql(f'({_TOTAL}) / nullif({_MASS}, 0)', _FIVE, 2, 5)} AS mean FROM m"))
def rolling_weighted(spark, sf_dir):
    return feature(spark, sf_dir, *[
        RollingSpec("ch0", f, window=5, min_periods=2, win_type="triang", name=n)
        for f, n in (("sum", "total"), ("mean", "mean"))], digits=5)


@query("diff", with_m(
    "SELECT id, time, round(value - lag(value) OVER (PARTITION BY id ORDER BY time), 6) + 0.0 AS d FROM m"))
def row_difference(spark, sf_dir):
    out = diff(measurements(spark, sf_dir).select("id", "time", "value"), "value", "d")
    return rounded(out.select("id", "time", "d"), 6, "d")


# ---------------------------------------------------------------- time series

_GAPS = """gaps AS (SELECT id, epoch_us(time) - lag(epoch_us(time)) OVER (PARTITION BY id ORDER BY time) AS d FROM m)"""


@query("common_timestep", with_m("""
    SELECT CAST(trunc(d / 1e6) AS BIGINT) AS time_step FROM counts ORDER BY n DESC, d LIMIT 1""",
    _GAPS, "counts AS (SELECT d, count(*) AS n FROM gaps WHERE d IS NOT NULL GROUP BY d)"))
def common_step(spark, sf_dir):
    return resample.common_timestep(measurements(spark, sf_dir).select("id", "time"))


@query("common_timestep_per_series", with_m("""
    SELECT id, CAST(trunc(d / 1e6) AS BIGINT) AS time_step FROM counts
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, d) = 1""",
    _GAPS, "counts AS (SELECT id, d, count(*) AS n FROM gaps WHERE d IS NOT NULL GROUP BY id, d)"))
def common_step_per_series(spark, sf_dir):
    return resample.common_timestep(measurements(spark, sf_dir).select("id", "time"), per_series=True)


def resample_sql(step: int) -> str:
    return with_m("""
    SELECT g.id, make_timestamp(CAST(g.day + g.b * s.step AS BIGINT)) AS time,
           round(v.ch0, 6) + 0.0 AS ch0, round(v.ch1, 6) + 0.0 AS ch1
    FROM grid g LEFT JOIN v ON g.id = v.id AND g.b = v.b, s""",
        f"s AS (SELECT CAST({step} AS BIGINT) * 1000000 AS step)",
        "t AS (SELECT *, epoch_us(time) AS us FROM m)",
        """days AS (SELECT id, min(us) // 86400000000 * 86400000000 AS day, min(us) AS lo, max(us) AS hi
                    FROM t GROUP BY id)""",
        """v AS (SELECT t.id, (us - day) // step AS b, avg(ch0) AS ch0, avg(ch1) AS ch1
                 FROM t JOIN days USING (id), s GROUP BY ALL)""",
        "grid AS (SELECT id, day, unnest(range((lo - day) // step, (hi - day) // step + 1)) AS b FROM days, s)")


def resampled(spark, sf_dir, step):
    rows = measurements(spark, sf_dir).select("id", "time", "ch0", "ch1")
    return rounded(resample.resample_mean(rows, step), 6, "ch0", "ch1")


@query("resample_mean", resample_sql(7000))
def resample_odd_step(spark, sf_dir):
    return resampled(spark, sf_dir, 7000)


@query("resample_mean_hourly", resample_sql(3600))
def resample_hourly(spark, sf_dir):
    return resampled(spark, sf_dir, 3600)


# The low-pass written out as a circular convolution with its kernel.
_FFT_SQL = with_m("""
    SELECT a.id, a.time, round(CAST(CAST(sum(b.value * CASE WHEN a.i = b.i THEN (2 * a.k + 1) / CAST(a.n AS DOUBLE)
             ELSE sin(pi() * (2 * a.k + 1) * (a.i - b.i) / a.n) / (a.n * sin(pi() * (a.i - b.i) / a.n)) END)
             AS FLOAT) AS DOUBLE), 3) + 0.0 AS y
    FROM p a JOIN p b ON a.id = b.id GROUP BY a.id, a.time""",
    """o AS (SELECT id, time, value, row_number() OVER (PARTITION BY id ORDER BY time) - 1 AS i,
                    count(*) OVER (PARTITION BY id) AS n FROM m)""",
    "p AS (SELECT *, floor(20001.0 * n * 0.00001) AS k FROM o)")


def low_passed(spark, sf_dir, **settings):
    rows = measurements(spark, sf_dir).select("id", "time", "value")
    out = signal.fft_denoise(rows, "value", "y", 20_001.0, **settings)
    return rounded(out.select("id", "time", "y"), 3, "y")


@query("fft_denoise", _FFT_SQL)
def fft_denoise(spark, sf_dir):
    return low_passed(spark, sf_dir)


@query("fft_denoise_spread", _FFT_SQL)
def fft_denoise_spread(spark, sf_dir):
    """Each series as a matrix whose rows and columns are transformed by different tasks."""
    return low_passed(spark, sf_dir, max_rows=BLOCK_ROWS)


# The periodic filter bank on lists: down to the depth of each series, threshold, and up again. Filters are given as text.
_DB4 = [-0.010597401784997278, 0.032883011666982945, 0.030841381835986965, -0.18703481171888114,
        -0.02798376941698385, 0.6308807679295904, 0.7148465705525415, 0.23037781330885523]
_HAAR = ["sqrt(0.5)", "sqrt(0.5)"]
_DB2 = ["(1 - sqrt(3)) / sqrt(32)", "(3 - sqrt(3)) / sqrt(32)", "(3 + sqrt(3)) / sqrt(32)", "(1 + sqrt(3)) / sqrt(32)"]


def wavelet_sql(taps: list) -> str:
    """Denoising by a filter, given from its last tap on."""
    n = len(taps)
    low = f"[{', '.join(str(v) for v in reversed(taps))}]"
    high = f"[{', '.join(f'{(-1) ** k} * ({v})' for k, v in enumerate(taps))}]"

    def down(filter_sql: str) -> str:
        return (f"list_transform(range(len(e) // 2), lambda i: list_sum(list_transform(range({n}), "
                f"lambda k: {filter_sql}[k + 1] * e[(2 * i + k) % len(e) + 1])))")

    up = f"""list_transform(range(2 * len(d)), lambda p: list_sum(list_transform(range({n // 2}), lambda j:
        {low}[p % 2 + 2 * j + 1] * a[((p - p % 2) // 2 - j + {n} * len(d)) % len(d) + 1] +
        {high}[p % 2 + 2 * j + 1] * d[((p - p % 2) // 2 - j + {n} * len(d)) % len(d) + 1])))"""
    return with_m("""
        SELECT id, unnest(times) AS time, round(CAST(CAST(unnest(a) AS FLOAT) AS DOUBLE), 3) + 0.0 AS y
        FROM up JOIN series USING (id) WHERE lvl = 0""",
        f"""series AS (SELECT id, list(value ORDER BY time) AS x, list(time ORDER BY time) AS times, count(*) AS n,
                              CAST(floor(log2(count(*) / {n - 1}.0)) AS BIGINT) AS depth FROM m GROUP BY id)""",
        f"""down AS (SELECT id, CAST(0 AS BIGINT) AS lvl, depth, x AS a, CAST([] AS DOUBLE[]) AS d, n FROM series
                     UNION ALL
                     SELECT id, lvl + 1, depth, {down(low)}, {down(high)}, len(a0)
                     FROM (SELECT id, lvl, depth, a AS a0,
                                  CASE WHEN len(a) % 2 = 1 THEN list_append(a, a[len(a)]) ELSE a END AS e
                           FROM down WHERE lvl < depth))""",
        """noise AS (SELECT id, list_avg(list_transform(d, lambda v: abs(v - list_avg(d)))) / 0.6745 AS sigma
                     FROM down WHERE lvl = 1)""",
        """cleaned AS (SELECT down.id, lvl, down.n,
                              list_transform(d, lambda v: CASE WHEN abs(v) < sigma * sqrt(2 * ln(series.n)) THEN 0.0 ELSE v END) AS d
                       FROM down JOIN noise ON noise.id = down.id JOIN series ON series.id = down.id)""",
        f"""up AS (SELECT id, lvl, a FROM down WHERE lvl = depth
                   UNION ALL
                   SELECT id, lvl - 1, list_slice({up}, 1, n)
                   FROM (SELECT up.id, up.lvl, up.a, c.d, c.n FROM up JOIN cleaned c ON c.id = up.id AND c.lvl = up.lvl
                         WHERE up.lvl > 0))""").replace("WITH", "WITH RECURSIVE", 1)


def wavelet_denoised(spark, sf_dir, **settings):
    rows = measurements(spark, sf_dir).select("id", "time", "value")
    return rounded(signal.wavelet_denoise(rows, "value", "y", **settings).drop("value"), 3, "y")


@query("wavelet_denoise", wavelet_sql(_DB4))
def wavelet_denoise(spark, sf_dir):
    return wavelet_denoised(spark, sf_dir)


@query("wavelet_denoise_spread", wavelet_sql(_DB4))
def wavelet_denoise_spread(spark, sf_dir):
    return wavelet_denoised(spark, sf_dir, max_rows=BLOCK_ROWS)


@query("wavelet_denoise_haar", wavelet_sql(_HAAR))
def wavelet_denoise_haar(spark, sf_dir):
    return wavelet_denoised(spark, sf_dir, wavelet="haar")


@query("wavelet_denoise_haar_spread", wavelet_sql(_HAAR))
def wavelet_denoise_haar_spread(spark, sf_dir):
    return wavelet_denoised(spark, sf_dir, wavelet="haar", max_rows=BLOCK_ROWS)


@query("wavelet_denoise_db2", wavelet_sql(_DB2))
def wavelet_denoise_db2(spark, sf_dir):
    return wavelet_denoised(spark, sf_dir, wavelet="db2")


@query("wavelet_denoise_db2_spread", wavelet_sql(_DB2))
def wavelet_denoise_db2_spread(spark, sf_dir):
    return wavelet_denoised(spark, sf_dir, wavelet="db2", max_rows=BLOCK_ROWS)
