"""Denoising: whole series against numpy, spread series against whole ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.operators.signal import (
    analyse, depth, fft_denoise, hard_threshold, kept_bins, synthesise, wavelet_array, wavelet_denoise,
)
from seriesmill.operators.wavelets import names, wavelet


@pytest.fixture(scope="module")
def signals(spark):
    rng = np.random.default_rng(3)
    rows = []
    for name, n in (("tiny", 7), ("short", 60), ("odd", 301), ("even", 512), ("prime", 997)):
        x = 40 * np.sin(np.arange(n) / 9.0) + rng.normal(0, 4, n)
        rows += [(name, float(i) ** 1.3, float(v)) for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "id string, time double, x double").repartition(6).cache()


def by_id(df, column):
    pdf = df.toPandas().sort_values(["id", "time"])
    return {k: (g["x"].to_numpy(), g[column].to_numpy()) for k, g in pdf.groupby("id")}


def naive_low_pass(x, threshold):
    n = len(x)
    k = np.arange(n)
    bins = np.exp(-2j * np.pi * np.outer(k, k) / n) @ x
    frequency = np.minimum(k, n - k) / (n * 1e-5)
    bins[frequency > threshold] = 0
    return (np.exp(2j * np.pi * np.outer(k, k) / n) @ bins).real / n


@pytest.mark.parametrize("max_rows", [10_000, 64])
@pytest.mark.parametrize("threshold", [2_000.0, 21_000.0])
def test_low_pass(signals, threshold, max_rows):
    out = by_id(fft_denoise(signals, "x", "y", threshold, max_rows=max_rows), "y")
    assert {k: len(v[0]) for k, v in out.items()} == {"tiny": 7, "short": 60, "odd": 301, "even": 512, "prime": 997}
    for x, y in out.values():
        np.testing.assert_allclose(y, naive_low_pass(x, threshold), atol=1e-4)


def test_low_pass_keeps_all_by_default(signals):
    for x, y in by_id(fft_denoise(signals, "x", "y"), "y").values():
        np.testing.assert_allclose(y, x, rtol=1e-6)


def test_kept_bins_match_the_frequency_grid():
    for n in (7, 64, 101):
        grid = np.fft.rfftfreq(n, d=1e-5)
        for t in (0.0, grid[1], grid[2] + 1, 1e8):
            assert kept_bins(n, t) == (grid <= t).sum() - 1


# Published low-pass analysis filters, first taps.
PUBLISHED = {
    "haar": [0.7071067811865476],
    "db2": [-0.12940952255126037, 0.2241438680420134, 0.8365163037378079],
    "db4": [-0.010597401784997278, 0.032883011666982945, 0.030841381835986965, -0.18703481171888114],
    "sym2": [-0.12940952255126037, 0.2241438680420134, 0.8365163037378079],
    "sym4": [-0.0757657147893567, -0.02963552764596039, 0.4976186676325629, 0.803738751805386],
    "sym5": [0.027333068345077982, 0.029519490925774643, -0.039134249302383094, 0.1993975339773936],
    "sym6": [0.015404109327027373, 0.0034907120842174702, -0.11799011114819057],
    "sym7": [0.002681814568257878, -0.0010473848886829163, -0.01263630340325193],
    "sym8": [-0.0033824159510061256, -0.0005421323317911481, 0.03169508781149298],
}


@pytest.mark.parametrize("name", sorted(PUBLISHED))
def test_filters_are_the_published_ones(name):
    np.testing.assert_allclose(wavelet(name).low[::-1][:len(PUBLISHED[name])], PUBLISHED[name], atol=1e-10)


def test_unknown_wavelets_are_an_error(signals):
    for name in ("db0", "db11", "sym1", "sym9", "coif1", ""):
        with pytest.raises(ValueError, match="no wavelet"):
            wavelet_denoise(signals, "x", wavelet=name)


@pytest.mark.parametrize("name", names())
def test_filter_bank_is_orthogonal(name):
    bank = wavelet(name)
    h = bank.low
    moments = bank.taps // 2
    assert np.isclose(h.sum(), np.sqrt(2)) and np.isclose(h @ h, 1)
    assert all(abs(h[2 * k:] @ h[:len(h) - 2 * k]) < 1e-9 for k in range(1, moments))
    # The high-pass filter has no answer to polynomials below its number of vanishing moments.
    x = np.arange(bank.taps) / bank.taps
    assert all(abs(bank.high @ x**k) < 1e-7 for k in range(moments))
    rng = np.random.default_rng(1)
    for n in (8, 63, 64, 101, 1000):
        x = rng.normal(size=n)
        a, d = analyse(x, bank)
        assert len(a) == (n + 1) // 2
        np.testing.assert_allclose(synthesise(a, d, n, bank), x, atol=1e-9)
        np.testing.assert_allclose(hard_threshold(x, depth(n, bank), 0.0, bank), x, atol=1e-8)
    x = rng.normal(size=64)
    a, d = analyse(x, bank)
    assert np.isclose(a @ a + d @ d, x @ x)


@pytest.mark.parametrize("name", ["haar", "db2", "db10", "sym8"])
def test_any_wavelet_spread(signals, name):
    out = by_id(wavelet_denoise(signals, "x", "y", max_rows=41, wavelet=name), "y")
    assert len(out) == 5
    for x, y in out.values():
        np.testing.assert_allclose(y, wavelet_array(x, 1, name), atol=1e-4)


@pytest.mark.parametrize("level", [1, 2, 4])
@pytest.mark.parametrize("max_rows", [10_000, 100, 41])
def test_wavelet(signals, level, max_rows):
    too_short = {1: [], 2: ["tiny"], 4: ["tiny", "short"]}[level]
    long_enough = signals.where(~F.col("id").isin(too_short))
    out = by_id(wavelet_denoise(long_enough, "x", "y", level, max_rows=max_rows), "y")
    for x, y in out.values():
        np.testing.assert_allclose(y, wavelet_array(x, level), atol=1e-4)
    if level == 1:
        x, y = out["tiny"]
        np.testing.assert_allclose(y, x, rtol=1e-6)
        x, y = out["prime"]
        truth = 40 * np.sin(np.arange(997) / 9.0)
        assert np.mean((y - truth) ** 2) < np.mean((x - truth) ** 2)


@pytest.mark.parametrize("bad", [None, float("nan"), float("inf")])
def test_a_sample_without_value_is_an_error(spark, bad):
    df = spark.createDataFrame([("a", float(k), bad if k == 7 else 1.0) for k in range(40)], "id string, time double, x double")
    for denoise in (lambda d: fft_denoise(d, "x", "y", 20_001.0), lambda d: wavelet_denoise(d, "x", "y")):
        with pytest.raises(Exception, match="fill them first"):
            denoise(df).collect()
