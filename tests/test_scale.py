"""What grows with the input stays out of single tasks, the driver and calls of Python per group."""

import contextlib
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from seriesmill.operators import blocks, kernels
from seriesmill.operators.resample import resample_mean
from seriesmill.operators.signal import fft_denoise, wavelet_denoise
from seriesmill.operators.windows import RollingSpec, rolling


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture(scope="module")
def samples(spark):
    rows = [(k, float(i), float((i * 7 + k) % 13)) for k in range(3) for i in range(70 + k)]
    return spark.createDataFrame(rows, "id long, time double, x double")


def test_tables_of_many_blocks_do_not_pass_through_the_driver(spark):
    table = spark.range(10).select("id", F.lit(1).alias("n"))
    assert "BroadcastHashJoin" in plan_of(blocks.lookup(spark.range(5), blocks.hinted(table, 10), ["id"], "left"))
    many = plan_of(blocks.lookup(spark.range(5), blocks.hinted(table, 200_000), ["id"], "left"))
    assert "Broadcast" not in many and "SortMergeJoin" in many


def test_empty_buckets_are_made_after_the_last_aggregate(spark):
    rows = spark.createDataFrame([(1, 0.0, 2.0), (1, 10.0, 4.0), (1, None, 8.0), (None, 3.0, 1.0)], "id long, time double, x double")
    for step in (2, 7000):
        plan = plan_of(resample_mean(rows, step))
        assert plan.index("Generate") < plan.index("Aggregate")
    out = {(r.id, r.time): r.x for r in resample_mean(rows, 2).collect()}
    assert out == {(1, 0.0): 2.0, (1, 2.0): None, (1, 4.0): None, (1, 6.0): None, (1, 8.0): None, (1, 10.0): 4.0,
                   (1, None): 8.0, (None, 2.0): 1.0}


def test_long_gaps_leave_in_chunks(spark, monkeypatch):
    rows = spark.createDataFrame([(1, 0.0, 2.0), (1, 1000.0, 4.0), (1, 1003.0, 5.0)], "id long, time double, x double")
    monkeypatch.setattr("seriesmill.operators.resample.GRID_ROWS", 7)
    out = sorted((r.time, r.x) for r in resample_mean(rows, 1, max_rows=2).collect())
    assert [t for t, _ in out] == [float(t) for t in range(1004)]
    assert {t: x for t, x in out if x is not None} == {0.0: 2.0, 1000.0: 4.0, 1003.0: 5.0}


@pytest.mark.parametrize("make", [
    lambda df: fft_denoise(df, "x", "y", 20_001.0, max_rows=24),
    lambda df: wavelet_denoise(df, "x", "y", max_rows=24, wavelet="haar"),
    lambda df: rolling(df, [RollingSpec("x", "median", min_periods=3, name="y")], max_rows=24),
])
def test_groups_of_long_series_share_calls_of_python(samples, make):
    plan = plan_of(make(samples))
    assert "FlatMapGroups" not in plan and "MapInArrow" in plan


def test_groups_cut_by_batches_are_whole(spark):
    rows = spark.createDataFrame([(f"g{k}", i, float(i)) for k in range(9) for i in range(k + 1)], "g string, i long, x double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        from pyspark.sql import types as T
        fields = [T.StructField("n", T.LongType()), T.StructField("total", T.DoubleType())]
        make = kernels.one_by_one(lambda c: [np.array([len(c["i"])]), np.array([c["x"].sum()])], fields)
        out = {r.g: (r.n, r.total) for r in kernels.over_groups(rows, ["g"], ["i"], ["g"], fields, make).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert out == {f"g{k}": (k + 1, k * (k + 1) / 2) for k in range(9)}


def test_groups_of_a_value_in_most_rows_are_bounded(spark, monkeypatch, tmp_path):
    as_it_is = kernels.one_by_one

    def watched(make, fields):
        def run(group):
            if "__x" in group:
                (tmp_path / f"{len(group['__x']):06d}").touch()
            return make(group)
        return as_it_is(run, fields)

    monkeypatch.setattr(kernels, "one_by_one", watched)
    rows = [("a", float(k), 0.0 if k % 5 < 2 else float(k * 7 % 101)) for k in range(2000)]
    df = spark.createDataFrame(rows, "id string, time double, x double")
    rolling(df, [RollingSpec("x", "median", min_periods=2, name="y")], max_rows=100).collect()
    assert 0 < max(int(f.name) for f in tmp_path.iterdir()) <= 500
