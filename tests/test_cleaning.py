"""Cleaning, columns and scalar functions on hand-made tables."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.scalar import convert, file_stem, map_code, normalize_name, total_seconds
from seriesmill.operators import clean, columns
from seriesmill.plans.preparation import STEPS, Step, build_features, preprocess
from seriesmill.schema import MEASUREMENTS, FillRule, clip_bounds, declared_types, fill_rules

INF, NAN = float("inf"), float("nan")


def values(df, column="x"):
    return [r[column] for r in df.orderBy("id", "time").collect()]


@pytest.fixture(scope="module")
def gaps(spark):
    x = [None, 1.0, None, None, None, 2.0, None]
    return spark.createDataFrame([("a", float(i), v) for i, v in enumerate(x)], "id string, time double, x double")


@pytest.mark.parametrize("max_rows", [1000, 3])
@pytest.mark.parametrize("rule, expected", [
    (FillRule(0.0, "ffill", 2), [0, 1, 0, None, None, 2, None]),
    (FillRule(0.0), [0, 1, 0, 0, 0, 2, 0]),
    (FillRule(method="ffill", limit=2), [None, 1, 1, 1, None, 2, 2]),
    (FillRule(method="bfill", limit=2), [1, 1, None, 2, 2, 2, None]),
    (FillRule(method="ffill"), [None, 1, 1, 1, 1, 2, 2]),
    (FillRule(method="bfill"), [1, 1, 2, 2, 2, 2, None]),
])
def test_fill(gaps, rule, expected, max_rows):
    assert values(clean.fill(gaps, {"x": rule, "absent": rule}, max_rows=max_rows)) == expected


def test_fill_refuses_unknown_methods(gaps):
    with pytest.raises(ValueError):
        clean.fill(gaps, {"x": FillRule(method="nearest")})


def test_fill_stays_inside_a_series(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0), ("b", 0.0, None), ("b", 1.0, 3.0)], "id string, time double, x double")
    assert values(clean.fill(df, {"x": FillRule(method="ffill")})) == [1, None, 3]


@pytest.fixture(scope="module")
def odd(spark):
    x = [INF, -INF, NAN, None, 0.0, -1.0, 1001.0]
    return spark.createDataFrame([("a", float(i), v) for i, v in enumerate(x)], "id string, time double, x double")


def test_clip(odd):
    clipped = clean.clip(clean.nan_to_null(odd), {"x": (0, 1000)})
    assert values(clipped) == [1000, 0, None, None, 0, 0, 1000]
    assert values(clean.clip(clean.nan_to_null(odd), {"x": (None, 5)})) == [5, -INF, None, None, 0, -1, 5]
    assert clean.clip(odd, None).columns == odd.columns


def test_inf_to_null(odd):
    assert values(clean.inf_to_null(clean.nan_to_null(odd))) == [None, None, None, None, 0, -1, 1001]


def test_replace_nonpositive(odd):
    small = pytest.approx(0.01, rel=1e-6)
    df = odd.where("time > 3").withColumn("n", F.col("time").cast("int") - 5)
    out = clean.replace_nonpositive(df)
    assert values(out) == [small, small, 1001] and values(out, "n") == [small, small, 1]
    assert values(clean.replace_nonpositive(odd.where("time = 3"))) == [None]


def test_preprocess_clips_before_infinities_go(spark):
    rows = [("a", 0.0, INF, -INF, 5.0), ("a", 1.0, None, NAN, 2000.0)]
    df = clean.nan_to_null(spark.createDataFrame(rows, "id string, time double, ch0 double, ch1 double, ch2 double"))
    out = preprocess(df)
    assert values(out, "ch0") == [1000, 0] and values(out, "ch1") == [0, 0] and values(out, "ch2") == [5, 1000]
    assert out.schema["ch0"].dataType == T.FloatType()


def test_declared_schema():
    assert clip_bounds() == {c: (0.0, 1000.0) for c in ("ch0", "ch1", "ch2")}
    assert fill_rules()["ch1"] == FillRule(0.0, "ffill", 300)
    assert declared_types()["time"] == T.DoubleType() and MEASUREMENTS["ch2"].metadata["upper"] == 1000


def test_narrow_types(spark):
    df = spark.range(1).select(
        F.lit(126).alias("a"), F.lit(127).alias("b"), F.lit(-128).alias("c"), F.lit(32767).alias("d"),
        F.lit(2**31).cast("long").alias("e"), F.lit(7e4).alias("f"), F.lit(1e39).alias("g"), F.lit("s").alias("h"),
        F.lit(None).cast("long").alias("i"))
    types = dict(columns.narrow_types(df).dtypes)
    assert types == dict(a="tinyint", b="smallint", c="smallint", d="int", e="bigint", f="float", g="double",
                         h="string", i="bigint")


def test_cast_declared(spark):
    df = spark.createDataFrame([("1", 5), ("x", 6)], "a string, b long")
    out = columns.cast_declared(df, {"a": "int", "absent": "int"})
    assert out.dtypes == [("a", "int"), ("b", "tinyint")] and [r["a"] for r in out.collect()] == [1, None]
    assert columns.cast_declared(df, {"a": "int"}, narrow=False).dtypes[1] == ("b", "bigint")


def test_dedupe_columns(spark):
    rows = [(1, None, 9, 7), (2, 3, None, 7), (4, None, None, None), (None, 5, None, None)]
    df = spark.createDataFrame(rows, "a int, b int, c int, d int").toDF("a", "a", "k", "a")
    out = columns.dedupe_columns(df)
    assert out.columns == ["k", "a"] and [r["a"] for r in out.collect()] == [1, 2, 4, None]
    tied = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("a", "k", "a")
    assert columns.dedupe_columns(tied).first().asDict() == {"k": 2, "a": 1}
    assert columns.dedupe_columns(df.toDF("a", "b", "c", "d")).columns == ["a", "b", "c", "d"]


def test_profile(spark, odd):
    rows = {r["column"]: r for r in columns.profile_columns(odd).collect()}
    x = rows["x"]
    assert (x.rows, x.filled, x.n_inf, x.n_nan, x.min_value) == (7, 6, 2, 1, -INF) and math.isnan(x.max_value)
    assert rows["id"].min_value is None and rows["time"].max_value == 6


def test_select_and_drop(odd):
    assert columns.select_columns(odd, ["x", "id"]).columns == ["x", "id"]
    assert columns.drop_columns(odd, ["x", "absent"]).columns == ["id", "time"]
    with pytest.raises(KeyError):
        columns.select_columns(odd, ["absent"])


def test_convert(spark):
    rows = [(1.0, 0.0), (0.0, 0.0), (1.0, 16.0), (3.0, 16.0), (None, 2.0), (1.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double").coalesce(1)

    def run(method):
        return [r[0] for r in convert(df, "a", "b", method, "y").select(F.col("y").cast("double")).collect()]

    def near(v):
        return None if v is None else pytest.approx(v, abs=1e-6)

    # 1/16 and 3/16 are exact halves at the third decimal and go to the even neighbour.
    assert run("divide") == [near(v) for v in (None, None, 0.062, 0.188, None, 0.333)]
    assert run("substract") == run("subtract") == [near(v) for v in (1, 0, -15, -13, None, -2)]
    assert run("normalize") == [near(v) for v in (None, None, -0.938, -0.812, None, -0.667)]
    assert convert(df, "a", "b").columns[-1] == "a_b_divide"
    with pytest.raises(ValueError):
        convert(df, "a", "b", "power")
    with pytest.raises(KeyError):
        convert(df, "a", "absent")


def test_names_and_codes(spark):
    df = spark.createDataFrame([("pipe 7_1.csv", "OD"), ("a.b.gz", None), ("plain", "??")], "f string, t string")
    out = df.select(normalize_name(file_stem(F.col("f"))), map_code(F.col("t"), {"OD": 0, "ID": 1})).collect()
    assert [tuple(r) for r in out] == [("PIPE7_1", 0), ("A.B", None), ("PLAIN", None)]


def test_total_seconds_has_a_fraction(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-03-31 01:00:00' a, timestamp_ntz'2024-03-31 03:00:00.25' b")
    assert df.select(total_seconds(df, "a", "b")).first()[0] == 7200.25


def test_steps(series_df):
    assert {"clip", "rolling", "fft_denoise", "mark_target"} <= STEPS.keys()
    out = Step(lambda df, by: df.withColumn("z", F.col("x") * by), by=2).transform(series_df)
    assert out.columns[-1] == "z"


def test_new_columns_are_reported(series_df):
    from seriesmill.operators.windows import RollingSpec

    out, new = build_features(series_df, [RollingSpec("x", "median", window=5, min_periods=1)])
    assert new == ["x_median_5_1_0"] and out.columns == [*series_df.columns, *new]


def test_stateless_operators_run_on_a_stream(spark, tmp_path):
    """Cleaning without fills is a projection, so a stream takes it too."""
    rows = spark.createDataFrame([("a", INF, 2.0), ("a", -3.0, 0.0)], "id string, x double, y double")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    out = convert(clean.replace_nonpositive(clean.inf_to_null(clean.clip(stream, {"y": (0, 1)}))), "x", "y", name="r")
    run = out.writeStream.format("memory").queryName("cleaned").outputMode("append").start()
    try:
        run.processAllAvailable()
    finally:
        run.stop()
    got = sorted(tuple(r) for r in spark.sql("SELECT cast(round(x * 100) as int), cast(round(y * 100) as int) FROM cleaned").fillna(-1).collect())
    assert got == [(-1, 100), (1, 1)]
