"""Dictionary codes, ordered target statistics, saved feature pipelines, sampled ids."""

import hashlib
import random
import subprocess
import sys

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from seriesmill.operators import categories, split
from seriesmill.operators.mergeable import Mergeable
from seriesmill.operators.windows import RollingSpec
from seriesmill.plans import preparation


def test_codes_and_back(spark):
    rows = [(k, v, "t" + str(k)) for k, v in enumerate(["b", "a", None, "b", "", "é", "a"])]
    df = spark.createDataFrame(rows, "k int, v string, w string")
    coded, tables = categories.encode_categories(df, most=5)
    assert set(tables) == {"v"} and coded.columns == df.columns and dict(coded.dtypes) == {"k": "int", "v": "tinyint", "w": "string"}
    order = {v: n for n, v in enumerate(sorted({v for _, v, _ in rows if v is not None}))}
    assert sorted((r["k"], r["v"]) for r in coded.collect()) == [(k, order.get(v)) for k, v, _ in rows]
    assert sorted(map(tuple, categories.decode_categories(coded, tables).collect())) == sorted(rows, key=lambda r: r[0])
    unknown = coded.withColumn("v", F.lit(99).cast("tinyint"))
    assert {r["v"] for r in categories.decode_categories(unknown, tables).collect()} == {None}


@pytest.mark.parametrize("max_rows", [1_000_000, 20])
def test_rates_see_earlier_rows_only(spark, max_rows):
    """Two thirds of the rows in one category, missing categories, one that training does not have."""
    rng = random.Random(4)
    rows = [(k, rng.choice(["hot", "hot", "hot", "hot", "a", None]), rng.randint(0, 1)) for k in range(200)]
    df = spark.createDataFrame(rows, "id long, kind string, target int").repartition(4)
    train, rates = categories.ordered_rates(df, ["kind"], keys=["id"], weight=2.0, max_rows=max_rows)
    prior = sum(y for *_, y in rows) / len(rows)
    seen, want = {}, {}
    for k, kind, y in sorted(rows, key=lambda r: hashlib.md5(f"42:{r[0]}".encode()).hexdigest()):
        total, n = seen.get(kind, (0, 0))
        want[k] = (total + 2 * prior) / (n + 2)
        seen[kind] = total + y, n + 1
    assert {r["id"]: round(r["kind_rate"], 9) for r in train.collect()} == {k: round(v, 9) for k, v in want.items()}
    assert train.columns == [*df.columns, "kind_rate"]
    asked = spark.createDataFrame([(1, "hot"), (2, None), (3, "new")], "id long, kind string")
    scored = {r["id"]: r["kind_rate"] for r in rates.attach(asked).collect()}
    of = lambda kind: (seen[kind][0] + 2 * prior) / (seen[kind][1] + 2)
    assert scored == pytest.approx({1: of("hot"), 2: of(None), 3: prior})


def test_own_label_is_not_in_the_rate(spark):
    """Changing a row's label leaves its own rate but for the mean of all."""
    rows = [(k, "x", k % 2) for k in range(40)]
    one = categories.ordered_rates(spark.createDataFrame(rows, "id long, kind string, target int"), ["kind"], keys=["id"], weight=0.0)[0]
    rows[7] = (7, "x", 0)
    two = categories.ordered_rates(spark.createDataFrame(rows, "id long, kind string, target int"), ["kind"], keys=["id"], weight=0.0)[0]
    at = lambda df: {r["id"]: r["kind_rate"] for r in df.collect()}[7]
    assert at(one) == at(two)


def test_rates_of_nothing(spark):
    train, rates = categories.ordered_rates(spark.createDataFrame([], "id long, kind string, target int"), ["kind"], keys=["id"])
    assert train.count() == 0
    assert [r["kind_rate"] for r in rates.attach(spark.createDataFrame([(1, "a")], "id long, kind string")).collect()] == [0.0]


def test_sampled_ids_by_any_way(spark, monkeypatch):
    """Sorted at once or found by counting prefixes; the rows' own hash tells the same ids."""
    df = spark.range(500).select((F.col("id") % 90).alias("id"))
    order = sorted(range(90), key=lambda k: hashlib.md5(f"42:{k}".encode()).hexdigest())
    for few in (100_000, 3):
        monkeypatch.setattr(split, "FEW_IDS", few)
        for n in (0, 1, 17, 90, 200):
            want = set(order[:n])
            assert {r["id"] for r in split.sample_ids(df, n).collect()} == want
            marked = split.group_holdout(df, n)
            assert {r["id"] for r in marked.where("split = 'test'").collect()} == want and marked.count() == 500
    missing = spark.createDataFrame([(None,), (1,)], "id long")
    assert {r["id"]: r["split"] for r in split.group_holdout(missing, 5).collect()} == {None: "train", 1: "test"}


SPREAD = Mergeable("spread", lambda x: {"lo": x, "hi": x}, lambda a, b: {"lo": a["lo"], "hi": b["hi"]}, lambda s: s["hi"] - s["lo"])


def test_saved_pipeline(spark, series_df, tmp_path):
    specs = [RollingSpec("x", "mean", window=5, min_periods=2), RollingSpec("x", quantile=0.9, window=4, min_periods=1, filter_column="kind", filter_value="u")]
    model = preparation.feature_pipeline(specs).fit(series_df)
    model.write().overwrite().save(f"{tmp_path}/model")
    want = model.transform(series_df)
    loaded = PipelineModel.load(f"{tmp_path}/model")
    assert [s.uid for s in loaded.stages] == [s.uid for s in model.stages]
    assert sorted(map(str, loaded.transform(series_df).collect())) == sorted(map(str, want.collect()))
    series_df.write.parquet(f"{tmp_path}/rows")
    code = f"""
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
from pyspark.ml import PipelineModel
PipelineModel.load("{tmp_path}/model").transform(spark.read.parquet("{tmp_path}/rows")).write.parquet("{tmp_path}/out")
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, cwd=preparation.__file__.rsplit("/seriesmill/", 1)[0])
    assert sorted(map(str, spark.read.parquet(f"{tmp_path}/out").collect())) == sorted(map(str, want.collect()))


def test_functions_are_saved_by_name(spark, series_df, tmp_path, monkeypatch):
    monkeypatch.setattr(preparation, "CUSTOM", {})
    pipeline = preparation.feature_pipeline([RollingSpec("x", SPREAD, window=5, min_periods=2, name="s")])
    with pytest.raises(ValueError, match="registered by name"):
        pipeline.write().overwrite().save(f"{tmp_path}/p")
    preparation.register("spread", SPREAD)
    pipeline.write().overwrite().save(f"{tmp_path}/p")
    loaded = type(pipeline).load(f"{tmp_path}/p")
    assert loaded.getStages()[1].settings["specs"][0].func is SPREAD
    preparation.CUSTOM.clear()
    with pytest.raises(KeyError, match="not registered"):
        type(pipeline).load(f"{tmp_path}/p")
    step = preparation.Step("cast_declared", types={"x": "float"}, narrow=False)
    step.write().overwrite().save(f"{tmp_path}/s")
    assert dict(preparation.Step.load(f"{tmp_path}/s").transform(series_df).dtypes)["x"] == "float"
