"""Lookups, splits, metrics, resampling, files and training."""

import math
import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from seriesmill.functions import metrics
from seriesmill.operators import lookups, split
from seriesmill.operators.resample import common_timestep, resample_mean
from seriesmill.plans import training
from seriesmill.plans.preparation import plot_series
from seriesmill.schema import LABELS
from seriesmill.sources import files

NEVER, CUT = 10_000, 4


# ---------------------------------------------------------------- lookups

def test_mark_target(spark):
    rows = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("c", 0), ("d", 0)], "id string, t int")
    labels = spark.createDataFrame(
        [("a", "ID", 1), ("a", "OD", 2), ("b", "ID", 1), ("c", "??", 1), ("z", "OD", 1)],
        "id string, target string, at int")
    out = lookups.mark_target(rows, labels, order="at")
    assert sorted(tuple(r) for r in out.select("id", "t", "target").collect()) == [
        ("a", 0, 0), ("a", 1, 0), ("b", 0, 1), ("c", 0, -1), ("d", 0, -1)]


def test_attach_spreads_heavy_keys(spark):
    rows = spark.range(200).select(F.when(F.col("id") < 120, 0).otherwise(F.col("id")).alias("k"), "id")
    table = spark.range(0, 200, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    plain = lookups.attach(rows, table, ["k"])
    heavy = lookups.attach(rows, table, ["k"], max_rows=50, broadcast_rows=3)
    assert sorted(plain.collect(), key=str) == sorted(heavy.collect(), key=str) and heavy.count() == 200
    for how in ("left_semi", "left_anti"):
        assert lookups.attach(rows, table.select("k"), ["k"], how, 50, 3).count() == lookups.attach(
            rows, table.select("k"), ["k"], how).count()


def test_decode_groups_last_name_wins(spark):
    mapping = spark.createDataFrame([("A", [0, 1], 1), ("B", [1, 2], 2)], "name string, group_id array<int>, at int")
    rows = spark.createDataFrame([(0,), (1,), (2,), (3,)], "group_id int")
    out = lookups.decode_groups(rows, mapping, order="at")
    assert dict(tuple(r) for r in out.collect()) == {0: "A", 1: "B", 2: "B", 3: None}


def test_audit(spark):
    ids, done = spark.createDataFrame([("a",), ("b",)], "id string"), spark.createDataFrame([("b",)], "id string")
    assert dict(tuple(r) for r in lookups.audit_missing(ids, done).collect()) == {"a": False, "b": True}
    assert [r[0] for r in lookups.missing_ids(ids, done).collect()] == ["a"]


# ---------------------------------------------------------------- splits

def dealt(sizes, k):
    loads, fold = [0] * k, {}
    for name, n in sorted(sizes.items(), key=lambda s: (-s[1], s[0])):
        f = loads.index(min(loads))
        loads[f] += n
        fold[name] = f
    return fold, loads


def test_rounds_deal_like_one_by_one():
    rng = random.Random(5)
    for _ in range(400):
        k = rng.randint(1, 5)
        loads, singles = [0] * k, [0] * k
        for size in sorted({rng.randint(1, 12) for _ in range(4)}, reverse=True):
            count = rng.randint(1, 30)
            runs = split._rounds(loads, size, count)
            for r in range(count):
                start, stop, turns = next(x for x in runs if x[0] <= r < x[1])
                want = singles.index(min(singles))
                singles[want] += size
                assert turns[(r - start) % len(turns)] == want
            assert loads == singles and runs[-1][1] == count


@pytest.mark.parametrize("max_rows", [NEVER, 3])
def test_kfold(spark, max_rows):
    rng = random.Random(1)
    sizes = {i: s for i, s in enumerate([5, 4, 3, 3, 2, 1])} | {100 + i: rng.randint(1, 3) for i in range(25)}
    rows = spark.createDataFrame([(i,) for i, n in sizes.items() for _ in range(n)], "id long")
    out = split.group_kfold(rows, 3, max_rows=max_rows)
    got = {r["id"]: r["fold"] for r in out.distinct().collect()}
    assert got == dealt(sizes, 3)[0] and out.count() == sum(sizes.values())
    six = rows.where("id < 6")
    assert sorted(r["count"] for r in split.group_kfold(six, 3).groupBy("fold").count().collect()) == [6, 6, 6]
    named = split.group_kfold(rows.select(F.concat(F.lit("p "), "id").alias("id")), 3, max_rows=max_rows)
    loads = [r["count"] for r in named.groupBy("fold").count().collect()]
    assert sorted(loads) == sorted(dealt(sizes, 3)[1])
    assert named.groupBy("id").agg(F.count_distinct("fold").alias("n")).where("n > 1").isEmpty()


def test_holdout_ignores_partitioning(spark):
    df = spark.range(200).select((F.col("id") % 40).alias("id"))
    a = {tuple(r) for r in split.group_holdout(df, 5).collect()}
    b = {tuple(r) for r in split.group_holdout(df.repartition(7), 5).collect()}
    assert a == b and sum(s == "test" for _, s in a) == 5
    assert split.group_holdout(df, test_ids=[]).where("split = 'test'").isEmpty()


@pytest.mark.parametrize("max_rows", [NEVER, 3])
def test_group_ids(spark, max_rows):
    df = spark.createDataFrame([("b 1",), ("B1",), ("a",), ("c",), ("d",), ("a",)], "id string")
    out = split.group_ids(df, max_rows=max_rows)
    assert sorted(tuple(r) for r in out.collect()) == [
        ("B1", 1), ("a", 0), ("a", 0), ("b 1", 1), ("c", 2), ("d", 3)]


# ---------------------------------------------------------------- metrics

def test_regression_metrics(spark):
    rng = np.random.default_rng(2)
    y, p = rng.normal(5, 3, 50), rng.normal(5, 3, 50)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)] + [(None, 1.0)], "y_true double, y_pred double")
    got = metrics.regression_metrics(df).first().asDict()
    want = dict(mse=np.mean((y - p) ** 2), rmse=np.sqrt(np.mean((y - p) ** 2)), mae=np.mean(np.abs(y - p)),
                mape=np.mean(np.abs((y - p) / (y + 1e-6))) * 100, pred_mean=p.mean(), pred_std=p.std(),
                r2=1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    for name, value in want.items():
        assert got[name] == pytest.approx(value)
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 0.0)], "y_true double, y_pred double")
    assert metrics.regression_metrics(flat).first()["r2"] is None


@pytest.mark.parametrize("max_rows", [NEVER, CUT])
def test_reduce(spark, max_rows):
    rows = [(float(i % 7), float(i)) for i in range(40)] + [(None, None)]
    df = spark.createDataFrame(rows, "rmse double, pred_mean double")
    got = metrics.metric_reduce(df, ["rmse", "pred_mean"], max_rows).first()
    assert got["rmse"] == np.median([r[0] for r in rows[:-1]]) and got["pred_mean"] == pytest.approx(19.5)


@pytest.mark.parametrize("max_rows", [NEVER, CUT])
def test_classification(spark, max_rows):
    rng = random.Random(4)
    rows = [(g, int(rng.random() < 0.4), rng.randint(0, 9) / 10) for g in "ab" for _ in range(60)]
    df = spark.createDataFrame(rows, "g string, label int, score double")
    df = df.withColumn("prediction", lookups.threshold(F.col("score")))
    for r in metrics.classification_metrics(df, ["g"], score="score", max_rows=max_rows).collect():
        mine = [(y, s) for g, y, s in rows if g == r["g"]]
        tp = sum(y == 1 and s > 0.5 for y, s in mine)
        fp = sum(y == 0 and s > 0.5 for y, s in mine)
        fn = sum(y == 1 and s <= 0.5 for y, s in mine)
        tn = sum(y == 0 and s <= 0.5 for y, s in mine)
        wins = [1.0 if a > b else 0.5 if a == b else 0.0 for y, a in mine for z, b in mine if (y, z) == (1, 0)]
        assert r["auc"] == pytest.approx(np.mean(wins))
        assert r["accuracy"] == pytest.approx((tp + tn) / 60) and r["f1"] == pytest.approx(2 * tp / (2 * tp + fp + fn))
        assert r["mcc"] == pytest.approx((tp * tn - fp * fn) / math.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)))
    whole = metrics.classification_metrics(df, score="score", max_rows=max_rows).first()
    assert set(whole.asDict()) == set(metrics.CLASSIFICATION)


def test_one_class_gives_no_rates(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (1, 1, 0.8)], "label int, prediction int, score double")
    row = metrics.classification_metrics(df, score="score").first()
    assert row["auc"] is None and row["mcc"] is None and row["balanced_accuracy"] is None and row["recall"] == 1
    assert lookups.threshold(F.lit(0.5)) is not None


def test_fold_table(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 0.5)], "fold int, accuracy double")
    out = metrics.fold_table(df, ["accuracy"])
    assert {r["fold"]: r["accuracy"] for r in out.collect()} == {"0": 1.0, "1": 0.5, "mean": 0.75}


def test_mean_abs_dev(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 5.0), ("b", 2.0)], "g string, x double")
    assert dict(tuple(r) for r in metrics.mean_abs_dev(df, "x", ["g"]).collect()) == {"a": 2.0, "b": 0.0}
    assert metrics.mean_abs_dev(df, "x").first()["mad"] == pytest.approx(np.mean(np.abs(np.array([1, 5, 2]) - 8 / 3)))


# ---------------------------------------------------------------- resampling

def at(*seconds):
    return [pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=s) for s in seconds]


def test_resample_keeps_empty_buckets(spark):
    pdf = pd.DataFrame({"id": "a", "time": at(5, 9, 27), "x": [1.0, 3.0, 5.0]})
    df = spark.createDataFrame(pdf).withColumn("time", F.col("time").cast("timestamp_ntz"))
    out = resample_mean(df, 7).toPandas().sort_values("time")
    assert list(out["time"]) == at(0, 7, 14, 21) and out["x"].tolist()[:2] == [1, 3]
    assert math.isnan(out["x"].tolist()[2]) and out["x"].tolist()[3] == 5
    again = resample_mean(spark.createDataFrame(out).withColumn("time", F.col("time").cast("timestamp_ntz")), 7)
    pd.testing.assert_frame_equal(again.toPandas().sort_values("time").reset_index(drop=True), out.reset_index(drop=True))


@pytest.mark.parametrize("step", [7, 60, 7000])
def test_resample_against_pandas(spark, step):
    rng = np.random.default_rng(8)
    frames = []
    for name, start, n in (("a", 80_000, 60), ("b", 200_000, 35)):
        t = start + np.cumsum(rng.integers(1, step * 3, n))
        frames.append(pd.DataFrame({"id": name, "time": at(*t.tolist()), "x": rng.normal(size=n)}))
    df = spark.createDataFrame(pd.concat(frames)).withColumn("time", F.col("time").cast("timestamp_ntz"))
    out = resample_mean(df, step).toPandas().sort_values(["id", "time"])
    want = pd.concat([f.resample(f"{step}s", on="time")[["x"]].mean().reset_index().assign(id=f["id"].iloc[0]) for f in frames])
    assert list(out["time"]) == list(want["time"])
    np.testing.assert_allclose(out["x"], want["x"])


def test_resample_of_seconds_and_refusals(spark):
    df = spark.createDataFrame([("a", 0.0, 1.0), ("a", 2.0, 2.0), ("a", 7.0, 4.0)], "id string, time double, x double")
    out = [(r["time"], r["x"]) for r in resample_mean(df, 2).orderBy("time").collect()]
    assert out == [(0.0, 1.0), (2.0, 2.0), (4.0, None), (6.0, 4.0)]
    with pytest.raises(TypeError):
        resample_mean(df.withColumn("s", F.lit("no")), 2)
    with pytest.raises(ValueError):
        resample_mean(df.withColumn("time", F.col("time") / 100))


@pytest.mark.parametrize("max_rows", [NEVER, 2])
def test_common_timestep(spark, max_rows):
    df = spark.createDataFrame([("a", float(t)) for t in (0, 2, 3, 5, 6)] + [("b", 100.0), ("b", 104.0)], "id string, time double")
    assert common_timestep(df, max_rows=max_rows).first()["time_step"] == 1
    per = common_timestep(df, per_series=True, max_rows=max_rows).collect()
    assert {r["id"]: r["time_step"] for r in per} == {"a": 1, "b": 4}
    two = df.withColumn("other", F.col("time") * 10)
    assert common_timestep(two, ["other", "time"]).first()["time_step"] == 1


# ---------------------------------------------------------------- files

def test_csv(spark, tmp_path):
    path = tmp_path / "target.csv"
    path.write_bytes(b"id,target\r\n111_1,OD\r\n103_1,ID\r\n")
    assert [tuple(r) for r in files.read_csv(spark, path, LABELS).collect()] == [("111_1", "OD"), ("103_1", "ID")]
    with pytest.raises(ValueError):
        files.read_csv(spark, 7, LABELS)


def test_latest(spark, tmp_path):
    for i, name in enumerate(("old", "new")):
        files.write_snapshot(spark.range(1).withColumn("v", F.lit(name)), tmp_path / "deep" / name)
        for part in (tmp_path / "deep" / f"{name}.parquet").iterdir():
            os.utime(part, (1e9 + i, 1e9 + i))
    (tmp_path / "newer.txt").write_text("no")
    assert files.read_latest(spark, tmp_path).first()["v"] == "new"
    with pytest.raises(ValueError):
        files.read_latest(spark, tmp_path, ".parquet")
    with pytest.raises(FileNotFoundError):
        files.read_latest(spark, tmp_path, [".orc"])


def test_groups(spark, tmp_path):
    df = spark.range(100).select((F.col("id") % 10).cast("string").alias("id"), F.col("id").alias("v"))
    files.write_groups(df, tmp_path / "g", buckets=4)
    assert files.read_groups(spark, tmp_path / "g", ["3", "7"], buckets=4).count() == 20
    with pytest.raises(KeyError):
        files.read_groups(spark, tmp_path / "g", ["3", "nobody"], buckets=4)


def test_split_files(spark, tmp_path):
    df = split.group_holdout(spark.range(40).select((F.col("id") % 8).alias("id")), 2)
    files.write_split(df, tmp_path / "s")
    train, test = files.read_split(spark, tmp_path / "s")
    assert (train.count(), test.count()) == (30, 10)
    files.write_split(df, tmp_path / "t", with_test=False)
    assert files.read_split(spark, tmp_path / "t")[1] is None


@pytest.mark.parametrize("max_rows", [NEVER, CUT])
def test_chunks_cover_disjointly(spark, max_rows):
    df = spark.range(10).select(F.lit("a").alias("id"), F.col("id").alias("time"))
    out = files.chunk_rows(df, 3, max_rows=max_rows)
    assert [r["chunk_id"] for r in out.orderBy("time").collect()] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 3]


# ---------------------------------------------------------------- training

@pytest.fixture(scope="module")
def marked(spark):
    rng = np.random.default_rng(6)
    rows = [(f"p{i}", float(t), float(rng.normal(3 * (i % 2), 1)), "u" if t % 2 else "v", i % 2 if i < 20 else -1)
            for i in range(22) for t in range(12)]
    return spark.createDataFrame(rows, "id string, time double, ch0 double, kind string, target int")


def test_folds_do_not_depend_on_how_many_run_at_a_time(spark, marked):
    seen = []
    spark.sparkContext.setLocalProperty("seriesmill.test", "set by the caller")
    fit = training.train_classifier

    def watched(*args, **kwargs):
        seen.append(spark.sparkContext.getLocalProperty("seriesmill.test"))
        return fit(*args, **kwargs)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(training, "train_classifier", watched)
        one, four = (sorted(training.cross_validate(marked, ["ch0", "kind"], 3, params={"maxIter": 2, "maxDepth": 2}, parallelism=n).collect())
                     for n in (1, 4))
    spark.sparkContext.setLocalProperty("seriesmill.test", None)
    assert one == four and [r["fold"] for r in one] == ["0", "1", "2", "mean"]
    assert seen == ["set by the caller"] * 6
    with pytest.raises(ValueError, match="counts from 1"):
        training.cross_validate(marked, ["ch0"], 2, parallelism=0)


def test_a_leak_between_folds_would_show(spark):
    """The class depends on the recording alone: nothing to learn between recordings, all of it between rows of one."""
    rng = np.random.default_rng(8)
    marks, targets = rng.permutation(60), rng.permutation(60) % 2
    rows = spark.createDataFrame([(f"p{i}", f"p{i}_{t}", float(marks[i]), int(targets[i])) for i in range(60) for t in range(8)],
                                 "id string, row string, mark double, target int")
    tree = {"maxIter": 3, "maxDepth": 8, "maxBins": 64}
    apart = {r["fold"]: r["auc"] for r in training.cross_validate(rows, ["mark"], 3, params=tree).collect()}
    leaking = {r["fold"]: r["auc"] for r in training.cross_validate(rows, ["mark"], 3, key="row", params=tree).collect()}
    assert max(apart.values()) < 0.8 and min(leaking.values()) > 0.95


def test_training_stage(marked, tmp_path):
    features = training.feature_columns(marked)
    assert features == ["ch0", "kind"]
    rows = split.group_holdout(marked, test_ids=["p2", "p3", "p21"])
    out = training.train_and_score(rows, features, n_splits=2, params={"maxIter": 2, "maxDepth": 2})
    assert {r["fold"] for r in out["folds"].collect()} == {"0", "1", "mean"}
    assert out["predictions"].columns == ["id", "time", "prediction_cont", "prediction_disc"]
    assert out["predictions"].count() == 36 and out["metrics"].first()["auc"] > 0.9
    training.save_model(out["model"], str(tmp_path / "m"))
    again = training.predict(training.load_model(str(tmp_path / "m")), rows.where("split = 'test'"), features)
    assert sorted(again.collect()) == sorted(out["predictions"].collect())
    none = training.train_and_score(rows.where("split = 'train'"), features, skip_cv=True, train_final_model=False)
    assert set(none.values()) == {None}


@pytest.mark.parametrize("partitions", [1, 13])
def test_results_do_not_depend_on_partitions_or_row_order(spark, series_df, partitions):
    from seriesmill.operators.windows import RollingSpec, rolling

    def run(df):
        out = rolling(df, [RollingSpec("x", "median", window=30, min_periods=1, name="m")], max_rows=40)
        folds = split.fold_assignment(df, 2).collect()
        return sorted(map(str, out.select("id", "time", "m").collect())), sorted(map(str, folds))

    before = spark.conf.get("spark.sql.shuffle.partitions")
    expected = run(series_df)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        assert run(series_df.orderBy(F.desc("time"))) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_plot_series(marked):
    predictions = marked.where("id in ('p1', 'p2') and time < 6").select("id", "time", F.lit(0.7).alias("prediction_cont"))
    out = plot_series(marked, predictions, rows=5)
    assert out.count() == 24 and out.where("prediction_cont is null").count() == 12
    assert {r["chunk_id"] for r in out.collect()} == {0, 1, 2}
