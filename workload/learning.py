"""Splits, metrics, training and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from seriesmill.functions import metrics
from seriesmill.operators import categories, split
from seriesmill.operators.lookups import mark_target
from seriesmill.operators.windows import RollingSpec, rolling
from seriesmill.plans import training
from seriesmill.sources import files
from seriesmill.storage import kept
from workload.rows import LABELS_SQL, MARKED_SQL
from workload.tables import (
    CLASSIFICATION_SQL, REGRESSION_SQL, classification, labels, measurements, query, regression, rounded, scratch, table, with_m,
)

# ---------------------------------------------------------------- splits

HELD_OUT = 20
_TEST = f"""test AS (SELECT id FROM (SELECT DISTINCT id FROM m) ORDER BY md5('42:' || CAST(id AS VARCHAR)), id
             LIMIT {HELD_OUT})"""


@query("group_holdout", with_m(
    "SELECT id, time, CASE WHEN id IN (SELECT id FROM test) THEN 'test' ELSE 'train' END AS split FROM m", _TEST))
def group_holdout(spark, sf_dir):
    return split.group_holdout(measurements(spark, sf_dir).select("id", "time"), HELD_OUT)


@query("group_holdout_named", with_m(
    "SELECT id, time, CASE WHEN id IN (4, 9, 77) THEN 'test' ELSE 'train' END AS split FROM m"))
def group_holdout_named(spark, sf_dir):
    return split.group_holdout(measurements(spark, sf_dir).select("id", "time"), test_ids=[4, 9, 77])


_NUMBERS = with_m("""
    SELECT id, time, CAST(dense_rank() OVER (ORDER BY upper(replace(CAST(id AS VARCHAR), ' ', ''))) - 1 AS BIGINT)
           AS group_id FROM m""")


@query("group_ids", _NUMBERS)
def group_ids(spark, sf_dir):
    return split.group_ids(measurements(spark, sf_dir).select("id", "time"))


@query("group_ids_sorted", _NUMBERS)
def group_ids_sorted(spark, sf_dir):
    """With a limit that cuts the rows of a name: the same numbers, of the same type."""
    return split.group_ids(measurements(spark, sf_dir).select("id", "time"), max_rows=100)


def folds_sql(k: int) -> str:
    """Largest group first onto the lightest fold, one recursion step per group."""
    return with_m("SELECT m.id, m.time, CAST(d.fold AS INTEGER) AS fold FROM m JOIN deal d ON d.id = m.id",
                  """sizes AS (SELECT id, n, row_number() OVER (ORDER BY n DESC, id) AS rn
                               FROM (SELECT id, count(*) AS n FROM m GROUP BY id))""",
                  f"""deal AS (SELECT CAST(0 AS BIGINT) AS rn, CAST(NULL AS BIGINT) AS id, CAST(-1 AS BIGINT) AS fold,
                                      CAST([{', '.join('0' * k)}] AS BIGINT[]) AS loads
                               UNION ALL
                               SELECT s.rn, s.id, list_position(loads, list_min(loads)) - 1,
                                      list_transform(loads, lambda x, i: x + CASE
                                          WHEN i = list_position(loads, list_min(loads)) THEN s.n ELSE 0 END)
                               FROM deal d JOIN sizes s ON s.rn = d.rn + 1)""").replace("WITH", "WITH RECURSIVE", 1)


@query("group_kfold", folds_sql(4))
def group_kfold(spark, sf_dir):
    return split.group_kfold(measurements(spark, sf_dir).select("id", "time"), 4)


@query("group_kfold_names", folds_sql(3).replace("m.id, m.time", "'r' || lpad(CAST(m.id AS VARCHAR), 6, '0') AS id, m.time"))
def group_kfold_names(spark, sf_dir):
    """Ids that are strings: ties by name, which here is the order of their numbers."""
    m = measurements(spark, sf_dir).select(F.concat(F.lit("r"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("id"), "time")
    return split.group_kfold(m, 3)


@query("group_holdout_fifth", with_m(
    "SELECT id, time, CASE WHEN id IN (SELECT id FROM fifth) THEN 'test' ELSE 'train' END AS split FROM m",
    """fifth AS (SELECT id FROM (SELECT id, row_number() OVER (ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) AS r,
                                        count(*) OVER () AS n FROM (SELECT DISTINCT id FROM m)) WHERE r <= n // 5)"""))
def group_holdout_fifth(spark, sf_dir):
    m = measurements(spark, sf_dir).select("id", "time")
    return split.group_holdout(m, m.select("id").distinct().count() // 5)


@query("write_split", with_m("""
    SELECT CASE WHEN id IN (SELECT id FROM test) THEN 'test' ELSE 'train' END AS part, id, count(*) AS n
    FROM m GROUP BY ALL""", _TEST))
def write_split(spark, sf_dir):
    """Written under a folder per part and read back."""
    folder = scratch(spark)
    files.write_split(split.group_holdout(measurements(spark, sf_dir).select("id", "time"), HELD_OUT), folder)
    train, test = files.read_split(spark, folder)
    rows = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return rows.groupBy("part", "id").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- metrics

METRIC_SQL = {
    "rmse": "sqrt(avg((y_true - y_pred) ** 2))",
    "r2": "1 - sum((y_true - y_pred) ** 2) / nullif(count(*) * var_pop(y_true), 0)",
    "mae": "avg(abs(y_true - y_pred))",
    "mse": "avg((y_true - y_pred) ** 2)",
    "mape": "avg(abs((y_true - y_pred) / (y_true + 1e-6))) * 100",
    "pred_mean": "avg(y_pred)",
    "pred_std": "stddev_pop(y_pred)",
}


def single(expr: str) -> str:
    return f"CAST(CAST({expr} AS FLOAT) AS DOUBLE)"


for _name, _expr in METRIC_SQL.items():
    query(_name, with_m(f"SELECT {single(_expr)} AS {_name} FROM reg", REGRESSION_SQL))(
        lambda spark, sf_dir, n=_name: rounded(metrics.regression_metrics(regression(spark, sf_dir), (), [n]), None, n))

_ALL = ", ".join(f"{single(e)} AS {n}" for n, e in METRIC_SQL.items())


@query("regression_per_series", with_m(f"SELECT id, {_ALL} FROM reg GROUP BY id", REGRESSION_SQL))
def regression_per_series(spark, sf_dir):
    return rounded(metrics.regression_metrics(regression(spark, sf_dir), ["id"]), None, *METRIC_SQL)


_REDUCED = with_m("SELECT " + ", ".join(
    single(f"{'avg' if n in metrics.MEAN_METRICS else 'median'}({n})") + f" AS {n}" for n in METRIC_SQL) + " FROM b",
    REGRESSION_SQL, "b AS (SELECT id, " + ", ".join(f"{e} AS {n}" for n, e in METRIC_SQL.items()) + " FROM reg GROUP BY id)")


@query("metric_reduce", _REDUCED)
def metric_reduce(spark, sf_dir):
    batches = metrics.regression_metrics(regression(spark, sf_dir), ["id"])
    return rounded(metrics.metric_reduce(batches), None, *METRIC_SQL)


@query("metric_reduce_spread", _REDUCED)
def metric_reduce_spread(spark, sf_dir):
    """As with more batches than one task may hold: medians from running counts over blocks."""
    batches = metrics.regression_metrics(regression(spark, sf_dir), ["id"])
    return rounded(metrics.metric_reduce(batches, max_rows=24), None, *METRIC_SQL)


_COUNTS = """c AS (SELECT part, CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) AS tp,
             CAST(count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS DOUBLE) AS fp,
             CAST(count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS DOUBLE) AS fn,
             CAST(count(*) FILTER (WHERE label <> 1 AND prediction <> 1) AS DOUBLE) AS tn FROM cls GROUP BY part)"""
RATE_SQL = {
    "accuracy": "(tp + tn) / nullif(tp + tn + fp + fn, 0)",
    "recall": "tp / nullif(tp + fn, 0)",
    "precision": "tp / nullif(tp + fp, 0)",
    "f1": "2 * tp / nullif(2 * tp + fp + fn, 0)",
    "balanced_accuracy": "(tp / nullif(tp + fn, 0) + tn / nullif(tn + fp, 0)) / 2",
    "mcc": "(tp * tn - fp * fn) / nullif(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0)",
}
# Pairs of a positive and a negative: won, or tied at half.
_AUC = """a AS (SELECT p.part, avg(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0 END) AS auc
          FROM cls p JOIN cls n ON p.part = n.part WHERE p.label = 1 AND n.label = 0 GROUP BY p.part)"""


@query("confusion", with_m("""
    SELECT part, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp,
           count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn, count(*) FILTER (WHERE label <> 1 AND prediction <> 1) AS tn
    FROM cls GROUP BY part""", CLASSIFICATION_SQL))
def confusion(spark, sf_dir):
    return metrics.confusion(classification(spark, sf_dir), ["part"])


for _name, _expr in RATE_SQL.items():
    query(_name, with_m(f"SELECT part, {single(_expr)} AS {_name} FROM c", CLASSIFICATION_SQL, _COUNTS))(
        lambda spark, sf_dir, n=_name: rounded(
            metrics.classification_metrics(classification(spark, sf_dir), ["part"], names=[n]), None, n))

_AUC_SQL = with_m(f"SELECT part, {single('auc')} AS auc FROM a", CLASSIFICATION_SQL, _AUC)


@query("auc", _AUC_SQL)
def auc(spark, sf_dir):
    return rounded(metrics.auc(classification(spark, sf_dir), ["part"]), None, "auc")


@query("auc_blocked", _AUC_SQL)
def auc_blocked(spark, sf_dir):
    """Running counts of the scores over blocks."""
    return rounded(metrics.auc(classification(spark, sf_dir), ["part"], max_rows=20), None, "auc")


_METRICS = ("accuracy", "auc", "recall", "precision", "f1", "balanced_accuracy", "mcc")
_SCORED = "s AS (SELECT c.part, a.auc, " + ", ".join(f"{e} AS {n}" for n, e in RATE_SQL.items()) + " FROM c JOIN a USING (part))"


@query("fold_table", with_m(
    f"SELECT CAST(part AS VARCHAR) AS fold, {', '.join(f'{single(n)} AS {n}' for n in _METRICS)} FROM s UNION ALL "
    f"SELECT 'mean', {', '.join(single(f'avg({n})') for n in _METRICS)} FROM s", CLASSIFICATION_SQL, _COUNTS, _AUC, _SCORED))
def fold_table(spark, sf_dir):
    rows = classification(spark, sf_dir).withColumnRenamed("part", "fold")
    per_fold = metrics.classification_metrics(rows, ["fold"], score="score")
    return rounded(metrics.fold_table(per_fold), None, *_METRICS)


@query("ensemble_mean", with_m("SELECT id, time, round((ch1 / 100 + value / 1000 + 0.5) / 3, 9) AS score FROM m"))
def ensemble_mean(spark, sf_dir):
    m = measurements(spark, sf_dir)
    score = metrics.ensemble_mean(F.col("ch1") / 100, F.col("value") / 1000, F.lit(0.5))
    return m.select("id", "time", F.round(score, 9).alias("score"))


# ---------------------------------------------------------------- training

FEATURES = ["ch0", "ch1", "ch2", "kind", "ch0_mean", "ch1_max"]
# A class that one feature tells, so that SQL can say what a right model gives.
CLICK = "CASE WHEN kind = 'click' THEN 1 ELSE 0 END"


def model_rows(spark, sf_dir):
    m = measurements(spark, sf_dir).select("id", "time", "ch0", "ch1", "ch2", "kind")
    marked = mark_target(m, labels(spark, sf_dir))
    specs = [RollingSpec("ch0", "mean", window=10, min_periods=1, name="ch0_mean"),
             RollingSpec("ch1", "max", window=10, min_periods=1, name="ch1_max")]
    return rolling(marked, specs)


def click_rows(spark, sf_dir):
    return model_rows(spark, sf_dir).withColumn("target", F.expr(CLICK))


_FIFTH = """fifth AS (SELECT id FROM (SELECT id, row_number() OVER (ORDER BY md5('42:' || CAST(id AS VARCHAR)), id) AS r,
                                             count(*) OVER () AS n FROM (SELECT DISTINCT id FROM m)) WHERE r <= n // 5)"""


def held_out_rows(spark, sf_dir):
    """Model rows with a fifth of the recordings held out."""
    rows = click_rows(spark, sf_dir)
    return split.group_holdout(rows, measurements(spark, sf_dir).select("id").distinct().count() // 5)


@query("feature_pool", with_m("""
    SELECT id, time, coalesce(ch0, -1e30) AS ch0, CAST(target AS DOUBLE) AS target FROM marked WHERE target >= 0""",
    LABELS_SQL, MARKED_SQL))
def feature_pool(spark, sf_dir):
    return training.feature_pool(model_rows(spark, sf_dir), ["ch0"]).select("id", "time", "ch0", "target")


@query("train_classifier", "SELECT unnest(['ch0', 'ch1', 'ch2', 'kind', 'ch0_mean', 'ch1_max']) AS feature, "
       "unnest([0.0, 0.0, 0.0, 1.0, 0.0, 0.0])::DOUBLE AS weight")
def train_classifier(spark, sf_dir):
    """How much each feature weighs in a model that was saved and loaded."""
    model = training.train_classifier(click_rows(spark, sf_dir), FEATURES)
    folder = f"{scratch(spark)}/model"
    training.save_model(model, folder)
    trees = training.load_model(folder).stages[-1]
    weights = [(f, round(float(w), 6)) for f, w in zip(FEATURES, trees.featureImportances.toArray())]
    return spark.createDataFrame(weights, "feature string, weight double")


@query("predict", with_m(f"SELECT id, time, CAST({CLICK} AS DOUBLE) AS side, CAST({CLICK} AS INTEGER) AS prediction_disc "
                         "FROM m WHERE id IN (SELECT id FROM fifth)", _FIFTH))
def predict(spark, sf_dir):
    """Scores of held-out recordings, averaged over two models, rounded to their side."""
    rows = kept(held_out_rows(spark, sf_dir))
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    models = [training.train_classifier(train, FEATURES, seed=s) for s in (1, 2)]
    scored = rounded(training.predict(models, test, FEATURES).withColumnRenamed("prediction_cont", "side"), 0, "side")
    return scored.withColumn("prediction_disc", F.col("prediction_disc").cast("int"))


_RATES = """
    WITH e AS (SELECT event_id, event_type AS kind, CASE WHEN value > 50 THEN 1.0 ELSE 0.0 END AS y, user_id % 5 <> 0 AS learnt FROM events),
    t AS (SELECT *, md5('42:' || CAST(event_id AS VARCHAR)) AS h FROM e WHERE learnt), p AS (SELECT avg(y) AS p FROM t),
    k AS (SELECT kind, sum(y) AS s, count(*) AS n FROM t GROUP BY kind)
    SELECT event_id, round((coalesce(sum(y) OVER w, 0) + p) / (count(*) OVER w + 1), 9) AS rate FROM t, p
    WINDOW w AS (PARTITION BY kind ORDER BY h, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    UNION ALL SELECT event_id, round((coalesce(s, 0) + p) / (coalesce(n, 0) + 1), 9) FROM e LEFT JOIN k USING (kind), p WHERE NOT learnt"""


def _category_rates(spark, sf_dir, **limit):
    events = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("kind"),
                                                   F.when(F.col("value") > 50, 1).otherwise(0).alias("target"), (F.col("user_id") % 5 != 0).alias("learnt"))
    train, rates = categories.ordered_rates(events.where("learnt"), ["kind"], keys=["event_id"], **limit)
    both = train.unionByName(rates.attach(events.where("NOT learnt")))
    return both.select("event_id", F.round("kind_rate", 9).alias("rate"))


@query("category_rates", _RATES)
def category_rates(spark, sf_dir):
    """Mean label of earlier rows of a category in training, of all training rows for those held out."""
    return _category_rates(spark, sf_dir)


@query("category_rates_blocked", _RATES)
def category_rates_blocked(spark, sf_dir):
    """With categories that no task may hold."""
    return _category_rates(spark, sf_dir, max_rows=150)


@query("encode_categories", """
    SELECT event_id, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS TINYINT) AS kind, event_type AS back, 'tinyint' AS type, props AS props FROM events""")
def encode_categories(spark, sf_dir):
    """Codes, the values they are decoded to, their type; a column of too many values stays text."""
    events = table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("kind"), "props")
    coded, tables = categories.encode_categories(events, most=40)
    back = categories.decode_categories(coded, tables).select("event_id", F.col("kind").alias("back"))
    return coded.join(back, "event_id").select("event_id", "kind", "back", F.typeof("kind").alias("type"), "props")


_PERFECT = ", ".join(f"CAST(1 AS DOUBLE) AS {n}" for n in _METRICS)


@query("cross_validate", f"SELECT unnest(['0', '1', '2', 'mean']) AS fold, {_PERFECT}")
def cross_validate(spark, sf_dir):
    out = training.cross_validate(click_rows(spark, sf_dir), FEATURES, 3)
    return rounded(out, 6, *_METRICS)


@query("cross_validate_apart", "SELECT unnest(['0', '1', '2', 'mean']) AS fold, FALSE AS learnt")
def cross_validate_apart(spark, sf_dir):
    """Whether a class that depends on the recording alone is learnt from other rows of it, which would be a leak.

    The features tell the recording, so with rows of one recording on both sides every fold would be near an AUC of 1.
    """
    rows = measurements(spark, sf_dir).select(
        "id", "time", (F.abs(F.xxhash64("id")) % 1_000_003).alias("mark"), (F.crc32(F.col("id").cast("string")) % 2).cast("int").alias("target"))
    out = training.cross_validate(rows, ["mark"], 3, params={"maxIter": 5, "maxDepth": 8, "maxBins": 256})
    return out.select("fold", (F.col("auc") > 0.8).alias("learnt"))


@query("evaluate_test", f"SELECT {_PERFECT}")
def evaluate_test(spark, sf_dir):
    """The training stage: final model, scores of the held-out recordings, their metrics."""
    rows = held_out_rows(spark, sf_dir)
    out = training.train_and_score(rows, FEATURES, skip_cv=True)
    return rounded(out["metrics"], 6, *_METRICS)
