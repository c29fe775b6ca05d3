"""Training, scoring and evaluation of a boosted-tree classifier of defects."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.metrics import classification_metrics, ensemble_mean, fold_table
from seriesmill.operators.clean import fill_label
from seriesmill.operators.lookups import threshold
from seriesmill.operators.split import SEED, group_kfold
from seriesmill.schema import IGNORED_FEATURES
from seriesmill.storage import kept

# Trees need a number everywhere: a missing feature sorts below every value.
MISSING = -1e30
THRESHOLD = 0.5
# Folds that are fitted at a time.
PARALLELISM = 2


def feature_columns(df: DataFrame, label: str = "target", ignored: Sequence[str] = IGNORED_FEATURES,
                    others: Sequence[str] = ("time", "split", "fold", "group_id")) -> list[str]:
    """Numeric and string columns that are neither label, key nor ignored."""
    left_out = {label, *ignored, *others}
    return [f.name for f in df.schema if f.name not in left_out
            and isinstance(f.dataType, (T.NumericType, T.StringType))]


def feature_pool(df: DataFrame, features: Sequence[str], label: str | None = "target") -> DataFrame:
    """Model rows: missing features made numbers; with a label, only rows of a defined class."""
    numeric = [c for c in features if not isinstance(df.schema[c].dataType, T.StringType)]
    df = df.withColumns({c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(MISSING)) for c in numeric})
    if label is None:
        return df
    return fill_label(df, label).where(F.col(label) >= 0).withColumn(label, F.col(label).cast("double"))


def train_classifier(df: DataFrame, features: Sequence[str], label: str = "target", seed: int = SEED,
                     validation: str | None = None, params: Mapping | None = None) -> PipelineModel:
    """Fit on rows of a defined class.  ``validation`` names a boolean column of the rows that end the
    training early."""
    pool = feature_pool(df, features, label)
    strings = [c for c in features if isinstance(df.schema[c].dataType, T.StringType)]
    stages = [StringIndexer(inputCol=c, outputCol=f"__{c}_index", handleInvalid="keep") for c in strings]
    inputs = [f"__{c}_index" if c in strings else c for c in features]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="__features"))
    model = GBTClassifier(labelCol=label, featuresCol="__features", predictionCol="__class", seed=seed,
                          **(params or {}))
    model = model.setRawPredictionCol("__raw").setProbabilityCol("__probability")
    if validation:
        model = model.setValidationIndicatorCol(validation)
    return Pipeline(stages=[*stages, model]).fit(pool)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict(models: PipelineModel | Sequence[PipelineModel], df: DataFrame, features: Sequence[str],
            keep: Sequence[str] = ("id", "time"), at: float = THRESHOLD) -> DataFrame:
    """(keep, prediction_cont, prediction_disc): the score, averaged over the models, and its class."""
    models = [models] if isinstance(models, PipelineModel) else list(models)
    made = ("__features", "__raw", "__probability", "__class")
    rows = feature_pool(df, features, None)
    for i, model in enumerate(models):
        rows = model.transform(rows).withColumn(f"__score{i}", vector_to_array("__probability")[1])
        rows = rows.drop(*made, *[c for c in rows.columns if c.endswith("_index") and c.startswith("__")])
    score = ensemble_mean(*[F.col(f"__score{i}") for i in range(len(models))])
    return rows.select(*keep, score.alias("prediction_cont"), threshold(score, at).alias("prediction_disc"))


def evaluate(predictions: DataFrame, label: str = "target", by: Sequence[str] = (),
             score: str = "prediction_cont") -> DataFrame:
    """Metrics of predictions that carry the label; rows of no defined class do not count."""
    known = fill_label(predictions, label).where(F.col(label) >= 0)
    return classification_metrics(known, by, label, "prediction_disc", score)


def cross_validate(df: DataFrame, features: Sequence[str], n_splits: int = 2, label: str = "target",
                   key: str = "id", seed: int = SEED, params: Mapping | None = None,
                   at: float = THRESHOLD, parallelism: int = PARALLELISM) -> DataFrame:
    """Metrics of each fold and their mean; no measurement is in training and validation of one fold.

    The rows are kept once and read by the fits.  Up to ``parallelism`` folds are fitted at a time, from threads that have
    the job properties of the caller; the result does not depend on it.  Each fit caches its own binned rows.
    """
    if parallelism < 1:
        raise ValueError("parallelism counts from 1")
    rows = kept(group_kfold(feature_pool(df, features, label), n_splits, key))

    def fit(fold: int) -> PipelineModel:
        marked = rows.withColumn("__held", F.col("fold") == fold)
        return train_classifier(marked, features, label, seed, "__held", params)

    # Wrapped for each fold: properties are copied where the wrapping happens, which is the thread of the caller.
    fits = [inheritable_thread_target(df.sparkSession)(lambda fold=fold: fit(fold)) for fold in range(n_splits)]
    with ThreadPoolExecutor(min(parallelism, n_splits)) as pool:
        models = list(pool.map(lambda run: run(), fits))
    held_out = None
    for fold, model in enumerate(models):
        scored = predict(model, rows.where(F.col("fold") == fold), features, (label, "fold"), at)
        held_out = scored if held_out is None else held_out.unionByName(scored)
    return fold_table(evaluate(held_out, label, ["fold"]))


def train_and_score(df: DataFrame, features: Sequence[str], skip_cv: bool = False, train_final_model: bool = True,
                    n_splits: int = 2, label: str = "target", params: Mapping | None = None) -> dict:
    """The training stage over rows with ``split``: fold table, model, predictions and test metrics.

    Parts that were not asked for, or have no test rows, are None.
    """
    df = kept(df)
    train = df.where(F.col("split") == "train")
    test = df.where(F.col("split") == "test")
    tested = not test.isEmpty()
    out = dict(folds=None, model=None, predictions=None, metrics=None)
    if not skip_cv:
        out["folds"] = cross_validate(train, features, n_splits, label, params=params)
    if train_final_model:
        marked = df.withColumn("__held", F.col("split") == "test")
        out["model"] = train_classifier(marked, features, label, validation="__held" if tested else None,
                                        params=params)
        if tested:
            scored = predict(out["model"], test, features, ("id", "time", label))
            out["predictions"] = scored.drop(label)
            out["metrics"] = evaluate(scored, label)
    return out
