"""Regression and classification metrics as one-pass aggregates, per group or overall."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesmill.operators import blocks
from seriesmill.operators.lookups import attach, union_rows
from seriesmill.storage import reliable

# The small term of mape; metrics reduced over batches by median, the others by mean.
MAPE_EPSILON = 1e-6
MEDIAN_METRICS = ("rmse", "r2", "mae", "mse", "mape")
MEAN_METRICS = ("pred_mean", "pred_std")
REGRESSION = MEDIAN_METRICS + MEAN_METRICS
CLASSIFICATION = ("accuracy", "auc", "recall", "precision", "f1", "balanced_accuracy", "mcc")


def regression_metric(name: str, y: str = "y_true", p: str = "y_pred") -> Column:
    """One metric as an aggregate over rows that have both values."""
    t, e = F.col(f"`{y}`").cast("double"), F.col(f"`{p}`").cast("double")
    both = F.when(t.isNotNull() & e.isNotNull(), F.lit(1))
    t, e = F.when(both == 1, t), F.when(both == 1, e)
    square = F.pow(t - e, 2)
    return {
        "mse": lambda: F.avg(square),
        "rmse": lambda: F.sqrt(F.avg(square)),
        "mae": lambda: F.avg(F.abs(t - e)),
        "mape": lambda: F.avg(F.abs(F.try_divide(t - e, t + MAPE_EPSILON))) * 100,
        "r2": lambda: 1 - F.try_divide(F.sum(square), F.count(t) * F.var_pop(t)),
        "pred_mean": lambda: F.avg(e),
        "pred_std": lambda: F.stddev_pop(e),
    }[name]().alias(name)


def regression_metrics(df: DataFrame, by: Sequence[str] = (), names: Sequence[str] = REGRESSION,
                       y: str = "y_true", p: str = "y_pred") -> DataFrame:
    return df.groupBy(*by).agg(*[regression_metric(n, y, p) for n in names])


def quantile_at(df: DataFrame, column: str, q: float, max_rows: int = blocks.MAX_ROWS) -> DataFrame:
    """Exact quantile of a column as one row, linear between neighbours.

    Works on one row per distinct value, whose running counts are spread over tasks.
    """
    counts = df.where(F.col(f"`{column}`").isNotNull()).groupBy(F.col(f"`{column}`").cast("double").alias("v"))
    counts = counts.agg(F.count(F.lit(1)).alias("n")).withColumn("__all", F.lit(0))
    run = blocks.run_totals(counts, ["__all"], ["v"], {"upto": ("sum", F.col("n"))}, max_rows=max_rows)
    at = (df.agg(F.count(f"`{column}`")).first()[0] - 1) * q
    before = F.col("upto") - F.col("n")

    def at_rank(k: int) -> Column:
        return F.max(F.when((before <= k) & (k < F.col("upto")), F.col("v")))

    low, high = at_rank(math.floor(at)), at_rank(math.ceil(at))
    return run.agg((low + (high - low) * (at - math.floor(at))).alias(column))


def metric_reduce(batches: DataFrame, names: Sequence[str] = REGRESSION,
                  max_rows: int = blocks.MAX_ROWS) -> DataFrame:
    """One row over per-batch metrics: the median for error metrics, the mean for the others."""
    medians = [n for n in names if n in MEDIAN_METRICS]
    means = [n for n in names if n not in MEDIAN_METRICS]
    batches = reliable(batches)  # one row per batch, read several times
    if batches.count() <= max_rows:
        out = batches.agg(*[F.percentile(n, F.lit(0.5)).alias(n) for n in medians],
                          *[F.avg(n).alias(n) for n in means])
        return out.select(*names)
    rows = [quantile_at(batches, n, 0.5, max_rows) for n in medians]
    if means:
        rows.append(batches.agg(*[F.avg(n).alias(n) for n in means]))
    return union_rows(*rows).agg(*[F.max(n).alias(n) for n in names])


def confusion(df: DataFrame, by: Sequence[str] = (), y: str = "label", p: str = "prediction") -> DataFrame:
    """Counts of true and false positives and negatives."""
    truth, guess = F.col(f"`{y}`") == 1, F.col(f"`{p}`") == 1
    return df.where(F.col(f"`{y}`").isNotNull()).groupBy(*by).agg(
        F.count_if(truth & guess).alias("tp"), F.count_if(~truth & guess).alias("fp"),
        F.count_if(truth & ~guess).alias("fn"), F.count_if(~truth & ~guess).alias("tn"),
    )


def _rates() -> Mapping[str, Column]:
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    return {
        "accuracy": F.try_divide(tp + tn, tp + tn + fp + fn),
        "recall": F.try_divide(tp, tp + fn),
        "precision": F.try_divide(tp, tp + fp),
        "f1": F.try_divide(2 * tp, 2 * tp + fp + fn),
        "balanced_accuracy": (F.try_divide(tp, tp + fn) + F.try_divide(tn, tn + fp)) / 2,
        "mcc": F.try_divide(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))),
    }


def _grouped(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Rows with a group key, a constant one when there are no groups."""
    return (df, list(by)) if by else (df.withColumn("__all", F.lit(0)), ["__all"])


def auc(df: DataFrame, by: Sequence[str] = (), y: str = "label", score: str = "score",
        max_rows: int = blocks.MAX_ROWS) -> DataFrame:
    """Area under the ROC curve, ties at half.

    Rows shrink to one per distinct score first; the running count of negatives is spread over tasks, so
    one group with many distinct scores does not end in one task.
    """
    df, keys = _grouped(df, by)
    known = df.where(F.col(f"`{y}`").isNotNull() & F.col(f"`{score}`").isNotNull())
    positive = F.col(f"`{y}`") == 1
    scores = known.groupBy(*keys, F.col(f"`{score}`").cast("double").alias("__score")).agg(
        F.count_if(positive).cast("double").alias("__pos"), F.count_if(~positive).cast("double").alias("__neg"))
    run = blocks.run_totals(scores, keys, ["__score"], {"__upto": ("sum", F.col("__neg"))}, max_rows=max_rows)
    below = F.col("__upto") - F.col("__neg") / 2
    area = F.try_divide(F.sum(F.col("__pos") * below), F.sum("__pos") * F.sum("__neg"))
    return run.groupBy(*keys).agg(area.alias("auc")).select(*by, "auc")


def classification_metrics(df: DataFrame, by: Sequence[str] = (), y: str = "label", p: str = "prediction",
                           score: str | None = None, max_rows: int = blocks.MAX_ROWS,
                           names: Sequence[str] = CLASSIFICATION) -> DataFrame:
    """The named classification metrics, all by default.  ``score`` is what the ROC curve is drawn from, the class if
    None; the curve is only drawn if its area is asked for."""
    df, keys = _grouped(df, by)
    counts = confusion(df, keys, y, p)
    rates = counts.select(*keys, *[c.alias(n) for n, c in _rates().items() if n in names])
    if "auc" in names:
        rates = rates.join(auc(df, keys, y, score or p, max_rows), keys, "left")
    return rates.select(*by, *names)


def fold_table(folds: DataFrame, names: Sequence[str] = CLASSIFICATION, fold: str = "fold") -> DataFrame:
    """Fold rows plus a row ``mean``, the unweighted mean of the folds."""
    return folds.rollup(fold).agg(*[F.avg(n).alias(n) for n in names], F.grouping(fold).alias("__total")).select(
        F.when(F.col("__total") == 1, F.lit("mean")).otherwise(F.col(fold).cast("string")).alias(fold), *names)


def ensemble_mean(*scores: Column) -> Column:
    """Average score of several models."""
    return sum(scores[1:], scores[0]) / len(scores)


def mean_abs_dev(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute deviation from the mean: one pass for the mean, one for the deviation."""
    df, keys = _grouped(df, by)
    x = F.col(f"`{column}`")
    rows = attach(df, df.groupBy(*keys).agg(F.avg(x).alias("__centre")), keys)
    return rows.groupBy(*keys).agg(F.avg(F.abs(x - F.col("__centre"))).alias("mad")).select(*by, "mad")
