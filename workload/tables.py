"""The given tables seen as recordings."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.operators.windows import shift
from seriesmill.storage import ensure_checkpoint_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can say it, its oracle."""
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as recordings: one series per user, with gaps in ch0 and infinities in ch0_inf."""
    value, kind = F.col("value"), F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("double")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), F.col("ts").alias("time"),
        F.when(kind != "error", value).alias("ch0"), k.alias("ch1"), (value - k).alias("ch2"),
        F.when(kind == "click", float("inf")).otherwise(value).alias("ch0_inf"),
        kind.alias("kind"), value.alias("value"),
    )


MEASUREMENTS_SQL = """
m AS (SELECT user_id AS id, ts AS time, CASE WHEN event_type <> 'error' THEN value END AS ch0,
             CAST(json_extract_string(props, '$.k') AS DOUBLE) AS ch1,
             value - CAST(json_extract_string(props, '$.k') AS DOUBLE) AS ch2,
             CASE WHEN event_type = 'click' THEN CAST('Infinity' AS DOUBLE) ELSE value END AS ch0_inf,
             event_type AS kind, value
      FROM events)"""


def with_m(sql: str, *more: str) -> str:
    """A statement over the view m and further named queries."""
    return "WITH " + ", ".join([MEASUREMENTS_SQL.strip(), *more]) + "\n" + sql


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels as defect types of the recordings of the same number."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("id"), F.when(F.col("quality") == 1, "OD").otherwise("ID").alias("target"))


def regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each value against the previous value of its series."""
    m = measurements(spark, sf_dir).select("id", "time", F.col("value").alias("y_true"), F.col("value").alias("y_pred"))
    return shift(m, {"y_pred": 1}).where(F.col("y_pred").isNotNull()).drop("time")


REGRESSION_SQL = """
reg AS (SELECT * FROM (SELECT id, value AS y_true,
                              lag(value) OVER (PARTITION BY id ORDER BY time) AS y_pred FROM m)
        WHERE y_pred IS NOT NULL)"""


def classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document quality against a score that grows with length."""
    n = F.col("n_chars").cast("double")
    docs = table(spark, sf_dir, "documents").select("doc_id", (n / (n + 900.0)).alias("score"))
    known = table(spark, sf_dir, "labels").join(docs, "doc_id")
    return known.select(F.col("toxic").alias("part"), F.col("quality").alias("label"), "score",
                        F.when(F.col("score") > 0.5, 1).otherwise(0).alias("prediction"))


CLASSIFICATION_SQL = """
cls AS (SELECT l.toxic AS part, l.quality AS label, d.score, CASE WHEN d.score > 0.5 THEN 1 ELSE 0 END AS prediction
        FROM labels l JOIN (SELECT doc_id, CAST(n_chars AS DOUBLE) / (CAST(n_chars AS DOUBLE) + 900.0) AS score
                            FROM documents) d ON l.doc_id = d.doc_id)"""


def rounded(df: DataFrame, digits: int | None, *columns: str) -> DataFrame:
    return df.withColumns({c: neat(F.col(c), digits) for c in columns})


def neat(c: Column, digits: int | None) -> Column:
    """Rounded double without a negative zero; to single precision without digits."""
    c = c.cast("float").cast("double") if digits is None else F.round(c.cast("double"), digits)
    return c + F.lit(0.0)


def scratch(spark: SparkSession) -> str:
    """A new folder next to the checkpoints, where all executors can write."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/files-{uuid.uuid4()}"
