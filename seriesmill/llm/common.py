"""What the operators of this subpackage share."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesmill.storage import ensure_checkpoint_dir

#: The white space of the contracts: \x20 and \x09 to \x0D; for Java's expressions and for translate().
SPACE_CLASS = "[ \\x09-\\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns by exact spelling, whatever other columns are called (``TEXT`` beside ``text``, say)."""
    columns = df.columns
    return df.toDF(*(f"_{i}" for i in range(len(columns)))).select(
        *(F.col(f"_{columns.index(name)}").alias(name) for name in names))


def shared_folder(spark: SparkSession) -> str:
    """A new folder's name in the place that the cluster names in ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read again: lineage is cut, and the rows survive lost executors."""
    path = shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: Column) -> Column:
    """The words of a text, none for null: maximal runs of anything but white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), lambda w: w != "")


def bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of each Arrow batch with columns (doc_id, text); a null text counts as empty."""
    for batch in batches:
        yield batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]


def in_parts(batches: Iterable[pa.RecordBatch], column: str = "text", most: int = 500_000, rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches cut into parts of at most ``most`` bytes of a column and at most ``rows`` rows, or one row: what a task holds
    beside its input is bounded by a part, or by one text."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < batch.num_rows:
            before = ends[lo - 1] if lo else 0
            hi = max(lo + 1, min(lo + rows, int(np.searchsorted(ends, before + most, "right"))))
            yield batch.slice(lo, hi - lo)
            lo = hi


#: Keys that may be broadcast.
FEW = 100_000


def looked_up(rows: DataFrame, table: DataFrame, on: list[str], weight: str, spread: list[str], few: int = FEW) -> DataFrame:
    """Rows with the columns of a stored table of one row per key, null where the table has none.

    ``weight`` is how many rows have the key. The heaviest keys, fewer than ``few`` by their share of the whole weight,
    are broadcast; the others are light and joined by an exchange, in which all further rows are spread by the columns
    ``spread``. So no key, present or null, makes a task large.
    """
    values = [c for c in table.columns if c not in on and c != weight]
    total = table.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    heavy, light = table.where(F.col(weight) > total // few), table.where(F.col(weight) <= total // few)
    found = rows.join(F.broadcast(heavy.drop(weight).withColumn("_hit", F.lit(True))), on, "left")
    if not light.head(1):
        return found.drop("_hit")
    open_ = F.col("_hit").isNull()
    for c in on:
        open_ = open_ & F.col(c).isNotNull()
    salted = found.withColumn("_salt", F.when(open_, F.lit(-1)).otherwise(F.pmod(F.xxhash64(*spread), F.lit(1 << 16)).cast("int")))
    others = light.select(*on, *(F.col(v).alias(f"_{v}") for v in values), F.lit(-1).alias("_salt"))
    joined = salted.join(others, [*on, "_salt"], "left")
    return joined.select(*rows.columns, *(F.coalesce(v, f"_{v}").alias(v) for v in values))
