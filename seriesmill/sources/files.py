"""Reading and writing recordings."""

from __future__ import annotations

import math
from collections.abc import Sequence
from pathlib import PurePath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.functions.scalar import file_stem, normalize_name
from seriesmill.operators import blocks
from seriesmill.operators.clean import nan_to_null
from seriesmill.operators.lookups import filter_in

CHUNK_MB = 10


def _path(path: str | PurePath) -> str:
    if not isinstance(path, (str, PurePath)):
        raise ValueError(f"path must be a string or a path, not {type(path).__name__}")
    return str(path)


#: What a malformed line is kept in.
REJECTED = "__rejected"


def file_position() -> Column:
    """Where a row of a file scan lies: path, start of the part that one task reads, place within the task.  Rows of
    several files compare in the order of the files' paths and, within a file, of its lines."""
    return F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                    F.monotonically_increasing_id().alias("place"))


def _csv(spark: SparkSession, path: str | PurePath, schema: T.StructType, mode: str, *more: T.StructField) -> DataFrame:
    reader = spark.read.schema(T.StructType([*schema.fields, *more])).option("header", True).option("enforceSchema", False)
    df = reader.option("mode", mode).option("columnNameOfCorruptRecord", REJECTED).csv(_path(path))
    # Spark judges a line by the cells that a query reads. This condition always holds and reads all of them.
    return df.where(F.pmod(F.hash(*[F.col(f"`{c}`") for c in schema.names]), F.lit(1)) == 0)


def read_csv(spark: SparkSession, path: str | PurePath, schema: T.StructType, position: str | None = None) -> DataFrame:
    """CSV with a header, read with a declared schema; NaN becomes NULL.

    A cell that its type cannot hold, and a line with more or fewer cells than columns, is an error when the rows are
    read; ``read_csv_parts`` keeps such lines apart.  ``position`` names a column to add with the place of each row in
    the files, which orders rows of repeated keys.
    """
    df = _csv(spark, path, schema, "FAILFAST")
    if position is not None:
        df = df.withColumn(position, file_position())
    return nan_to_null(df)


def read_csv_parts(spark: SparkSession, path: str | PurePath, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): rows of well-formed lines, and (file, line) of the malformed ones."""
    found = _csv(spark, path, schema, "PERMISSIVE", T.StructField(REJECTED, T.StringType()))
    bad = F.col(REJECTED).isNotNull()
    rejects = found.withColumn("file", F.col("_metadata.file_path")).where(bad).select("file", F.col(REJECTED).alias("line"))
    return nan_to_null(found.where(~bad).drop(REJECTED)), rejects


def read_snapshot(spark: SparkSession, path: str | PurePath) -> DataFrame:
    return spark.read.parquet(_path(path))


def write_snapshot(df: DataFrame, path: str | PurePath) -> str:
    """Write gzip parquet; the suffix is added if absent.  Returns the path."""
    out = _path(path)
    if not out.endswith(".parquet"):
        out += ".parquet"
    df.write.mode("overwrite").option("compression", "gzip").parquet(out)
    return out


def latest_file(spark: SparkSession, path: str | PurePath, suffixes: Sequence[str]) -> str:
    """Newest file below a folder with one of the suffixes.  Only the listing is read, no content."""
    if isinstance(suffixes, str):
        raise ValueError("suffixes is a list of suffixes")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(_path(path))
    wanted = F.lit(False)
    for suffix in suffixes:
        wanted = wanted | F.col("path").endswith(suffix)
    newest = files.select("path", "modificationTime").where(wanted)
    newest = newest.orderBy(F.desc("modificationTime"), F.desc("path")).first()
    if newest is None:
        raise FileNotFoundError(f"no file with suffix {list(suffixes)} below {path}")
    return newest["path"]


def read_latest(spark: SparkSession, path: str | PurePath, suffixes: Sequence[str] = (".parquet",),
                schema: T.StructType | None = None) -> DataFrame:
    """Load the newest snapshot below a folder.

    A part file inside a folder that carries the suffix stands for that folder, which is one snapshot.
    """
    found = latest_file(spark, path, suffixes)
    parent = found.rsplit("/", 1)[0]
    if any(parent.endswith(suffix) for suffix in suffixes):
        found = parent
    if any(found.endswith(s) for s in (".csv", ".csv.gz")):
        return read_csv(spark, found, schema)
    return spark.read.parquet(found)


def read_directory(spark: SparkSession, path: str | PurePath, suffix: str = ".parquet",
                   key: str = "id") -> DataFrame:
    """All files of a folder in one scan; the normalised file stem becomes the key."""
    df = spark.read.option("pathGlobFilter", f"*{suffix}").parquet(_path(path))
    stem: Column = normalize_name(file_stem(F.col("_metadata.file_name")))
    return df.withColumn(key, stem)


def write_groups(df: DataFrame, path: str | PurePath, key: str = "id", buckets: int = 64) -> None:
    """Write rows under a folder per bucket of ids, so that reads of some ids skip the others.

    Rows are brought together by bucket before they are written; a large bucket stays in several tasks.
    """
    bucketed = df.withColumn("group_bucket", group_bucket(key, buckets)).hint("rebalance", "group_bucket")
    bucketed.write.mode("overwrite").partitionBy("group_bucket").parquet(_path(path))


def group_bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.hash(F.col(f"`{key}`").cast("string")), F.lit(buckets))


def read_groups(spark: SparkSession, path: str | PurePath, ids: Sequence, key: str = "id",
                buckets: int = 64) -> DataFrame:
    """Rows of the named measurements from a folder of ``write_groups``; an unknown one is an error."""
    ids = list(ids)
    wanted = spark.createDataFrame([(i,) for i in ids], [key])
    folders = [r[0] for r in wanted.select(group_bucket(key, buckets)).distinct().collect()]
    stored = spark.read.parquet(_path(path)).where(F.col("group_bucket").isin(folders))
    wanted = wanted.withColumn(key, F.col(key).cast(stored.schema[key].dataType))
    unknown = wanted.join(stored.select(key).distinct(), key, "left_anti").limit(1).collect()
    if unknown:
        raise KeyError(f"unknown measurement {unknown[0][0]!r}")
    return filter_in(stored, wanted, key).drop("group_bucket")


def write_split(df: DataFrame, path: str | PurePath, with_test: bool = True) -> None:
    """Write a folder per value of ``split``; test only when asked for."""
    rows = df if with_test else df.where(F.col("split") == "train")
    rows.write.mode("overwrite").partitionBy("split").parquet(_path(path))


def read_split(spark: SparkSession, path: str | PurePath) -> tuple[DataFrame, DataFrame | None]:
    """(train, test); test is None where none was written."""
    stored = spark.read.parquet(_path(path))
    test = stored.where(F.col("split") == "test").drop("split")
    return stored.where(F.col("split") == "train").drop("split"), None if test.isEmpty() else test


def rows_per_chunk(df: DataFrame, megabytes: float = CHUNK_MB) -> int:
    """Rows that take about ``megabytes``, from the default sizes of the column types."""
    sizes = {"string": 20, "double": 8, "bigint": 8, "timestamp": 8, "timestamp_ntz": 8}
    width = sum(sizes.get(f.dataType.simpleString(), 4) for f in df.schema)
    return max(1, math.floor(megabytes * 2**20 / width))


def chunk_rows(df: DataFrame, rows: int | None = None, ids: Sequence[str] = ("id",),
               order: Sequence[str] = ("time",), max_rows: int = blocks.MAX_ROWS,
               found: blocks.LongSeries | None = None) -> DataFrame:
    """Add ``chunk_id``: consecutive rows of a series in disjoint chunks that cover all of them."""
    size = rows or rows_per_chunk(df)
    numbered = blocks.number_rows(df, ids, order, "chunk_id", max_rows, found)
    return numbered.withColumn("chunk_id", F.floor(F.col("chunk_id") / size).cast("long"))


def write_chunks(df: DataFrame, path: str | PurePath, rows: int) -> None:
    """Write files of at most ``rows`` rows."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(_path(path))
