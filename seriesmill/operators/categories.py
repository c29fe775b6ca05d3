"""Text columns as categories: dictionary codes, and ordered target statistics for training."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seriesmill.operators import blocks
from seriesmill.operators.lookups import attach
from seriesmill.operators.split import SEED, numbered
from seriesmill.storage import reliable

#: Distinct values above which a column stays text.
MOST = 1_000_000


def encode_categories(df: DataFrame, columns: Sequence[str] | None = None, most: int = MOST) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Text columns replaced by codes, and the table (column, code) of each: values numbered from 0 in their order, by a
    spread sort, in the smallest integer type that holds the codes.  NULL stays NULL.  A column with more than ``most``
    distinct values stays text and has no table."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and (columns is None or f.name in columns)]
    tables: dict[str, DataFrame] = {}
    out = df
    for name in names:
        values = reliable(df.select(name).where(F.col(f"`{name}`").isNotNull()).distinct())
        n = values.count()
        if n > most:
            continue
        kind = next(t for t, bits in (("tinyint", 7), ("smallint", 15), ("int", 31), ("bigint", 63)) if n <= 1 << bits)
        tables[name] = reliable(numbered(values, name, "code").withColumn("code", F.col("code").cast(kind)))
        out = attach(out, tables[name].withColumnRenamed("code", "__code"), [name]).drop(name).withColumnRenamed("__code", name)
    return out.select(*[F.col(f"`{c}`") for c in df.columns]), tables


def decode_categories(df: DataFrame, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Codes replaced by the values they stand for; unknown codes become NULL."""
    out = df
    for name, table in tables.items():
        named = table.select(F.col(f"`{name}`").alias("__value"), F.col("code").alias(name))
        out = attach(out, named, [name]).drop(name).withColumnRenamed("__value", name)
    return out.select(*[F.col(f"`{c}`") for c in df.columns])


def _category(column: str) -> Column:
    """A key that is never NULL: a missing value is a category of its own."""
    c = F.col(f"`{column}`")
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("-"))


@dataclass(frozen=True)
class Rates:
    """What training rows say of each category: (category, total of the label, rows), and the label's mean over all."""

    tables: dict[str, DataFrame]
    prior: float
    weight: float

    def attach(self, df: DataFrame) -> DataFrame:
        """Rows with ``<column>_rate`` by the totals of training; a category that did not occur there has the prior."""
        for column, table in self.tables.items():
            rows = attach(df.withColumn("__category", _category(column)), table, ["__category"])
            known = F.coalesce(F.col("__total"), F.lit(0.0)), F.coalesce(F.col("__rows"), F.lit(0))
            df = rows.withColumn(f"{column}_rate", F.try_divide(known[0] + self.weight * self.prior, known[1] + self.weight)).drop(
                "__category", "__total", "__rows")
        return df


def ordered_rates(train: DataFrame, columns: Sequence[str], label: str = "target", keys: Sequence[str] = ("id", "time"), seed: int = SEED,
                  weight: float = 1.0, max_rows: int = blocks.MAX_ROWS) -> tuple[DataFrame, Rates]:
    """Training rows with ``<column>_rate``, and what scoring needs.

    The rate is the mean label of the rows of the same category that come earlier in a seeded order of the keys, drawn
    towards the mean of all by ``weight`` rows of it.  So no row's feature holds its own label, unlike a mean over the
    category, and trees get a number that means something, unlike a code.  With a weight of 0 the first row of a category
    has none.  ``keys`` must identify a row.  A category
    of any size is spread: its totals run over blocks.
    """
    y = F.col(f"`{label}`").cast("double")
    prior = float(train.agg(F.coalesce(F.avg(y), F.lit(0.0))).first()[0])
    name = F.concat_ws(":", F.lit(str(seed)), *[F.col(f"`{k}`").cast("string") for k in keys])
    out = train.withColumn("__at", F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("long"))
    tables = {}
    for column in columns:
        keyed = out.withColumn("__category", _category(column))
        tables[column] = reliable(keyed.groupBy("__category").agg(F.sum(y).alias("__total"), F.count(F.lit(1)).alias("__rows")))
        totals = {"__total": ("sum", y), "__rows": ("sum", F.lit(1))}
        run = blocks.run_totals(keyed, ["__category"], ["__at", *keys], totals, max_rows=max_rows)
        rate = F.try_divide(F.col("__total") - y + weight * prior, F.col("__rows") - 1 + F.lit(weight))
        out = run.withColumn(f"{column}_rate", rate).drop("__category", "__total", "__rows")
    return out.drop("__at"), Rates(tables, prior, weight)
