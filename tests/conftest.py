import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("seriesmill-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def series(spark):
    """Three series with gaps: one long, one short, one single row; times bunched in the long one."""
    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(7)
    parts = []
    for name, n in (("a", 157), ("b", 23), ("c", 1)):
        step = rng.exponential(1.0, n) ** 3 + 1e-3
        x = np.round(rng.normal(50, 20, n), 2)
        x[rng.random(n) < 0.15] = np.nan
        kind = rng.choice(["u", "v"], n)
        parts.append(pd.DataFrame({"id": name, "time": np.cumsum(step), "x": x, "kind": kind}))
    return pd.concat(parts, ignore_index=True)


@pytest.fixture(scope="session")
def series_df(spark, series):
    rows = [tuple(None if v != v else v for v in r) for r in series.itertuples(index=False)]
    return spark.createDataFrame(rows, "id string, time double, x double, kind string").repartition(5)
