import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = os.environ.get("ORRERY_TEST_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[*]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def normal(frame, columns):
    rows = frame[columns].astype(object).where(frame[columns].notna(), None).itertuples(index=False, name=None)
    return sorted(map(repr, rows))


def assert_same(df, sql, duck):
    got, wanted = df.toPandas(), duck.execute(sql).fetchdf()
    columns = sorted(got.columns)
    assert columns == sorted(wanted.columns)
    assert normal(got, columns) == normal(wanted, columns)
