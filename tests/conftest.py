import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="docweave-tests-")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{scratch}/shared")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    import duckdb

    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


@pytest.fixture(scope="session")
def same():
    """Compares a DataFrame with rows of DuckDB: columns by name, rows in any order, floats to six places."""

    def value(v):
        if isinstance(v, float):
            return round(v, 6)
        if isinstance(v, (list, tuple)):
            return [value(x) for x in v]
        return str(v) if hasattr(v, "isoformat") else v

    def check(df, relation):
        names = sorted(df.columns)
        assert names == sorted(relation.columns)
        got = sorted(repr([value(r[n]) for n in names]) for r in df.collect())
        order = [relation.columns.index(n) for n in names]
        want = sorted(repr([value(r[i]) for i in order]) for r in relation.fetchall())
        assert got == want
        return len(got)

    return check


@pytest.fixture
def airports(spark):
    rows = [
        ("airport::ord", "O'Hare International Airport", "ORD", "United States", 204, 8, 1, 41.976, -87.912, "airport"),
        ("airport::sfo", "San Francisco International Airport", "SFO", "United States", 4, 4, None, 37.622, -122.382, "airport"),
        ("airport::vie", "Vienna International Airport", "VIE", "Austria", 183, 2, None, 48.111, 16.574, "airport"),
        ("airport::fra", "Frankfurt Airport", "FRA", "Germany", 111, 4, None, 50.037, 8.551, "airport"),
    ]
    return spark.createDataFrame(rows, "__META_ID string, name string, iata string, country string, elevation long, runways long, helipads long, lat double, lon double, type string")


@pytest.fixture
def store(spark, tmp_path):
    from docweave.sources.snapshot import Store

    return Store(spark, f"file://{tmp_path}/store")
