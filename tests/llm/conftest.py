import pandas as pd
import pytest

ODD = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def table_of():
    """A table of sf0.001 as pandas."""
    return lambda name: pd.read_parquet(f"/root/testdata/sf0.001/{name}.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with nulls everywhere, empty, long and repeated texts, tied ids."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [
        (1, "one two three four five six seven", "en", "a", 1),
        (1, "one two three four five six seven", "en", "a", 1),
        (2, None, None, None, None),
        (3, "", "en", "b", 0),
        (4, " \t\n\x0b ", "en", "b", 4),
        (None, "a null id here", "en", None, 3),
        (None, None, None, None, None),
        (5, long, "en", "c", len(long)),
        (6, long, "en", "a", len(long)),
        (7, "Ünïcödé 梦   🦀 é", "xx", "a", 9),
        (5, "another text of id five", "en", "a", 5),
    ]
    return spark.createDataFrame(rows, ODD)


@pytest.fixture(scope="session")
def folder_of(tmp_path_factory):
    """Writes DataFrames as a folder of tables, which the queries read."""

    def put(**tables):
        root = tmp_path_factory.mktemp("tables")
        for name, df in tables.items():
            df.coalesce(2).write.parquet(f"{root}/{name}.parquet")
        return str(root)

    return put
