"""A session for all tests, and an independent comparison of queries with their SQL."""

import math
import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def folder():
    d = pathlib.Path("/root/testdata/sf0.001")
    if not d.exists():
        pytest.skip("no test tables here")
    return str(d)


@pytest.fixture(scope="session")
def oracle(folder):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in pathlib.Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def plain(v):
    """A value in a form that both engines share."""
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "as_tuple"):
        return float(f"{float(v):.9g}")
    if hasattr(v, "tzinfo"):
        return v.replace(tzinfo=None)
    return v
