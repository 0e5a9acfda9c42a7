import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from scrollspark.session import create

    session = create("tests", os.environ.get("TEST_MASTER", "local[4]"), spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g", spark__ui__showConsoleProgress="false")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    """Values of Spark and DuckDB in one form."""
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def rows_of(df) -> list[tuple]:
    names = sorted(df.columns)
    return sorted((tuple(plain(r[c]) for c in names) for r in df.collect()), key=repr)


def rows_of_sql(con, sql: str) -> list[tuple]:
    found = con.sql(sql)
    order = sorted(range(len(found.columns)), key=lambda i: found.columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found.fetchall()), key=repr)
