import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from logwise.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session(
        "local[4]",
        app_name="logwise-tests",
        shuffle_partitions=8,
        extra={"spark.ui.showConsoleProgress": "false"},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path_factory):
    return str(tmp_path_factory.mktemp("run"))


@pytest.fixture(scope="session")
def duck():
    import duckdb

    def make(sf_dir):
        con = duckdb.connect()
        for t in TABLES:
            p = f"{sf_dir}/{t}.parquet"
            if os.path.exists(p):
                con.execute(f"create view {t} as select * from read_parquet('{p}')")
        return con

    return make


def rows(df):
    """Rows of a Spark DataFrame as sorted tuples of comparable values."""
    return sorted(tuple(_norm(v) for v in r) for r in df.collect())


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, list):
        return tuple(v)
    return v


def write_lines(folder, name, lines, mtime=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        for line in lines:
            f.write(line + "\n")
    if mtime is not None:
        os.utime(path, (mtime, mtime))
    return path
