import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
    at = tmp_path_factory.mktemp("spark")
    s = (
        SparkSession.builder.master(os.environ.get("TEST_MASTER", "local[4]"))
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{at}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{at}/warehouse")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def duck(data):
    import duckdb

    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    return c


def _plain(v):
    if hasattr(v, "asDict"):
        v = v.asDict()
    if isinstance(v, dict):
        return {k: _plain(x) for k, x in v.items()}
    if isinstance(v, (list, tuple)):
        return [_plain(x) for x in v]
    return v


@pytest.fixture(scope="session")
def same():
    """Whether a DataFrame and a DuckDB relation hold the same rows."""

    def check(df, rel):
        cols = sorted(df.columns)
        assert cols == sorted(rel.columns)
        at = [rel.columns.index(c) for c in cols]
        got = sorted(repr([_plain(r[c]) for c in cols]) for r in df.collect())
        want = sorted(repr([_plain(r[i]) for i in at]) for r in rel.fetchall())
        assert got == want

    return check
