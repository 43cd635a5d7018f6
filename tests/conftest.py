import glob
import os
import sys
from collections import Counter

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plain(v):
    if isinstance(v, float):
        return "nan" if v != v else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


@pytest.fixture(scope="session")
def small():
    if not os.path.isdir(SMALL):
        pytest.skip("no test tables here")
    return SMALL


@pytest.fixture(scope="session")
def duck(small):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.fixture(scope="session")
def agree(spark, small, duck):
    """Checks that a query and its SQL give the same rows; without SQL, that ``holds``, a function of the rows and the test
    tables' connection, is true of them."""

    def check(query, sql, holds=None):
        df = query(spark, small)
        if sql is None:
            rows = [r.asDict(recursive=True) for r in df.collect()]
            assert rows and holds(rows, duck)
            return True
        cols = sorted(df.columns)
        rows = Counter(repr(tuple(plain(x) for x in r)) for r in df.select(*cols).collect())
        cur = duck.execute(sql)
        names = [d[0] for d in cur.description]
        assert sorted(names) == cols
        at = [names.index(c) for c in cols]
        want = Counter(repr(tuple(plain(r[i]) for i in at)) for r in cur.fetchall())
        assert rows == want, (list((rows - want).items())[:3], list((want - rows).items())[:3])
        return True

    return check
