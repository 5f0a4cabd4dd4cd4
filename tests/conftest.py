import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.abspath(__file__))) + os.pathsep + os.environ.get("PYTHONPATH", "")

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", "file://" + str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


def duck(sql, sf_dir, tables=()):
    """Rows of a DuckDB query over the tables of a folder."""
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        con.execute(f"create view {f.removesuffix('.parquet')} as select * from '{sf_dir}/{f}'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    return names, found.fetchall()


def same(df, sql, sf_dir):
    """Fail unless the DataFrame's rows are those of the DuckDB query, in any order."""
    names, want = duck(sql, sf_dir)
    assert sorted(df.columns) == sorted(names)
    order = sorted(names)
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    got = sorted((tuple(plain(r[c]) for c in order) for r in df.collect()), key=repr)
    at = [names.index(c) for c in order]
    assert got == sorted((tuple(plain(r[i]) for i in at) for r in want), key=repr)
