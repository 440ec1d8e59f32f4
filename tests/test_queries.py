"""Every registered query against its SQL on DuckDB."""

import glob
import importlib
import os

import duckdb
import pytest

from tests.conftest import DATA

entry = importlib.import_module("__spark_entry__")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    """One spelling for a value whichever client delivered it."""
    if value is None or value != value:
        return ""
    if isinstance(value, bool):
        return str(value)
    return f"{float(value):.10g}" if isinstance(value, (int, float)) else str(value)


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in data])


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(got.columns) == sorted(names)
    assert rows(got.columns, got.collect()) == rows(names, result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 1000


def test_reports_follow_the_files(spark, tmp_path):
    """Changed files and deleted stored tables lead to a new publication, unchanged ones do not."""
    from riskloom import storage
    from riskloom.catalog import queries

    for table in ("events", "customer", "nation"):
        spark.read.parquet(f"{DATA}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    events = spark.read.parquet(f"{DATA}/events.parquet")
    assert queries._bi_fact(spark, str(tmp_path)).count() == events.count()
    kept = dict(queries._REPORTS)
    queries._bi_fact(spark, str(tmp_path))
    assert queries._REPORTS == kept

    some = events.filter("event_id % 10 = 0")
    some.write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
    with storage.scratch_run(spark):
        assert queries._bi_fact(spark, str(tmp_path)).count() == some.count()
    assert queries._bi_fact(spark, str(tmp_path)).count() == some.count()
