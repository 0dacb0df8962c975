"""Every registered query against its DuckDB oracle, at the smallest scale."""

import os

import duckdb
import pytest
from pyspark.sql import types as T

import __spark_entry__ as E
import oracle_sql
from tools.check_oracle import TABLES, rows_of

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_query_has_an_oracle():
    assert set(E.QUERIES) == set(oracle_sql.FINAL) <= set(E.queries())


def test_double_lists_follow_the_spark_schemas(spark):
    feeds = E._Feeds(spark, SF_SMALL)
    for name, build in E.QUERIES.items():
        doubles = [f.name for f in build(feeds).schema.fields if isinstance(f.dataType, T.DoubleType)]
        assert oracle_sql.DOUBLES[name] == doubles, name


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = con.sql(E.oracle_sql()[name])
    assert sorted(df.columns) == sorted(res.columns)
    srows, orows = df.collect(), res.fetchall()
    assert len(srows) == len(orows) > 0  # a query without rows would compare nothing
    assert rows_of(df.columns, srows) == rows_of(res.columns, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "daily_summary_id" in df.columns


SPARK_TO_DUCKDB = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_column_types_match_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = con.sql(E.oracle_sql()[name])
    oracle_types = dict(zip(res.columns, [str(t) for t in res.types]))
    for f in df.schema.fields:
        assert SPARK_TO_DUCKDB.get(f.dataType.simpleString()) == oracle_types[f.name], (name, f.name)


def test_entry_module_loads_by_path_from_elsewhere(spark, tmp_path, monkeypatch):
    import importlib.util

    monkeypatch.chdir(tmp_path)
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("entry_by_path", path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    assert set(mod.QUERIES) <= set(mod.queries()) and set(mod.oracle_sql()) <= set(mod.queries())
    assert mod.queries()["check_duplicates"](spark, SF_SMALL).count() >= 0
