"""Every core query against its DuckDB twin."""

import duckdb
import pytest

import __spark_entry__ as E
from tagloom.plans.catalog import ORACLE_SQL, QUERIES
from tagloom.plans.jobs import JOB_ORACLE_SQL, JOB_QUERIES
from tagloom.sources.testdata import TABLES

from conftest import SF_MID, SF_SMALL

SQL = ORACLE_SQL | JOB_ORACLE_SQL
RUN = QUERIES | JOB_QUERIES
# Trainers are also run on the larger tables, where hold-outs hold both labels.
LARGER = ["train_svm_all_tags", "train_svm_embeddings", "label_all_tags", "train_job_incremental"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(round(v, 9) + 0.0)
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


def _duck(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def duck():
    return {folder: _duck(folder) for folder in (SF_SMALL, SF_MID)}


def _check(spark, duck, name, folder):
    df = RUN[name](spark, folder)
    res = duck[folder].execute(SQL[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    got = _rows(df.columns, df.collect())
    assert got == _rows(ocols, res.fetchall()) and got


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    _check(spark, duck, name, SF_SMALL)


@pytest.mark.parametrize("name", LARGER)
def test_query_matches_oracle_on_larger_tables(spark, duck, name):
    _check(spark, duck, name, SF_MID)


def test_every_core_query_has_an_oracle():
    assert sorted(RUN) == sorted(SQL)
    assert set(RUN) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "fraction" in df.columns
