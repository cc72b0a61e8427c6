"""Every registered query against its DuckDB oracle on the smallest tables."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as entry_mod
from strata.plans import queries
from strata.plans.views import TABLES
from tests.conftest import SF_SMALL
from tools.check_oracle import SPARK_TO_DUCK

QUERIES = queries.QUERIES
ORACLES = queries.ORACLE_SQL


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.6g}"
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S.%f")
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["nombre", "edad", "obra_social", "fecha_turno"]
    assert df.count() > 0


def test_every_library_query_is_registered():
    assert set(QUERIES) <= set(entry_mod.queries())
    assert set(ORACLES) <= set(entry_mod.oracle_sql())


def test_every_query_has_an_oracle_or_is_listed():
    rows_only = set(QUERIES) - set(ORACLES)
    assert rows_only == set()
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = df.collect()
    assert len(got) > 0
    if name not in ORACLES:
        return
    rel = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    spark_types = {n: SPARK_TO_DUCK.get(t, t).upper() for n, t in df.dtypes}
    assert spark_types == {n: str(t).upper() for n, t in zip(rel.columns, rel.types)}
    assert _rows(df.columns, got) == _rows(rel.columns, rel.fetchall())


ODD_SESSION = {
    "spark.sql.ansi.enabled": "false",
    "spark.sql.legacy.timeParserPolicy": "LEGACY",
    "spark.sql.shuffle.partitions": "200",
    "spark.sql.session.timeZone": "Asia/Kolkata",
}


@pytest.mark.parametrize("name", ["refine_appointments", "date_prefix", "int_range", "raw_to_gold"])
def test_results_do_not_depend_on_session_settings(spark, name):
    base = sorted(map(tuple, QUERIES[name](spark, SF_SMALL).collect()))
    old = {k: spark.conf.get(k, None) for k in ODD_SESSION}
    for k, v in ODD_SESSION.items():
        spark.conf.set(k, v)
    try:
        odd = sorted(map(tuple, QUERIES[name](spark, SF_SMALL).collect()))
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert odd == base
