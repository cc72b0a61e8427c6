"""Publishing: create-if-absent (S10), retryable (S11), backup always (S12), types (§1.3)."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from strata.plans.pipeline import publish
from strata.sources.layers import list_runs, read_run, write_run
from strata.sources.tables import (
    JdbcTarget, jdbc_table_exists, publish_jdbc, publish_table, to_publishable,
)

DERBY_DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def _derby():
    # Embedded, in-memory: lives inside this JVM only, opens no port.
    url = f"jdbc:derby:memory:strata{uuid.uuid4().hex[:8]};create=true"
    return JdbcTarget(url, {"driver": DERBY_DRIVER}, num_partitions=2, batchsize=500)


def _read_jdbc(spark, target, table):
    return (spark.read.format("jdbc").option("url", target.url).option("dbtable", table)
            .option("driver", DERBY_DRIVER).load())


def test_to_publishable_types(spark):
    df = spark.sql("""SELECT 1 AS i, 'a' AS s, array(1.5f, -0.00073f) AS arr,
        named_struct('x', 1) AS st, map('k', 2) AS m, TIMESTAMP'2025-05-10 10:30:00' AS ts,
        DATE'2025-05-10' AS d, INTERVAL '2' DAY AS iv, CAST(1.25 AS DECIMAL(5,2)) AS dec""")
    out = to_publishable(df)
    assert out.columns == df.columns
    types = dict(out.dtypes)
    assert types["arr"] == types["st"] == types["m"] == types["iv"] == "string"
    assert types["ts"] == "timestamp_ntz" and types["d"] == "date" and types["dec"] == "decimal(5,2)"
    row = out.collect()[0]
    assert row.st == '{"x":1}' and row.m == '{"k":2}'
    assert row.ts == dt.datetime(2025, 5, 10, 10, 30)
    back = out.select(F.from_json("arr", "array<float>").alias("a")).collect()[0].a
    assert back == pytest.approx([1.5, -0.00073])


def test_publish_table_is_create_if_absent(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex[:8]}"
    first = spark.range(3).withColumnRenamed("id", "k")
    assert publish_table(first, name, str(tmp_path / name)) is True
    assert publish_table(spark.range(10).withColumnRenamed("id", "k"), name, str(tmp_path / name)) is False
    assert spark.table(name).count() == 3


def test_publish_table_failed_write_is_retryable(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex[:8]}"
    bad = spark.range(5).select(
        F.when(F.col("id") == 3, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("k"))
    with pytest.raises(Exception):
        publish_table(bad, name, str(tmp_path / name))
    assert not spark.catalog.tableExists(name)
    assert publish_table(spark.range(5).withColumnRenamed("id", "k"), name, str(tmp_path / name))
    assert spark.table(name).count() == 5


def test_publish_jdbc_create_if_absent(spark):
    target = _derby()
    df = spark.createDataFrame([("Ana", "34", dt.date(2025, 5, 10))], "nombre string, edad string, fecha_turno date")
    assert publish_jdbc(df, target, "pacientes_diamond") is True
    assert jdbc_table_exists(spark, target, "pacientes_diamond")
    assert not jdbc_table_exists(spark, target, "pacientes_diamond__staging")
    assert publish_jdbc(df.union(df), target, "pacientes_diamond") is False
    back = _read_jdbc(spark, target, "pacientes_diamond")
    assert back.count() == 1
    assert dict(back.dtypes)["fecha_turno"] == "date"


def test_jdbc_table_exists_is_exact(spark):
    from strata.sources.tables import _jdbc_execute

    target = _derby()
    _jdbc_execute(spark, target, "CREATE SCHEMA other")
    _jdbc_execute(spark, target, "CREATE TABLE other.pacientes_diamond (k INT)")
    _jdbc_execute(spark, target, "CREATE TABLE pacientesXdiamond (k INT)")
    assert not jdbc_table_exists(spark, target, "pacientes_diamond")  # other schema, or a LIKE match
    assert jdbc_table_exists(spark, target, "other.pacientes_diamond")
    assert jdbc_table_exists(spark, target, "pacientesxdiamond")
    assert publish_jdbc(spark.range(2).withColumnRenamed("id", "k"), target, "pacientes_diamond") is True


def test_publish_jdbc_failed_load_is_retryable(spark):
    target = _derby()
    bad = spark.range(5).select(
        F.when(F.col("id") == 3, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("k"))
    with pytest.raises(Exception):
        publish_jdbc(bad, target, "t")
    assert not jdbc_table_exists(spark, target, "t")  # nothing half-loaded under the real name
    assert publish_jdbc(spark.range(5).withColumnRenamed("id", "k"), target, "t") is True
    assert _read_jdbc(spark, target, "t").count() == 5


def test_publish_step_backs_up_even_when_skipped(spark, tmp_path):
    diamond, gold = str(tmp_path / "diamond"), str(tmp_path / "gold")
    df = spark.createDataFrame([("Ana", "34", "OSDE", dt.date(2025, 5, 10), [1.0, 2.0])],
                               "nombre string, edad string, obra_social string, fecha_turno date, v array<double>")
    write_run(df, diamond, "pacientes", "202505151030")
    name = f"pacientes_diamond_{uuid.uuid4().hex[:8]}"
    r1 = publish(spark, diamond, gold, "pacientes", "20250515", table=name,
                 table_path=str(tmp_path / "t"), run_ts="202505151100")
    r2 = publish(spark, diamond, gold, "pacientes", "20250515", table=name,
                 table_path=str(tmp_path / "t"), run_ts="202505151200")
    assert (r1.created, r2.created) == (True, False)
    assert list_runs(spark, gold, "pacientes") == ["202505151200", "202505151100"]
    assert read_run(spark, gold, "pacientes", "202505151200").dtypes == df.dtypes
    assert dict(spark.table(name).dtypes)["v"] == "string"
    with pytest.raises(FileNotFoundError):
        publish(spark, diamond, gold, "pacientes", "20250101", table=name)


def test_publish_csv_backup_variant(spark, tmp_path):
    silver, diamond = str(tmp_path / "silver"), str(tmp_path / "diamond")
    df = spark.createDataFrame([("Ana", [1, 2])], "nombre string, v array<int>")
    write_run(df, silver, "pacientes", "202505151030")
    res = publish(spark, silver, diamond, "pacientes", "20250515", jdbc=_derby(),
                  backup_format="csv", run_ts="202505151031")
    assert res.table == "pacientes_diamond" and res.created
    back = read_run(spark, diamond, "pacientes", res.backup_run, "csv").collect()
    assert tuple(back[0]) == ("Ana", "[1,2]")


def _pg_type(spark, dt_json):
    """DDL type Spark's PostgreSQL dialect (or its common fallback) gives a Spark type."""
    jvm = spark.sparkContext._jvm
    jtype = jvm.org.apache.spark.sql.types.DataType.fromJson(dt_json)
    dialect = jvm.org.apache.spark.sql.jdbc.JdbcDialects.get("jdbc:postgresql://h/db")
    opt = dialect.getJDBCType(jtype)
    if opt.isEmpty():
        opt = jvm.org.apache.spark.sql.execution.datasources.jdbc.JdbcUtils.getCommonJDBCType(jtype)
    return opt.get().databaseTypeDefinition()


def test_postgres_ddl_after_to_publishable(spark):
    """SURVEY §1.3, 'our rule' column: what each type becomes in PostgreSQL."""
    df = spark.sql("""SELECT 'a' AS s, 1 AS i, 2L AS l, CAST(3 AS SMALLINT) AS sh, 1.5D AS d,
        1.5F AS f, true AS b, DATE'2025-05-10' AS dt, TIMESTAMP'2025-05-10 10:30:00' AS ts,
        CAST(1.25 AS DECIMAL(5,2)) AS dec, array(1, 2) AS arr, named_struct('x', 1) AS st,
        map('k', 1) AS m, INTERVAL '2' DAY AS iv""")
    got = {f.name: _pg_type(spark, f.dataType.json()) for f in to_publishable(df).schema.fields}
    assert got == {
        "s": "TEXT", "i": "INTEGER", "l": "BIGINT", "sh": "SMALLINT", "d": "FLOAT8",
        "f": "FLOAT4", "b": "BOOLEAN", "dt": "DATE", "ts": "TIMESTAMP", "dec": "NUMERIC(5,2)",
        "arr": "TEXT", "st": "TEXT", "m": "TEXT", "iv": "TEXT",
    }


def test_publish_transform_hook_shapes_table_and_backup(spark, tmp_path):
    diamond, gold = str(tmp_path / "diamond"), str(tmp_path / "gold")
    df = spark.createDataFrame([("Ana", "OSDE"), ("Bo", "OSDE"), ("Cy", "PAMI")],
                               "nombre string, obra_social string")
    write_run(df, diamond, "pacientes", "202505151030")
    name = f"t_{uuid.uuid4().hex[:8]}"

    def per_insurer(d):
        return d.groupBy("obra_social").agg(F.count("*").alias("n"))

    res = publish(spark, diamond, gold, "pacientes", "20250515", table=name,
                  table_path=str(tmp_path / "t"), run_ts="202505151100", transform=per_insurer)
    want = [("OSDE", 2), ("PAMI", 1)]
    assert sorted(tuple(r) for r in spark.table(name).collect()) == want
    assert sorted(tuple(r) for r in read_run(spark, gold, "pacientes", res.backup_run).collect()) == want


def test_publish_recovers_from_files_left_by_a_dead_driver(spark, tmp_path):
    silver, gold = str(tmp_path / "s"), str(tmp_path / "g")
    write_run(spark.range(3), silver, "x", "202505151030")
    name = f"left_{uuid.uuid4().hex[:8]}"
    spark.range(99).write.parquet(f"{gold}/_tables/{name}")  # files, but no table
    res = publish(spark, silver, gold, "x", table=name)
    assert res.created and spark.table(name).count() == 3
    assert read_run(spark, gold, "x", res.backup_run).count() == 3


def test_jdbc_publish_checks_the_staging_count(spark, tmp_path, monkeypatch):
    from strata.sources import tables

    target = _derby()
    monkeypatch.setattr(tables, "_jdbc_count", lambda *a: 6)  # as if a task had inserted its rows twice
    with pytest.raises(RuntimeError, match="not published"):
        publish_jdbc(spark.range(3), target, "doubled")
    assert not jdbc_table_exists(spark, target, "doubled")
    monkeypatch.undo()
    assert publish_jdbc(spark.range(3), target, "doubled") is True
    assert _read_jdbc(spark, target, "doubled").count() == 3
