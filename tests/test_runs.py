"""Run keys, latest-run selection (lazy and listing-based), run-scoped overwrite."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata.operators.runs import check_run, domain_of, latest_run, run_of_path, run_stamp
from strata.sources.layers import (
    committed_runs, list_runs, read_layer, read_run, resolve_run, run_dir, write_run, write_runs,
)

RUNS = ["202505140900", "202505151030", "202505151045"]


def test_run_stamp_and_domain():
    assert run_stamp(dt.datetime(2025, 5, 15, 10, 30, 59)) == "202505151030"
    assert domain_of("/opt/data/csv/pacientes_export.csv") == "pacientes"
    assert domain_of("s3a://bucket/in/Pacientes_Export.csv/") == "pacientes"
    assert domain_of("turnos.csv") == "turnos"
    with pytest.raises(ValueError):
        check_run("2025051510")
    for bad in ("", "a/b", "a=b", " a"):
        with pytest.raises(ValueError):
            run_dir("/lake", bad, "202505151030")


def _frame(spark):
    rows = [(i, r) for r in RUNS for i in range(3 + RUNS.index(r))]
    return spark.createDataFrame(rows, "id int, run_ts string")


def test_latest_run_lazy(spark):
    df = _frame(spark)
    assert {r.run_ts for r in latest_run(df, "20250515").collect()} == {"202505151045"}
    assert latest_run(df, "20250515").count() == 5
    assert {r.run_ts for r in latest_run(df, "20250514").collect()} == {"202505140900"}
    assert {r.run_ts for r in latest_run(df).collect()} == {"202505151045"}
    assert latest_run(df, "20250101").count() == 0


def test_latest_run_plan_is_broadcast_semi_join(spark):
    plan = latest_run(_frame(spark), "20250515")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


@pytest.fixture
def layer(spark, tmp_path):
    root = str(tmp_path / "silver")
    for i, r in enumerate(RUNS):
        df = spark.range(10 * (i + 1)).select(F.col("id"), F.lit(r).alias("tag"))
        write_run(df, root, "pacientes", r)
    return root


def test_resolve_run_listing(spark, layer):
    assert list_runs(spark, layer, "pacientes") == sorted(RUNS, reverse=True)
    assert resolve_run(spark, layer, "pacientes", "20250515") == "202505151045"
    assert resolve_run(spark, layer, "pacientes", "20250514") == "202505140900"
    assert resolve_run(spark, layer, "pacientes") == "202505151045"
    with pytest.raises(FileNotFoundError):
        resolve_run(spark, layer, "pacientes", "20250101")
    with pytest.raises(FileNotFoundError):
        resolve_run(spark, layer, "otro")


def test_resolve_run_skips_run_without_data(spark, layer):
    os.makedirs(run_dir(layer, "pacientes", "202505152359").replace("file:", ""))
    assert resolve_run(spark, layer, "pacientes", "20250515") == "202505151045"


def test_resolve_run_skips_uncommitted_run(spark, layer):
    partial = run_dir(layer, "pacientes", "202505152358")
    os.makedirs(partial)
    with open(os.path.join(partial, "part-00000-x.parquet"), "wb") as fh:
        fh.write(b"half")
    assert resolve_run(spark, layer, "pacientes", "20250515") == "202505151045"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.setBoolean("mapreduce.fileoutputcommitter.marksuccessfuljobs", False)
    try:  # writers that leave no marker: any part file counts
        assert resolve_run(spark, layer, "pacientes", "20250515") == "202505152358"
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_read_run_reads_all_files_of_the_run(spark, layer):
    df = read_run(spark, layer, "pacientes", "202505151030")
    assert df.count() == 20 and df.columns == ["id", "tag"]
    df = read_run(spark, layer, "pacientes", "202505151030", with_run_ts=True)
    assert {r.run_ts for r in df.collect()} == {"202505151030"}


def test_overwrite_replaces_only_that_run(spark, layer):
    write_run(spark.range(2).select("id", F.lit("new").alias("tag")), layer, "pacientes", "202505151030")
    assert read_run(spark, layer, "pacientes", "202505151030").count() == 2
    assert read_run(spark, layer, "pacientes", "202505140900").count() == 10
    assert read_run(spark, layer, "pacientes", "202505151045").count() == 30


def test_read_layer_keeps_run_ts_text_and_prunes(spark, layer):
    df = read_layer(spark, layer, "pacientes")
    assert dict(df.dtypes)["run_ts"] == "string"
    assert df.count() == 60
    latest = latest_run(df, "20250515")
    assert latest.count() == 30
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "StartsWith(run_ts" in plan  # static pruning of the max side


def test_run_of_path(spark, layer):
    files = spark.read.option("recursiveFileLookup", True).parquet(f"{layer}/LOCAL_PACIENTES")
    got = files.select(run_of_path(F.col("_metadata.file_path")).alias("r"), "tag").distinct().collect()
    assert all(r.r == r.tag for r in got) and len(got) == 3


def test_num_files(spark, tmp_path):
    root = str(tmp_path / "l")
    path = write_run(spark.range(1000).repartition(4), root, "x", RUNS[0], num_files=1)
    parts = [f for f in os.listdir(path.replace("file:", "")) if f.startswith("part-")]
    assert len(parts) == 1


def test_failed_write_never_becomes_latest(spark, layer):
    bad = spark.range(100).select(
        F.when(F.col("id") == 57, F.raise_error(F.lit("boom"))).otherwise(F.col("id")).alias("id"),
        F.lit("x").alias("tag"))
    with pytest.raises(Exception):
        write_run(bad, layer, "pacientes", "202505152300")
    assert resolve_run(spark, layer, "pacientes", "20250515") == "202505151045"
    assert resolve_run(spark, layer, "pacientes") == "202505151045"


def test_read_layer_csv(spark, tmp_path):
    root = str(tmp_path / "bronze")
    for r in ("202505140900", "202505151030"):
        write_run(spark.createDataFrame([("Ana", r)], "nombre string, tag string"), root, "p", r, "csv")
    df = read_layer(spark, root, "p", "csv")
    assert df.dtypes == [("nombre", "string"), ("tag", "string"), ("run_ts", "string")]
    assert sorted(tuple(r) for r in latest_run(df).collect()) == [("202505151030", "Ana", "202505151030")]


def test_read_layer_and_resolve_run_agree(spark, layer):
    partial = run_dir(layer, "pacientes", "202505152359")
    spark.range(7).withColumn("tag", F.lit("x")).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(partial)
    assert resolve_run(spark, layer, "pacientes") == "202505151045"
    assert {r.run_ts for r in latest_run(read_layer(spark, layer, "pacientes")).collect()} == {"202505151045"}
    with pytest.raises(FileNotFoundError):
        read_layer(spark, layer, "otro")


def test_read_layer_has_the_columns_of_all_runs(spark, tmp_path):
    root = str(tmp_path / "l")
    write_run(spark.range(2), root, "x", RUNS[0])
    write_run(spark.range(3).withColumn("extra", F.lit("e")), root, "x", RUNS[1])
    df = read_layer(spark, root, "x")
    assert sorted(df.columns) == ["extra", "id", "run_ts"]
    assert df.filter("extra is null").count() == 2 and df.count() == 5


def test_write_runs_writes_and_commits_every_run(spark, tmp_path):
    root = str(tmp_path / "l")
    write_run(spark.range(9), root, "x", RUNS[0])
    rows = spark.range(10).withColumn("run_ts", F.when(F.col("id") < 4, RUNS[1]).otherwise(RUNS[2]))
    assert write_runs(rows, root, "x") == sorted(RUNS[1:], reverse=True)
    assert committed_runs(spark, root, "x") == sorted(RUNS, reverse=True)
    assert read_run(spark, root, "x", RUNS[1]).count() == 4 and read_run(spark, root, "x", RUNS[0]).count() == 9
    with pytest.raises(Exception, match="not a run key"):
        write_runs(rows.withColumn("run_ts", F.lit("2025")), root, "y")
