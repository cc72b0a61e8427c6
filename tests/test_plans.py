"""Plan shapes the scale design relies on (checked with explain, not timings)."""

import pytest
from pyspark.sql import functions as F

from strata.operators.refine import APPOINTMENTS, refine
from strata.operators.runs import latest_run
from strata.session import checkpoint_root, scratch_dir
from strata.sources.layers import read_layer, read_run, write_run


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def bronze(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans") / "bronze")
    df = spark.createDataFrame([("Ana", "34", "OSDE", "2025-05-10 10:00:00")] * 3,
                               "nombre string, edad string, obra_social string, fecha_turno string")
    write_run(df, root, "pacientes", "202505151030", "csv")
    return root


def test_refine_pushes_blank_tests_into_csv_scan(spark, bronze):
    out = refine(read_run(spark, bronze, "pacientes", "202505151030", "csv"), APPOINTMENTS)
    plan = _plan(out)
    for f in ("IsNotNull(nombre)", "Not(EqualTo(nombre,))", "IsNotNull(obra_social)",
              "Not(EqualTo(obra_social,))"):
        assert f in plan
    assert out.count() == 1


def test_dedup_aggregates_before_the_shuffle(spark, bronze):
    out = refine(read_run(spark, bronze, "pacientes", "202505151030", "csv"), APPOINTMENTS)
    plan = out._jdf.queryExecution().executedPlan()
    text = plan.toString()
    # final HashAggregate <- Exchange hashpartitioning <- partial HashAggregate
    ex = text.index("Exchange hashpartitioning")
    assert text.rfind("HashAggregate", 0, ex) >= 0 and text.find("HashAggregate", ex) > ex
    assert "SinglePartition" not in text


def test_layer_latest_run_prunes_partitions(spark, tmp_path):
    root = str(tmp_path / "silver")
    for r in ("202505140900", "202505151030", "202505151045"):
        write_run(spark.range(5).withColumn("tag", F.lit(r)), root, "x", r)
    df = latest_run(read_layer(spark, root, "x"), "20250515")
    plan = _plan(df)
    assert "StartsWith(run_ts" in plan and "dynamicpruning" in plan
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan
    assert {r.tag for r in df.collect()} == {"202505151045"}


def test_scratch_lives_under_checkpoint_dir(spark):
    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    a, b = scratch_dir(spark, "q"), scratch_dir(spark, "q")
    assert a.startswith(root + "/strata/q-") and a != b


def _nodes(plan):
    yield plan
    kids = plan.children()
    for i in range(kids.size()):
        yield from _nodes(kids.apply(i))


def test_hot_duplicate_collapses_before_the_shuffle(spark):
    """A row repeated as a third of the input must cross the shuffle at most once per task."""
    n, tasks = 300_000, 6
    rows = spark.range(0, n, numPartitions=tasks).select(
        F.when(F.col("id") % 3 == 0, F.lit("Hot")).otherwise(F.concat(F.lit("p"), F.col("id").cast("string"))).alias("nombre"),
        F.lit("34").alias("edad"), F.lit("OSDE").alias("obra_social"),
        F.lit("2025-05-10 10:00:00").alias("fecha_turno"))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = refine(rows, APPOINTMENTS)
        assert out.count() == 1 + n - n // 3  # one hot row + every other distinct row
        out.collect()
        plan = out._jdf.queryExecution().executedPlan()
        shuffles = [p for p in _nodes(plan) if p.nodeName() == "Exchange"]
        written = sum(p.metrics().get("shuffleRecordsWritten").get().value() for p in shuffles)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert n - n // 3 <= written <= (n - n // 3) + tasks  # hot copies never cross the shuffle
