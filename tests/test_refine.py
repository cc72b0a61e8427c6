"""The refinement operator: rule order, retyping, whole-row dedup (S1-S5)."""

import datetime as dt

from strata.operators.refine import APPOINTMENTS, RefineSpec, refine

SCHEMA = "nombre string, edad string, obra_social string, fecha_turno string"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_appointments_rules(spark, ansi):
    raw = [
        ("Ana", "34", "OSDE", "2025-05-10 10:30:00"),
        ("Ana", "34", "OSDE", "2025-05-10 11:00:00"),  # same day: collapses (S5)
        ("", "34", "OSDE", "2025-05-10"),  # blank name
        (None, "34", "OSDE", "2025-05-10"),
        ("Bo", "30.5", "PAMI", "2025-05-11"),  # fraction truncated, kept
        ("Cy", "120", "PAMI", "2025-05-11"),  # upper bound exclusive
        ("Di", "0", "PAMI", "2025-05-11"),  # lower bound exclusive
        ("Ed", "abc", "PAMI", "2025-05-11"),
        ("Fe", "50", "", "2025-05-11"),  # blank insurer
        ("Gi", "50", "IOMA", "2025-5-1"),  # bad date
        ("Hu", "50", "IOMA", "sin fecha"),
        ("Iv", " 45 ", "IOMA", "2025-05-12"),
    ]
    out = refine(spark.createDataFrame(raw, SCHEMA), APPOINTMENTS)
    assert out.columns == ["nombre", "edad", "obra_social", "fecha_turno"]
    assert dict(out.dtypes)["edad"] == "string"  # compared as number, kept as text
    assert dict(out.dtypes)["fecha_turno"] == "date"
    assert _rows(out) == [
        ("Ana", "34", "OSDE", dt.date(2025, 5, 10)),
        ("Bo", "30.5", "PAMI", dt.date(2025, 5, 11)),
        ("Iv", " 45 ", "IOMA", dt.date(2025, 5, 12)),
    ]


def test_dedup_counts_nulls_equal_and_all_columns(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "a")], "k int, v string")
    assert refine(df, RefineSpec(dedup=True)).count() == 2
    assert refine(df, RefineSpec(dedup=False)).count() == 3


def test_extra_columns_pass_through_and_join_dedup(spark):
    raw = [("Ana", "34", "OSDE", "2025-05-10", "x"), ("Ana", "34", "OSDE", "2025-05-10", "y")]
    df = spark.createDataFrame(raw, SCHEMA + ", extra string")
    out = refine(df, APPOINTMENTS)
    assert out.columns[-1] == "extra" and out.count() == 2


def test_single_filter_and_partial_aggregate(spark):
    df = spark.createDataFrame([("Ana", "34", "OSDE", "2025-05-10")], SCHEMA)
    plan = refine(df, APPOINTMENTS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Filter") == 1
    assert plan.count("HashAggregate") == 2  # partial (map side) + final
