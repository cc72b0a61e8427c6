"""Edge cases of naming and argument checks."""

import pytest
from pyspark.sql import functions as F

from strata.operators.runs import domain_of, latest_run, run_of_path
from strata.sources.layers import list_landing, write_run


@pytest.mark.parametrize("path,domain", [
    ("pacientes.csv", "pacientes"),
    ("/in/Pacientes-2025_x.csv", "pacientes-2025"),
    ("s3a://b/in/turnos_a_b.csv/", "turnos"),
    ("hdfs:///in/TURNOS", "turnos"),
    ("/in/Turnos.csv.gz", "turnos"),
    ("/in/turnos_b.CSV", "turnos"),
])
def test_domain_of(path, domain):
    assert domain_of(path) == domain


def test_list_landing_takes_every_csv_spelling_and_refuses_the_rest(spark, tmp_path):
    for name in ("a_x.csv", "_b_x.csv", ".c_x.csv", "e_x.CSV", "f_x.csv.gz", "g.Csv.bz2"):
        (tmp_path / name).write_text("h\n1\n")
    got = [p.rsplit("/", 1)[1] for p in list_landing(spark, str(tmp_path))]
    assert got == ["a_x.csv", "e_x.CSV", "f_x.csv.gz", "g.Csv.bz2"]
    (tmp_path / "d_x.txt").write_text("h\n1\n")
    with pytest.raises(ValueError, match="d_x.txt"):
        list_landing(spark, str(tmp_path))
    assert list_landing(spark, str(tmp_path / "missing")) == []


def test_argument_checks(spark, tmp_path):
    df = spark.range(1).withColumn("run_ts", F.lit("202505151030"))
    with pytest.raises(ValueError):
        latest_run(df, day="2025-05-15")
    with pytest.raises(ValueError):
        write_run(spark.range(1), str(tmp_path), "x", "202505151030", num_files=0)
    with pytest.raises(ValueError):
        write_run(spark.range(1), str(tmp_path), "x", "202505151030", fmt="json")
    with pytest.raises(ValueError):
        write_run(spark.range(1), str(tmp_path), "x", "2025-05-15")


def test_run_of_path_only_takes_whole_keys(spark):
    paths = ["s3a://l/LOCAL_P/run_ts=202505151030/part-0.parquet", "/l/run_ts=2025051510/part-0",
             "/l/run_ts=2025051510301/part-0", "/l/x/part-0", "/l/LOCAL_P/run_ts=202505151030"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r.k for r in df.select(run_of_path("p").alias("k")).collect()]
    assert got == ["202505151030", None, None, None, "202505151030"]
