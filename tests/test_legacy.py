"""Taking over a lake written with the old per-run names."""

import pytest

from strata.sources.layers import list_runs, read_run, resolve_run
from strata.sources.legacy import adopt_legacy_backups, adopt_legacy_runs, legacy_runs


@pytest.fixture
def old_lake(spark, tmp_path):
    base = tmp_path / "silver" / "LOCAL_PACIENTES"
    df = spark.createDataFrame([("Ana", "34")], "nombre string, edad string")
    df.write.parquet(str(base / "pacientes_refinados_202505140900.parquet"))
    df.union(df).write.parquet(str(base / "pacientes_refinados_202505151030.parquet"))
    (base / "notes.txt").write_text("not a run")
    bronze = tmp_path / "bronze" / "LOCAL_PACIENTES"
    df.write.option("header", True).csv(str(bronze / "pacientes_export_202505151030"))
    return tmp_path


def test_legacy_runs(spark, old_lake):
    runs = legacy_runs(spark, str(old_lake / "silver"), "pacientes")
    assert sorted(runs) == ["202505140900", "202505151030"]
    assert legacy_runs(spark, str(old_lake / "silver"), "pacientes", "20250515").keys() == {"202505151030"}
    assert legacy_runs(spark, str(old_lake / "silver"), "otro") == {}


def test_adopt_legacy_runs(spark, old_lake):
    dst = str(old_lake / "new-silver")
    assert adopt_legacy_runs(spark, str(old_lake / "silver"), dst, "pacientes") == ["202505151030", "202505140900"]
    assert list_runs(spark, dst, "pacientes") == ["202505151030", "202505140900"]
    assert resolve_run(spark, dst, "pacientes", "20250515") == "202505151030"
    assert read_run(spark, dst, "pacientes", "202505151030").count() == 2
    new_bronze = str(old_lake / "new-bronze")
    adopt_legacy_runs(spark, str(old_lake / "bronze"), new_bronze, "pacientes", "csv")
    assert read_run(spark, new_bronze, "pacientes", "202505151030", "csv").columns == ["nombre", "edad"]
    with pytest.raises(FileNotFoundError):
        adopt_legacy_runs(spark, str(old_lake / "silver"), dst, "otro")


def test_adopt_single_file_runs(spark, tmp_path):
    """Diamond kept each run as one copied Parquet file, not a folder."""
    import glob
    import shutil

    staging = tmp_path / "staging"
    spark.createDataFrame([("Ana", "34"), ("Bo", "40")], "nombre string, edad string") \
        .coalesce(1).write.parquet(str(staging))
    part = glob.glob(str(staging / "part-*.parquet"))[0]
    base = tmp_path / "diamond" / "LOCAL_PACIENTES"
    base.mkdir(parents=True)
    shutil.copy(part, base / "pacientes_refinados_202505151030.parquet")
    dst = str(tmp_path / "new-diamond")
    assert adopt_legacy_runs(spark, str(tmp_path / "diamond"), dst, "pacientes") == ["202505151030"]
    assert read_run(spark, dst, "pacientes", "202505151030").count() == 2


def test_adopt_takes_names_with_a_part_number(spark, tmp_path):
    base = tmp_path / "diamond" / "LOCAL_PACIENTES"
    spark.range(3).write.parquet(str(base / "pacientes_refinados_20250515103000000.parquet"))
    dst = str(tmp_path / "new")
    assert adopt_legacy_runs(spark, str(tmp_path / "diamond"), dst, "pacientes") == ["202505151030"]
    assert read_run(spark, dst, "pacientes", "202505151030").count() == 3


def test_adopt_loses_and_replaces_nothing(spark, tmp_path):
    src, dst = tmp_path / "silver", str(tmp_path / "new")
    base = src / "LOCAL_PACIENTES"
    spark.range(4).write.parquet(str(base / "a_202505151030.parquet"))
    assert adopt_legacy_runs(spark, str(src), dst, "pacientes") == ["202505151030"]
    with pytest.raises(FileExistsError):
        adopt_legacy_runs(spark, str(src), dst, "pacientes")
    spark.range(2).write.parquet(str(base / "a_202505151100.parquet"))
    assert adopt_legacy_runs(spark, str(src), dst, "pacientes", existing="skip") == ["202505151100"]
    assert read_run(spark, dst, "pacientes", "202505151030").count() == 4
    spark.range(9).write.parquet(str(base / "b_202505151030.parquet"))  # the same key again
    with pytest.raises(ValueError, match="several entries"):
        adopt_legacy_runs(spark, str(src), str(tmp_path / "other"), "pacientes")


def test_adopt_refuses_an_uncommitted_run(spark, tmp_path):
    base = tmp_path / "silver" / "LOCAL_PACIENTES"
    spark.range(4).write.parquet(str(base / "a_202505151030.parquet"))
    (base / "a_202505151030.parquet" / "_SUCCESS").unlink()
    with pytest.raises(ValueError, match="not committed"):
        adopt_legacy_runs(spark, str(tmp_path / "silver"), str(tmp_path / "new"), "pacientes")
    assert list_runs(spark, str(tmp_path / "new"), "pacientes") == []


def test_adopt_old_csv_backups(spark, tmp_path):
    folder = tmp_path / "lake" / "diamond"
    folder.mkdir(parents=True)
    (folder / "pacientes_diamond_202505151030.csv").write_text('nombre,nota\nAna,"dice ""hola""\nadios"\n')
    (folder / "otra_202505151030.csv").write_text("x\n1\n")
    dst = str(tmp_path / "new")
    assert adopt_legacy_backups(spark, str(tmp_path / "lake"), dst, "pacientes", "pacientes_diamond") == ["202505151030"]
    rows = read_run(spark, dst, "pacientes", "202505151030", "csv_quoted").collect()
    assert [tuple(r) for r in rows] == [("Ana", 'dice "hola"\nadios')]
