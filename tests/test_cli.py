"""The command line drives the same steps (called in-process with the test session)."""

import uuid

from strata.__main__ import main
from strata.sources.layers import read_run

RAW = ('nombre,edad,obra_social,fecha_turno\n'
       'Ana,34,OSDE,2025-05-10 10:30:00\n'
       'Bo,130,PAMI,2025-05-11\n')


def test_cli_steps(spark, tmp_path):
    raw = tmp_path / "pacientes_export.csv"
    raw.write_text(RAW)
    lake = tmp_path / "lake"
    b, s, d, g = (str(lake / x) for x in ("bronze", "silver", "diamond", "gold"))
    assert main(["ingest", "--raw", str(raw), "--bronze", b, "--run-ts", "202505151030"], spark) == \
        {"runs": {"pacientes": "202505151030"}}
    assert main(["refine", "--bronze", b, "--silver", s, "--domain", "pacientes",
                 "--run-ts", "202505151031"], spark) == {"run_ts": "202505151031"}
    assert main(["promote", "--silver", s, "--diamond", d, "--domain", "pacientes"], spark) == \
        {"run_ts": "202505151031"}
    name = f"p_{uuid.uuid4().hex[:8]}"
    out = main(["publish", "--diamond", d, "--gold", g, "--domain", "pacientes", "--run-ts",
                "202505151040", "--table", name, "--table-path", str(tmp_path / "t")], spark)
    assert out["created"] and out["source_run"] == "202505151031"
    assert read_run(spark, g, "pacientes", "202505151040").count() == 1
    assert spark.table(name).count() == 1


def test_cli_run_over_jdbc(spark, tmp_path):
    raw = tmp_path / "pacientes_export.csv"
    raw.write_text(RAW)
    url = f"jdbc:derby:memory:cli{uuid.uuid4().hex[:8]};create=true"
    out = main(["run", "--raw", str(raw), "--lake", str(tmp_path / "lake"), "--run-ts", "202505151030",
                "--jdbc-url", url, "--jdbc-property", "driver=org.apache.derby.iapi.jdbc.AutoloadedDriver",
                "--num-files", "1"], spark)
    assert out["created"] and out["table"] == "pacientes_diamond"
    back = (spark.read.format("jdbc").option("url", url).option("dbtable", "pacientes_diamond")
            .option("driver", "org.apache.derby.iapi.jdbc.AutoloadedDriver").load())
    assert [tuple(r)[:3] for r in back.collect()] == [("Ana", "34", "OSDE")]


def test_cli_stdout_is_one_json_line(spark, tmp_path, capsys):
    import json

    raw = tmp_path / "pacientes_export.csv"
    raw.write_text(RAW)
    main(["ingest", "--raw", str(raw), "--bronze", str(tmp_path / "b"), "--run-ts", "202505151030"], spark)
    out = capsys.readouterr().out.strip().splitlines()
    assert len(out) == 1
    assert json.loads(out[0]) == {"step": "ingest", "runs": {"pacientes": "202505151030"}}


def test_cli_ingest_landing(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    (land / "pacientes_a.csv").write_text(RAW)
    (land / "turnos_x.csv").write_text("id,sala\n1,A\n")
    out = main(["ingest", "--landing", str(land), "--bronze", str(tmp_path / "b"),
                "--run-ts", "202505151030"], spark)
    assert out == {"runs": {"pacientes": "202505151030", "turnos": "202505151030"}}
    assert read_run(spark, str(tmp_path / "b"), "turnos", "202505151030", "csv").count() == 1


def test_cli_refine_with_spec(spark, tmp_path):
    import json

    raw = tmp_path / "turnos_export.csv"
    raw.write_text("sala,dia\nA,2025-05-10 09:00\n,2025-05-10\nB,nope\nA,2025-05-10 11:00\n")
    spec = tmp_path / "spec.json"
    spec.write_text(json.dumps({"not_blank": ["sala"], "dates": ["dia"], "dedup": True}))
    b, s = str(tmp_path / "b"), str(tmp_path / "s")
    main(["ingest", "--raw", str(raw), "--bronze", b, "--run-ts", "202505151030"], spark)
    main(["refine", "--bronze", b, "--silver", s, "--domain", "turnos", "--run-ts", "202505151031",
          "--spec", str(spec)], spark)
    got = [tuple(r) for r in read_run(spark, s, "turnos", "202505151031").collect()]
    assert len(got) == 1 and got[0][0] == "A"


def test_spec_from_dict_rejects_unknown_keys():
    import pytest

    from strata.operators.refine import APPOINTMENTS, spec_from_dict

    assert spec_from_dict({"not_blank": ["nombre", "obra_social"], "int_ranges": [["edad", 0, 120]],
                           "dates": ["fecha_turno"]}) == APPOINTMENTS
    with pytest.raises(ValueError):
        spec_from_dict({"not_blank": ["a"], "typo": 1})
