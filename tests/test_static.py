"""Scale rules the library code must keep (checked on the source text)."""

import pathlib
import re
import shutil
import subprocess
import sys

LIB = pathlib.Path(__file__).resolve().parent.parent / "strata"
SOURCES = [p for p in LIB.rglob("*.py") if "llm" not in p.relative_to(LIB).parts]
FORBIDDEN = {
    r"\.collect\(": "pulls rows to the driver",
    r"\.toPandas\(": "pulls rows to the driver",
    r"crossJoin|how=\"cross\"": "cross join",
    r"\budf\b|pandas_udf": "row-at-a-time / Python UDF in the hot path",
    r"localCheckpoint": "lineage cut on executor-local storage",
    r"\.limit\(": "row cap",
    r"\.sample\(": "row sampling",
    r"coalesce\(1\)|repartition\(1\)": "funnels data through one task",
}


def test_library_keeps_scale_rules():
    hits = []
    for path in SOURCES:
        for n, line in enumerate(path.read_text().splitlines(), 1):
            code = line.split("#", 1)[0]
            for pat, why in FORBIDDEN.items():
                if re.search(pat, code):
                    hits.append(f"{path.relative_to(LIB.parent)}:{n}: {why}: {line.strip()}")
    assert not hits, "\n".join(hits)


def test_only_one_row_is_ever_broadcast():
    """Every broadcast() in the library wraps a global (ungrouped) aggregate."""
    found = 0
    for path in SOURCES:
        src = path.read_text()
        for m in re.finditer(r"F\.broadcast\((\w+)\)", src):
            var = m.group(1)
            assign = re.search(rf"{var} = \(\s*df\.filter\([^\n]*\)\s*\.agg\(", src)
            assert assign, f"{path.name}: broadcast of {var} is not a global aggregate"
            found += 1
    assert found >= 1


def test_library_does_not_import_the_corpus_operators():
    for path in SOURCES:
        assert "strata.llm" not in path.read_text(), path


def test_the_library_works_without_the_corpus_operators(tmp_path):
    """Without strata/llm the entry module still has the library's queries, also where corpus_pipeline.py is left behind."""
    root = LIB.parent
    shutil.copytree(LIB, tmp_path / "strata", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("from strata.llm import decontam\n")
    code = "import __spark_entry__ as e; from strata.plans.queries import QUERIES as q; assert set(e.queries()) == set(q) == set(e.oracle_sql())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin"})
