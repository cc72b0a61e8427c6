"""Kept and rejected rows from one pass: together the input, each rejected row with the rules it breaks."""

import datetime as dt
import itertools
import pathlib

import pytest
from pyspark.sql import functions as F

from strata.operators.refine import RefineSpec, broken_rules, refine, rule_names, rules_of
from strata.plans.pipeline import refine_latest, refine_with_rejects
from strata.sources.layers import domain_dir, drop_run, list_runs, read_run, write_run

RUN, OUT = "202505151030", "202505151045"
SPEC = RefineSpec(not_blank=("nombre", "obra"), int_ranges=(("edad", 0, 120),), dates=("fecha",))
NAMES = ["not_blank:nombre", "not_blank:obra", "int_range:edad:0:120", "date:fecha"]
SCHEMA = "nombre string, obra string, edad string, fecha string"
GOOD, BAD = ("Ana", "OSDE", "34", "2025-05-10 10:30"), ([None], [None], [None, "x", "0", "120"], [None, "2025-02-30", "2025-5-1"])


def every_mix():
    """(row, names of the rules it breaks) for all mixes of good and bad fields."""
    fields = [[(g, None)] + [(b, n) for b in bad] for g, bad, n in zip(GOOD, BAD, NAMES)]
    return [(tuple(v for v, _ in mix), [n for _, n in mix if n]) for mix in itertools.product(*fields)]


@pytest.fixture
def roots(tmp_path):
    return [str(tmp_path / layer) for layer in ("bronze", "silver", "rejects")]


def split(spark, roots, rows, spec=SPEC, schema=SCHEMA):
    write_run(spark.createDataFrame(rows, schema), roots[0], "p", RUN, "csv")
    return refine_with_rejects(spark, *roots, "p", spec, run_ts=OUT)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_broken_rules_say_what_refine_drops(spark, ansi):
    mixes = every_mix()
    df = spark.createDataFrame([row for row, _ in mixes] + [("", "", "", "")], SCHEMA)
    assert list(rules_of(SPEC)) == NAMES
    named = {tuple(r)[:4]: r.names for r in df.withColumn("names", rule_names(broken_rules(SPEC), SPEC)).collect()}
    assert named == {**{row: names for row, names in mixes}, ("", "", "", ""): NAMES}
    assert df.filter(broken_rules(SPEC) == 0).count() == refine(df, RefineSpec(**{**vars(SPEC), "dedup": False})).count() == 1


def test_kept_and_rejected_are_the_input(spark, roots):
    mixes = every_mix()
    rows = [row for row, _ in mixes] + [GOOD, GOOD, mixes[-1][0]]
    res = split(spark, roots, rows)
    assert (res.run_ts, res.kept, res.rejected) == (OUT, 3, len(rows) - 3)
    assert res.by_rule == {n: sum(n in names for _, names in mixes) + 1 for n in NAMES}
    assert rows_of(read_run(spark, roots[1], "p", OUT)) == [("Ana", "OSDE", "34", dt.date(2025, 5, 10))]
    rejects = read_run(spark, roots[2], "p", OUT)
    assert rejects.columns == [*SCHEMA.replace(" string", "").split(", "), "broken"]
    got = rows_of(rejects.select(*rejects.columns[:4], rule_names("broken", SPEC).alias("names")))
    assert got == sorted([(*row, names) for row, names in mixes if names] + [(*mixes[-1][0], NAMES)], key=str)


@pytest.mark.parametrize("dedup", [True, False])
def test_the_silver_run_is_that_of_refine_latest(spark, roots, tmp_path, dedup):
    spec = RefineSpec(**{**vars(SPEC), "dedup": dedup})
    split(spark, roots, [row for row, _ in every_mix()] + [GOOD] * 5, spec)
    refine_latest(spark, roots[0], str(tmp_path / "plain"), "p", spec, run_ts=OUT)
    plain, got = read_run(spark, str(tmp_path / "plain"), "p", OUT), read_run(spark, roots[1], "p", OUT)
    assert rows_of(got) == rows_of(plain) and got.schema == plain.schema


@pytest.mark.parametrize("rows", [[], [GOOD] * 2, [(None,) * 4] * 2], ids=["none", "all kept", "all rejected"])
def test_one_side_empty(spark, roots, rows):
    res = split(spark, roots, rows)
    good = rows.count(GOOD)
    assert (res.kept, res.rejected) == (good, len(rows) - good)
    assert read_run(spark, roots[1], "p", OUT).count() == min(good, 1)
    rejects = read_run(spark, roots[2], "p", OUT)
    assert rejects.count() == len(rows) - good and rejects.columns[-1] == "broken"


def test_kept_rows_are_not_left_behind_and_bronze_is_not_needed_again(spark, roots):
    split(spark, roots, [GOOD, (None,) * 4])
    left = [p for p in pathlib.Path(domain_dir(roots[2], "p")).rglob("part-*.parquet")]
    assert left and all("rejected=true" in str(p) for p in left)
    for f in pathlib.Path(domain_dir(roots[0], "p")).rglob("part-*"):
        f.unlink()  # neither run depends on bronze any more
    assert read_run(spark, roots[1], "p", OUT).count() == read_run(spark, roots[2], "p", OUT).count() == 1


def test_a_repeated_call_replaces_both_runs(spark, roots):
    split(spark, roots, [GOOD, (None,) * 4])
    res = split(spark, roots, [(None,) * 4] * 3)
    assert (res.kept, res.rejected) == (0, 3)
    assert read_run(spark, roots[1], "p", OUT).count() == 0 and read_run(spark, roots[2], "p", OUT).count() == 3
    drop_run(spark, roots[2], "p", OUT)
    assert list_runs(spark, roots[2], "p") == []


def test_specs_without_rules_and_clashing_columns(spark, roots):
    res = split(spark, roots, [GOOD, (None,) * 4], RefineSpec(dedup=False))
    assert (res.kept, res.rejected, res.by_rule) == (2, 0, {})
    with pytest.raises(ValueError, match="broken"):
        split(spark, roots, [("a", "b")], RefineSpec(not_blank=("x",)), "x string, Broken string")
    with pytest.raises(ValueError, match="bit set"):
        rules_of(RefineSpec(not_blank=tuple(f"c{i}" for i in range(64))))
    df = spark.createDataFrame([(None,) * 63], ", ".join(f"c{i} string" for i in range(63)))
    wide = RefineSpec(not_blank=tuple(df.columns))
    assert df.select(F.array_size(rule_names(broken_rules(wide), wide)).alias("n")).first().n == 63
