"""Zone maps of parsed text: the rows of a full scan from fewer files."""

import datetime as dt
import pathlib
import random

import pytest
from pyspark.sql import functions as F

from strata.functions.rules import date_prefix, int_between_exclusive
from strata.sources.layers import compact_run, domain_dir, read_run, write_run, write_runs
from strata.sources.zones import build_zones, read_between

RUN = "202505151030"
ODD = [(None, None), ("", ""), ("x9", "2025-02-30"), (" 7 ", "2025-05-01 10:00"), ("3.9", "1969-12-31"), ("-5", "2025-5-1")]


@pytest.fixture
def run(spark, tmp_path):
    root = str(tmp_path / "a +b%20")  # signs that URIs spell otherwise

    def write(rows, files, fmt="csv", zones=True):
        df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, edad string, fecha string")
        write_run(df.withColumn("at", (F.col("i") * files / len(rows)).cast("int")).repartitionByRange(files, "at").drop("at"),
                  root, "p", RUN, fmt, preserve_whitespace=True)
        if zones:
            build_zones(spark, root, "p", RUN, fmt, ("edad",), ("fecha",))

    return root, write


def in_order(n):
    day = dt.date(2025, 1, 1)
    return [(str(i), f"{day + dt.timedelta(days=i)} 09:00") for i in range(n)]


def full(spark, root, fmt, numbers, dates):
    df = read_run(spark, root, "p", RUN, fmt)
    for c, (low, high) in numbers.items():
        df = df.filter(int_between_exclusive(c, low, high))
    for c, (a, b) in dates.items():
        df = df.filter(date_prefix(c).between(F.lit(a), F.lit(b)))
    return sorted(map(tuple, df.collect()), key=str)


def check(spark, root, fmt="csv", numbers=None, dates=None):
    got = read_between(spark, root, "p", RUN, fmt, numbers, dates)
    assert sorted(map(tuple, got.collect()), key=str) == full(spark, root, fmt, numbers or {}, dates or {})
    assert got.schema == read_run(spark, root, "p", RUN, fmt).schema
    return len(got.inputFiles())


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_fewer_files_and_the_rows_of_a_full_scan(spark, run, fmt):
    root, write = run
    write(in_order(80), 8, fmt)
    whole = len(read_run(spark, root, "p", RUN, fmt).inputFiles())
    assert whole == 8
    assert check(spark, root, fmt, {"edad": (20, 29)}) == 1  # as text, '3' and '100' would lie among these
    assert check(spark, root, fmt, {"edad": (19, 30)}) == 1 and check(spark, root, fmt, {"edad": (18, 30)}) == 2
    assert check(spark, root, fmt, dates={"fecha": (dt.date(2025, 1, 11), dt.date(2025, 1, 20))}) == 1
    assert check(spark, root, fmt, {"edad": (0, 35)}, {"fecha": (dt.date(2025, 1, 25), dt.date(2025, 12, 31))}) == 2
    assert check(spark, root, fmt, {"edad": (-1, 80)}) == whole and check(spark, root, fmt) == whole
    assert check(spark, root, fmt, {"edad": (500, 600)}) == 0 and check(spark, root, fmt, {"edad": (30, 31)}) == 0


def test_random_texts_and_ranges(spark, run):
    root, write = run
    rng = random.Random(5)
    rows = [rng.choice(ODD) if rng.random() < 0.3 else (str(rng.randint(-50, 50) + i // 4), f"2025-{1 + i // 20:02d}-{rng.randint(1, 28):02d}")
            for i in range(200)]
    write(rows, 7)
    for _ in range(8):
        low = rng.randint(-60, 100)
        first = dt.date(2025, rng.randint(1, 12), 1)
        check(spark, root, numbers={"edad": (low, low + rng.randint(0, 40))})
        check(spark, root, "csv", {"edad": (low, low + 60)}, {"fecha": (first, first + dt.timedelta(days=rng.randint(0, 60)))})
    check(spark, root, dates={"fecha": (dt.date(1960, 1, 1), dt.date(1969, 12, 31))})


def test_files_ruled_out_are_not_opened(spark, run):
    root, write = run
    write(in_order(40), 4)
    for f in pathlib.Path(domain_dir(root, "p")).rglob("part-*.csv"):
        if "\n25," not in f.read_text():
            f.write_text("not,the\nsame,header\n")
    assert [r.i for r in read_between(spark, root, "p", RUN, "csv", {"edad": (24, 27)}).orderBy("i").collect()] == ["25", "26"]


def test_files_without_any_value_are_left_out(spark, run):
    root, write = run
    write([("x", "y")] * 10 + in_order(10), 2)
    assert check(spark, root, numbers={"edad": (-1000, 1000)}) == 1


def test_maps_of_other_files_are_not_used(spark, run):
    root, write = run
    write(in_order(40), 4)
    compact_run(spark, root, "p", RUN, fmt="csv")  # other files
    assert check(spark, root, numbers={"edad": (5, 8)}) == 1
    write(list(reversed(in_order(40))), 4, zones=False)  # the run is replaced: its map is gone
    assert check(spark, root, numbers={"edad": (5, 8)}) == 4
    build_zones(spark, root, "p", RUN, "csv", ("edad",))
    assert check(spark, root, numbers={"edad": (5, 8)}) == 1
    assert check(spark, root, dates={"fecha": (dt.date(2025, 1, 1), dt.date(2025, 1, 2))}) == 4  # not in the map


def test_another_date_format_rules_out_nothing(spark, run):
    root, write = run
    write(in_order(20), 2)
    got = read_between(spark, root, "p", RUN, "csv", dates={"fecha": (dt.date(2025, 1, 1), dt.date(2025, 1, 2))}, date_sep="T")
    assert len(got.inputFiles()) == 2 and got.count() == 0


def test_what_has_no_zone_map(spark, run, tmp_path):
    root, write = run
    with pytest.raises(FileNotFoundError):
        build_zones(spark, root, "p", RUN, numbers=("edad",))
    write(in_order(4), 2, zones=False)
    with pytest.raises(ValueError, match="column"):
        build_zones(spark, root, "p", RUN, "csv")
    with pytest.raises(ValueError, match="csv_quoted"):
        build_zones(spark, root, "p", RUN, "csv_quoted", ("edad",))
    write_runs(spark.createDataFrame([("1", RUN), ("2", "202505151031")], "edad string, run_ts string"), root, "q", packed=True)
    with pytest.raises(ValueError, match="shares"):
        build_zones(spark, root, "q", RUN, numbers=("edad",))
    assert read_between(spark, root, "q", RUN, numbers={"edad": (0, 2)}).count() == 1
