"""Zone maps of text columns: per file, the range of the numbers and dates that the texts stand for.

Files keep statistics of the text itself at best (CSV none), and a range of parsed values cannot be told from
those: ``'9' > '100'``. So a run's parsed ranges are computed once and kept as state beside the run log; a read with
range conditions then takes only the files that can hold a row it wants. The conditions are applied to the rows
as well, so the rows are those of a full scan, and a run without a zone map is simply read in full.
"""

from __future__ import annotations

import datetime as dt
import logging
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.fixed import DATE_FORMAT, DATE_SEPARATOR
from strata.functions.rules import date_prefix, int_between_exclusive, lenient_int
from strata.operators.runs import RUN_COLUMN, check_run
from strata.sources.layers import literal_path, load_files, read_run, run_files_of, state_dir, state_is_written

FORMATS = ("parquet", "csv")  # ``csv_quoted`` records may cross files' blocks: no row has one file position
log = logging.getLogger("strata")


def _zone_dir(root: str, domain: str, run_ts: str) -> str:
    return f"{state_dir(root, domain)}/{RUN_COLUMN}={check_run(run_ts)}/kind=zones"


def _name(kind: str, column: str, sep: str, fmt: str) -> str:
    return f"{kind}:{column}" if kind == "number" else f"{kind}:{column}:{sep}:{fmt}"


def build_zones(spark: SparkSession, root: str, domain: str, run_ts: str, fmt: str = "parquet", numbers: tuple[str, ...] = (),
                dates: tuple[str, ...] = (), date_sep: str = DATE_SEPARATOR, date_format: str = DATE_FORMAT) -> None:
    """Compute and keep the zone map of a committed run: the ranges of ``numbers`` (``lenient_int``) and ``dates`` (``date_prefix``).

    One scan of these columns with a partial aggregate per file, so that a few rows per file and task are shuffled. An
    earlier map of the run is replaced. Replacing the run drops its map; a map of other files than the run's
    present ones (it was compacted since) is not used. Raises ``ValueError`` for a packed run, which shares its files
    with others, ``FileNotFoundError`` without such a run.
    """
    if fmt not in FORMATS:
        raise ValueError(f"zone maps are for {FORMATS}, got {fmt!r}")
    place = run_files_of(spark, root, domain, run_ts)
    values = {_name("number", c, "", ""): lenient_int(c).cast("long") for c in numbers}
    values |= {_name("date", c, date_sep, date_format): F.unix_date(date_prefix(c, date_sep, date_format)).cast("long") for c in dates}
    if not values:
        raise ValueError("a zone map needs a column")
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))  # Spark gives it as a URI
    rows = read_run(spark, root, domain, run_ts, fmt).select(
        path.alias("file"), *[v.alias(f"v{i}") for i, v in enumerate(values.values())])
    ranges = rows.groupBy("file").agg(F.array(*[
        F.struct(F.lit(name).alias("name"), F.min(f"v{i}").alias("low"), F.max(f"v{i}").alias("high"))
        for i, name in enumerate(values)]).alias("zones"))
    (ranges.select(F.lit(place).alias("place"), "file", F.inline("zones"))
     .write.mode("overwrite").parquet(_zone_dir(root, domain, run_ts)))


def read_between(spark: SparkSession, root: str, domain: str, run_ts: str, fmt: str = "parquet",
                 numbers: dict[str, tuple[int, int]] | None = None, dates: dict[str, tuple[dt.date, dt.date]] | None = None,
                 date_sep: str = DATE_SEPARATOR, date_format: str = DATE_FORMAT) -> DataFrame:
    """The rows of a run with ``low < int(column) < high`` for all ``numbers`` and ``first <= date <= last`` for all ``dates``; texts stay texts.

    Rows whose text is no number or date are left out, as by ``refine``. Files that the run's zone map rules
    out are not opened: those where some condition's column has no value or only values out of range. Conditions on columns that the map
    lacks (or has with another date format) rule out nothing. The names of the other files come to the driver, which hands them to the reader.
    """
    numbers, dates = numbers or {}, dates or {}
    keep: list[Column] = [int_between_exclusive(c, low, high) for c, (low, high) in numbers.items()]
    keep += [date_prefix(c, date_sep, date_format).between(F.lit(a), F.lit(b)) for c, (a, b) in dates.items()]
    rows = read_run(spark, root, domain, run_ts, fmt)
    # inclusive bounds, in the numbers that the map holds
    wanted = {_name("number", c, "", ""): (low + 1, high - 1) for c, (low, high) in numbers.items()}
    epoch = dt.date(1970, 1, 1)
    wanted |= {_name("date", c, date_sep, date_format): ((a - epoch).days, (b - epoch).days) for c, (a, b) in dates.items()}
    if wanted and fmt in FORMATS and state_is_written(spark, _zone_dir(root, domain, run_ts)):
        place = run_files_of(spark, root, domain, run_ts)
        zones = spark.read.schema("place string, file string, name string, low long, high long").parquet(_zone_dir(root, domain, run_ts))
        out = F  # one case per condition; a range without a value rules out every file
        for name, (low, high) in wanted.items():
            miss = F.lit(low > high) | (F.col("high") < low) | (F.col("low") > high)
            out = out.when(F.col("name") == name, F.coalesce(miss, F.lit(True)))
        out = out.otherwise(F.lit(False))
        files = zones.groupBy("file").agg(F.bool_or(out).alias("out"), F.bool_and(F.col("place") == place).alias("current"))
        found = files.agg(F.collect_list(F.when(~F.col("out"), F.col("file"))).alias("files"), F.count(F.lit(1)).alias("all"),
                          F.bool_and("current").alias("current")).first()
        if found.current:
            log.info("read: %d of %d files of run %s by its zone map", len(found.files), found["all"], run_ts)
            fields = T.StructType(rows.schema.fields)
            rows = load_files(spark, fmt, [literal_path(f) for f in sorted(found.files)], fields) if found.files \
                else spark.createDataFrame([], fields)
    return rows.filter(reduce(and_, keep)) if keep else rows
