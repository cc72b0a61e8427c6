"""Runs: minute-stamped versions of a layer, and picking the latest one.

A run key is the text ``YYYYMMDDHHMM``; keys sort lexicographically in time
order, so "latest" is ``max(run_ts)`` and "of a day" is a ``YYYYMMDD`` prefix.
"""

from __future__ import annotations

import re
from datetime import datetime
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.fixed import DOMAIN_NAME_SEPARATOR, RUN_STAMP_FORMAT

RUN_COLUMN = "run_ts"
RUN_KEY = re.compile(r"[0-9]{12}")
RAW_SUFFIX = re.compile(r"\.csv(\.(gz|bz2|zst|deflate|lz4|snappy))?$", re.IGNORECASE)  # plain or compressed
DAY_KEY = re.compile(r"[0-9]{8}")


def run_stamp(now: datetime | None = None) -> str:
    """Minute stamp ``YYYYMMDDHHMM`` of ``now`` (default: the current local time)."""
    return (now or datetime.now()).strftime(RUN_STAMP_FORMAT)


def check_run(run_ts: str) -> str:
    if not isinstance(run_ts, str) or not RUN_KEY.fullmatch(run_ts):
        raise ValueError(f"run key must be 12 digits YYYYMMDDHHMM, got {run_ts!r}")
    return run_ts


def check_day(day: str | None) -> str | None:
    if day is not None and (not isinstance(day, str) or not DAY_KEY.fullmatch(day)):
        raise ValueError(f"day must be 8 digits YYYYMMDD, got {day!r}")
    return day


def check_domain(domain: str) -> str:
    """A domain names a folder: non-empty, no path separator, no ``=`` (which
    partition discovery would read as ``column=value``)."""
    if not isinstance(domain, str) or not domain or any(ch in domain for ch in "/\\=") \
            or domain.strip() != domain:
        raise ValueError(f"invalid domain {domain!r}")
    return domain


def domain_of(path: str) -> str:
    """Domain of a raw file: its name without extension, up to the first ``_``, lower case.

    ``.../pacientes_export.csv`` -> ``pacientes``.
    """
    name = PurePosixPath(path.rstrip("/")).name
    stem = re.sub(RAW_SUFFIX, "", name) if re.search(RAW_SUFFIX, name) else PurePosixPath(name).stem
    return stem.split(DOMAIN_NAME_SEPARATOR)[0].lower()


def run_of_path(path: str | Column) -> Column:
    """Run key carried in a file path (``.../run_ts=YYYYMMDDHHMM/part-...``), else NULL.

    Typical use: ``run_of_path(F.col("_metadata.file_path"))`` on a scan of
    run directories read without partition discovery.
    """
    c = F.col(path) if isinstance(path, str) else path
    return F.nullif(F.regexp_extract(c, r"run_ts=([0-9]{12})(?:/|$)", 1), F.lit(""))


def in_day(run_col: Column, day: str | None) -> Column:
    return F.lit(True) if day is None else run_col.startswith(day)


def latest_run(df: DataFrame, day: str | None = None, run_col: str = RUN_COLUMN) -> DataFrame:
    """Rows of ``df`` that belong to its latest run (of ``day`` when given). Lazy.

    The latest key is a global one-row aggregate (partial max per task, one
    tiny final step); it is broadcast -- its size is one row by construction --
    into a left-semi join, so the data side is never shuffled. On a
    ``run_ts``-partitioned scan the day prefix prunes partitions statically
    and the semi-join prunes the data scan dynamically to the one run.
    A day without runs yields an empty frame (see ``sources.layers.resolve_run``
    for the raising form).
    """
    check_day(day)
    c = F.col(run_col)
    newest = (
        df.filter(in_day(c, day))
        .agg(F.max(c).alias(run_col))
        .filter(F.col(run_col).isNotNull())
    )
    return df.join(F.broadcast(newest), on=run_col, how="left_semi")
