"""Runs stored the old way: one entry per run named ``<stem>_<YYYYMMDDHHMM>[.ext]``.

Layers written by the source pipeline keep each run as a folder (or a
single file) directly under ``LOCAL_<DOMAIN>/``, the run key at the end of
its name, e.g. ``pacientes_export_202505151030/`` (bronze CSV) or
``pacientes_refinados_202505151030.parquet`` (silver Parquet); promoted
diamond files carry a part number after the key
(``pacientes_refinados_20250515103000000.parquet``). The older publisher's
backups are CSV files ``diamond/<table>_<YYYYMMDDHHMM>.csv``. These helpers
find such runs and adopt them into the ``run_ts=`` layout, so an existing
lake can be taken over without losing its history.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from strata.fixed import LEGACY_BACKUP_DIR, LEGACY_RUN_NAME
from strata.operators.runs import check_day
from strata.sources.layers import (
    _hadoop_fs, _run_complete, _writes_success_marker, domain_dir, is_committed, load_files, write_run,
)

_LEGACY_NAME = re.compile(LEGACY_RUN_NAME)


def _named_runs(spark: SparkSession, folder: str, day: str | None, stem: str | None = None) -> dict[str, str]:
    check_day(day)
    fs, base = _hadoop_fs(spark, folder)
    if not fs.exists(base):
        return {}
    found: dict[str, list[str]] = {}
    it = fs.listStatusIterator(base)
    while it.hasNext():
        path = it.next().getPath()
        m = _LEGACY_NAME.match(path.getName())
        if m and (day is None or m["run"].startswith(day)) and stem in (None, m["stem"]):
            found.setdefault(m["run"], []).append(path.toString())
    clashes = {run: sorted(paths) for run, paths in found.items() if len(paths) > 1}
    if clashes:
        raise ValueError(f"several entries of one run key under {folder}; move all but one: {clashes}")
    return {run: paths[0] for run, paths in found.items()}


def legacy_runs(spark: SparkSession, root: str, domain: str, day: str | None = None) -> dict[str, str]:
    """``{run_ts: path}`` of the old-style runs of ``domain`` (of ``day`` when given).

    One directory listing. Raises ``ValueError`` when two entries carry the same key.
    """
    return _named_runs(spark, domain_dir(root, domain), day)


def legacy_backups(spark: SparkSession, root: str, table: str, day: str | None = None) -> dict[str, str]:
    """``{run_ts: path}`` of the older publisher's CSV backups of ``table`` under ``<root>/diamond/``."""
    return _named_runs(spark, f"{root.rstrip('/')}/{LEGACY_BACKUP_DIR}", day, table)


def _adopt(spark: SparkSession, runs: dict[str, str], dst_root: str, domain: str, fmt: str, existing: str,
           parallel_runs: int) -> list[str]:
    if existing not in ("raise", "skip"):
        raise ValueError(f"existing={existing!r}: 'raise' or 'skip'")
    there = [run for run in runs if is_committed(spark, dst_root, domain, run)]
    if there and existing == "raise":
        raise FileExistsError(f"runs already in {domain_dir(dst_root, domain)}: {sorted(there)}")
    todo = {run: path for run, path in runs.items() if run not in there}
    need_marker = _writes_success_marker(spark)
    for run, path in todo.items():
        fs, p = _hadoop_fs(spark, path)
        if fs.getFileStatus(p).isDirectory() and not _run_complete(fs, p, need_marker):
            raise ValueError(f"run {run} was not committed: {path}")

    def one(run: str) -> None:
        write_run(load_files(spark, fmt, todo[run]), dst_root, domain, run, fmt)

    with ThreadPoolExecutor(max_workers=max(1, parallel_runs)) as pool:
        futures = [pool.submit(one, run) for run in sorted(todo)]
    errors = [f.exception() for f in futures if f.exception() is not None]
    if errors:
        raise errors[0]
    return sorted(todo, reverse=True)


def adopt_legacy_runs(
    spark: SparkSession,
    src_root: str,
    dst_root: str,
    domain: str,
    fmt: str = "parquet",
    day: str | None = None,
    existing: str = "raise",
    parallel_runs: int = 4,
) -> list[str]:
    """Copy every old-style run of ``domain`` into ``dst_root`` as ``run_ts=`` runs.

    Each run is one distributed read + write; keys are kept, and up to
    ``parallel_runs`` runs are copied at once. Nothing is ever replaced: a
    committed run of the same key in ``dst_root`` raises ``FileExistsError``,
    or is left as it is with ``existing="skip"`` (to go on after a failure).
    A source folder without commit marker, or two entries of one key, raise
    ``ValueError`` before anything is copied. Returns the adopted keys,
    newest first. Raises ``FileNotFoundError`` when none is found.
    """
    runs = legacy_runs(spark, src_root, domain, day)
    if not runs:
        raise FileNotFoundError(f"no old-style run of domain {domain!r} under {domain_dir(src_root, domain)}")
    return _adopt(spark, runs, dst_root, domain, fmt, existing, parallel_runs)


def adopt_legacy_backups(
    spark: SparkSession,
    src_root: str,
    dst_root: str,
    domain: str,
    table: str,
    day: str | None = None,
    existing: str = "raise",
    parallel_runs: int = 4,
) -> list[str]:
    """Copy the older publisher's CSV backups of ``table`` into ``dst_root`` as ``csv_quoted`` runs of ``domain``.

    Same rules as ``adopt_legacy_runs``.
    """
    runs = legacy_backups(spark, src_root, table, day)
    if not runs:
        raise FileNotFoundError(f"no CSV backup of {table!r} under {src_root}/{LEGACY_BACKUP_DIR}")
    return _adopt(spark, runs, dst_root, domain, "csv_quoted", existing, parallel_runs)
