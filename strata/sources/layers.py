"""Layer storage: ``<layer_root>/LOCAL_<DOMAIN>/run_ts=<YYYYMMDDHHMM>/part-*``.

Each run is its own directory, written in one Spark job and overwritten only
as a whole, so re-running a minute replaces that run and leaves the others.
The directory name doubles as a partition value, so a whole layer reads as
one table with a ``run_ts`` string column that Spark can prune on.

Which runs exist, and where their data lies, is said by the domain's run log
(``sources.manifest``). A run of the log may lie in its own directory, in that of another
layer that it refers to (``refer_run``), or, with many other small runs, in
the files of one write (``write_runs(packed=True)``). Layers without a log (written
by earlier versions) are read by their commit markers until the first write starts one.
"""

from __future__ import annotations

import json
import logging
import re
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.fixed import DOMAIN_DIR_PREFIX
from strata.operators.runs import RAW_SUFFIX, RUN_COLUMN, RUN_KEY, check_day, check_domain, check_run
from strata.session import jvm_context, session_with
from strata.sources import manifest
from strata.sources.quoted import read_quoted_csv

FORMATS = ("parquet", "csv", "csv_quoted")
log = logging.getLogger("strata")


def domain_dir(root: str, domain: str) -> str:
    return f"{root.rstrip('/')}/{DOMAIN_DIR_PREFIX}{check_domain(domain).upper()}"


def run_dir(root: str, domain: str, run_ts: str) -> str:
    return f"{domain_dir(root, domain)}/{RUN_COLUMN}={check_run(run_ts)}"


def _check_format(fmt: str) -> str:
    if fmt not in FORMATS:
        raise ValueError(f"layer format must be one of {FORMATS}, got {fmt!r}")
    return fmt


def _reader(spark: SparkSession, fmt: str):
    _check_format(fmt)
    if fmt == "csv":
        return csv_reader(spark).format("csv")
    if fmt == "csv_quoted":  # one file by one task; ``load_files`` reads it by many
        return csv_reader(spark).option("multiLine", True).option("escape", '"').format("csv")
    return spark.read.format(fmt)


def load_files(spark: SparkSession, fmt: str, path: str | list[str], schema: T.StructType | None = None) -> DataFrame:
    """The rows of one run's files, with ``schema`` where it is known; large files are read by many tasks."""
    if _check_format(fmt) == "csv_quoted":
        return read_quoted_csv(spark, path, schema.names if schema else None)
    reader = _reader(spark, fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def csv_reader(spark: SparkSession):
    """Header CSV reader: every field is text (no inference), and every file's
    header must name the same columns in the same order -- a file whose header
    differs fails the read instead of being mapped by position."""
    return spark.read.option("header", True).option("enforceSchema", False)


def _odd_header(cells: list[str]) -> bool:
    """Empty or repeated header cells, for which Spark makes up names."""
    names = [(c or "").strip().lower() for c in cells]
    return "" in names or len(set(names)) < len(names)


def read_raw_csv(spark: SparkSession, uri: str | list[str]) -> DataFrame:
    """Raw CSV files or folders with header lines; all columns are strings.

    All files must have the same header. Empty and repeated header cells load under the names
    that Spark gives them (``_c1``; the name and its position).
    """
    plain = spark.read.option("header", True).csv(uri)
    first = spark.read.option("header", False).csv(uri[0] if isinstance(uri, list) else uri).first()
    if first is None or not _odd_header([c.strip() if c else "" for c in first]):
        return csv_reader(spark).csv(uri)
    # Spark's own comparison knows only clean headers: compare the files' first lines instead
    lines = spark.read.text(uri).select(
        F.col("_metadata.file_path").alias("file"), F.col("value"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("at"))
    heads = lines.groupBy("file").agg(F.min_by("value", "at").alias("head"))
    found = heads.agg(F.min("head").alias("low"), F.max("head").alias("high")).first()
    if found.low != found.high:
        raise ValueError(f"headers differ under {uri}: {found.low!r} and {found.high!r}")
    return plain


def write_run(
    df: DataFrame,
    root: str,
    domain: str,
    run_ts: str,
    fmt: str = "parquet",
    num_files: int | None = None,
    preserve_whitespace: bool = False,
    guard: Callable[[manifest.Manifest], dict] | None = None,
) -> str:
    """Write ``df`` as run ``run_ts`` of ``domain`` in the layer at ``root``.

    The write keeps the frame's parallelism (one file per task) unless
    ``num_files`` asks for a fixed count; ``num_files=1`` reproduces a
    single-file layout at the price of one writing task. CSV output has a
    header; its writer trims leading/trailing blanks of text fields unless
    ``preserve_whitespace`` is set. ``csv_quoted`` is CSV with doubled quotes
    (RFC 4180): blanks, quotes, backslashes and line breaks inside fields
    survive; an empty text reads back as NULL. The number of rows written is counted
    inside the write job itself (``observe``, no extra scan). The run exists for readers
    from the moment its entry is in the run log. A run that other layers refer to is
    not overwritten: the new data gets a directory beside it. With a ``guard`` the data gets a directory of this call's
    own, and the guard is asked at the very change of the log that commits the run: it raises to refuse the commit, and returns
    what the run's entry is to hold besides.
    Returns the run's directory.
    """
    spark, path = df.sparkSession, run_dir(root, domain, check_run(run_ts))
    _check_format(fmt)
    if num_files is not None and num_files < 1:
        raise ValueError("num_files must be >= 1")
    log_now = manifest.load(spark, domain_dir(root, domain))
    old = log_now.runs.get(run_ts) if log_now else None
    if guard or (log_now and path in log_now.references):
        path = f"{domain_dir(root, domain)}/_again-{uuid.uuid4().hex[:8]}/{RUN_COLUMN}={run_ts}"
    elif old and _place(root, domain, old) == path:  # from here to the new entry the run does not exist
        _change(spark, root, domain, lambda m: [{"op": "drop", "run": run_ts}] if m.runs.get(run_ts) == old else [])
    _forget(spark, root, domain, run_ts)
    rows = _save(df if num_files is None else df.repartition(num_files), path, fmt, preserve_whitespace)
    files, size = _files_in(spark, path)
    entry = _entry(root, domain, run_ts, path, fmt, files=files, rows=rows, bytes=size, schema=_schema_of(df, fmt))

    after = _change(spark, root, domain, lambda m: [{**entry, **(guard(m) if guard else {})}])
    _release(spark, root, domain, run_ts, old)
    if guard and old and not old.get("log") and not old["packed"] and _place(root, domain, old) not in {*after.references, path}:
        fs, p = _hadoop_fs(spark, _place(root, domain, old))
        fs.delete(p, True)
    log.info("wrote %s rows to %s", rows, path)
    return path


@dataclass(frozen=True)
class Ledger:
    """The files that a run is loaded from, and the ledgers that were there when they were chosen."""

    path: str
    before: tuple[str, ...]

    def guard(self, run_ts: str) -> Callable[[manifest.Manifest], dict]:
        """Commits the files with run ``run_ts``: ``RuntimeError``, and nothing is committed, where the run exists
        already or another call has committed files in the meantime."""
        def check(m: manifest.Manifest) -> dict:
            if run_ts in m.runs:
                raise RuntimeError(f"run {run_ts} exists already")
            if _ledgers(m) != self.before:
                raise RuntimeError(f"another call has loaded files since run {run_ts} chose its own")
            return {"ledger": self.path}

        return check


_LEDGER_SCHEMA = "path string, length long, modificationTime timestamp"


def _ledgers(state: manifest.Manifest | None) -> tuple[str, ...]:
    return tuple(sorted({e["ledger"] for e in state.runs.values() if e.get("ledger")})) if state else ()


def new_files(spark: SparkSession, root: str, domain: str, patterns: list[str]) -> tuple[Ledger, list[str]]:
    """The files under ``patterns`` that no committed run of ``domain`` was loaded from, as a ledger to commit with their run.

    A file is known by path, length and time of change: one that was replaced is new. Spark lists the files and
    anti-joins them with the ledgers of all committed runs; contents are not read. The ledger (Parquet beside the run
    log) means nothing until a run is committed with it. Only the new files' paths come to the driver, which
    has to hand them to the reader.
    """
    base = domain_dir(root, domain)
    before = _ledgers(manifest.load(spark, base))
    files = spark.read.format("binaryFile").load(patterns).select("path", "length", "modificationTime")
    if before:
        known = spark.read.schema(_LEDGER_SCHEMA).parquet(*[f"{base}/{name}" for name in before])
        files = files.join(known, ["path", "length", "modificationTime"], "left_anti")
    name = f"_ledger-{uuid.uuid4().hex[:12]}"
    files.write.parquet(f"{base}/{name}")
    found = spark.read.schema(_LEDGER_SCHEMA).parquet(f"{base}/{name}")
    paths = found.agg(F.sort_array(F.collect_list("path")).alias("paths")).first().paths
    if not paths:
        fs, p = _hadoop_fs(spark, f"{base}/{name}")
        fs.delete(p, True)
    return Ledger(name, before), paths


@dataclass(frozen=True)
class Lease:
    """The right to publish ``table`` with the run log of one domain; ``number`` rises from holder to holder."""

    spark: SparkSession
    root: str
    domain: str
    table: str
    number: int

    def guard(self, m: manifest.Manifest) -> dict:
        """Raises ``RuntimeError`` where the lease has passed to another holder."""
        if m.leases.get(self.table, {}).get("number") != self.number:
            raise RuntimeError(f"the lease on {self.table} has passed on from number {self.number}")
        return {}

    def check(self) -> None:
        self.guard(manifest.load(self.spark, domain_dir(self.root, self.domain)))

    def record(self, run_ts: str) -> None:
        """Note that the table was created from run ``run_ts``."""
        _change(self.spark, self.root, self.domain, lambda m: [
            {"op": "published", "table": self.table, "run": run_ts, "number": self.number}])


@contextmanager
def lease(spark: SparkSession, root: str, domain: str, table: str, seconds: float) -> Iterator[Lease]:
    """Hold the lease on publishing ``table`` for as long as the block runs, ``seconds`` at most.

    The lease is a change of the domain's run log, so of two callers at once one gets it; the other is refused with
    ``RuntimeError``. A holder that died gives way after ``seconds``. One that
    lives on beyond that is not stopped, but what it commits with ``Lease.guard`` is refused once another has the lease.
    """
    got: dict = {}

    def take(m: manifest.Manifest) -> list[dict]:
        held = m.leases.get(table)
        if held and held["until"] > time.time():
            raise RuntimeError(f"{table} is being published by the holder of lease {held['number']}")
        got["number"] = m.version + 1
        return [{"op": "lease", "table": table, "number": got["number"], "until": time.time() + seconds}]

    _change(spark, root, domain, take)
    mine = Lease(spark, root, domain, table, got["number"])
    try:
        yield mine
    finally:
        _change(spark, root, domain, lambda m: [{"op": "end", "table": table, "number": mine.number}]
                if m.leases.get(table, {}).get("number") == mine.number else [])


def published_run(spark: SparkSession, root: str, domain: str, table: str) -> str | None:
    """The backup run that ``publish`` created ``table`` from; None where the run log does not know."""
    state = manifest.load(spark, domain_dir(root, domain))
    return state.published.get(table, {}).get("run") if state else None


def _forget(spark: SparkSession, root: str, domain: str, run_ts: str) -> None:
    """Delete the state of a run that is about to change."""
    fs, p = _hadoop_fs(spark, f"{state_dir(root, domain)}/{RUN_COLUMN}={run_ts}")
    fs.delete(p, True)


def _save(df: DataFrame, path: str, fmt: str, preserve_whitespace: bool = False) -> int | None:
    """Write ``df`` to ``path``; returns the rows, counted in the same job."""
    written = Observation(f"rows written to {path}")
    df = df.observe(written, F.count(F.lit(1)).alias("rows"))
    w = df.write.mode("overwrite").format("parquet" if fmt == "parquet" else "csv")
    if fmt != "parquet":
        w = w.option("header", True)
        if fmt == "csv_quoted":
            w = w.option("escape", '"')
        if preserve_whitespace or fmt == "csv_quoted":
            w = w.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    w.save(path)
    return written.get.get("rows")


def _place(root: str, domain: str, entry: dict) -> str:
    """Where the data of a log entry lies: paths inside the domain's folder are kept relative to it."""
    return entry["path"] if "://" in entry["path"] or entry["path"].startswith(("/", "file:")) \
        else f"{domain_dir(root, domain)}/{entry['path']}"


def _entry(root: str, domain: str, run_ts: str, path: str, fmt: str | None, files: int | None = None, rows: int | None = None,
           bytes: int | None = None, schema: str | None = None, packed: int = 0) -> dict:
    base = f"{domain_dir(root, domain)}/"
    return {"op": "commit", "run": run_ts, "path": path.removeprefix(base), "format": fmt, "files": files, "rows": rows,
            "bytes": bytes, "schema": schema, "packed": packed}


def _schema_of(df: DataFrame, fmt: str) -> str | None:
    """A run's columns as they read back; None where only the files can tell (CSV headers with odd names)."""
    if fmt == "parquet":
        return df.schema.json()
    if not df.columns or not all(re.fullmatch(r"\w+", c) for c in df.columns):
        return None
    return T.StructType([T.StructField(c, T.StringType()) for c in df.columns]).json()


def _files_in(spark: SparkSession, path: str) -> tuple[int, int]:
    """(data files, their bytes) of one directory."""
    fs, p = _hadoop_fs(spark, path)
    files = size = 0
    it = fs.listStatusIterator(p)
    while it.hasNext():
        st = it.next()
        if st.isFile() and not st.getPath().getName().startswith(("_", ".")):
            files, size = files + 1, size + int(st.getLen())
    return files, size


def _change(spark: SparkSession, root: str, domain: str, make) -> manifest.Manifest:
    def first() -> list[dict]:  # runs that are there before the domain has a log
        return [_entry(root, domain, key, run_dir(root, domain, key), None) for key in _marked_runs(spark, root, domain)]

    return manifest.change(spark, domain_dir(root, domain), make, first)


def _holder(root: str, domain: str, run_ts: str) -> str:
    return run_dir(root, domain, run_ts)


def _source_of(entry: dict) -> tuple[str, str]:
    """(domain folder, path) of the run that an entry of another layer refers to."""
    path = entry["path"]
    return entry.get("log") or path.rpartition("/")[0], path


def _release(spark: SparkSession, root: str, domain: str, run_ts: str, old: dict | None) -> None:
    """Tell the layer that ``old`` referred to that it does so no more."""
    if old and old.get("log"):
        folder, path = _source_of(old)
        manifest.change(spark, folder, lambda m: [{"op": "release", "path": path, "by": _holder(root, domain, run_ts)}])


def refer_run(spark: SparkSession, src_root: str, dst_root: str, domain: str, run_ts: str) -> str:
    """Make run ``run_ts`` of the source layer a run of the target layer too, without touching its data.

    The source's log first gets a reference, which keeps the data from being deleted or overwritten;
    then the target's log gets an entry that points at it. A failure in between leaves a reference
    that holds the data until the call is repeated, or ``drop_run`` of the target run. Raises
    ``FileNotFoundError`` where the source has no such run. Returns the data's directory.
    """
    folder, holder = domain_dir(src_root, domain), _holder(dst_root, domain, run_ts)
    missing = FileNotFoundError(f"no committed run {run_ts} of domain {domain!r} under {folder}")
    seen = _change(spark, src_root, domain, lambda m: []).runs.get(run_ts)
    if seen is None:
        raise missing
    path = _place(src_root, domain, seen)
    origin = seen.get("log") or folder  # where the data's own entry is, if the source itself only refers to it

    def hold(m: manifest.Manifest) -> list[dict]:
        if not any(path in (r["path"], f"{origin}/{r['path']}") for r in m.runs.values()):
            raise missing  # dropped in the meantime
        return [] if holder in m.references.get(path, []) else [{"op": "refer", "path": path, "by": holder}]

    manifest.change(spark, origin, hold)
    before = manifest.load(spark, domain_dir(dst_root, domain))
    old = before.runs.get(run_ts) if before else None
    _change(spark, dst_root, domain, lambda m: [
        {"op": "commit", "run": run_ts, **{k: v for k, v in seen.items() if k not in ("path", "log", "ledger")}, "path": path, "log": origin}])
    if old and old.get("log") and old["path"] != path:
        _release(spark, dst_root, domain, run_ts, old)
    return path


def register_run(spark: SparkSession, root: str, domain: str, run_ts: str, fmt: str = "parquet") -> None:
    """Commit a run that another program has written into its run directory."""
    path = run_dir(root, domain, check_run(run_ts))
    files, size = _files_in(spark, path)
    _change(spark, root, domain, lambda m: [_entry(root, domain, run_ts, path, _check_format(fmt), files=files, bytes=size)])


def write_split(df: DataFrame, root: str, domain: str, run_ts: str, by: str, counts: dict[str, Column]) -> tuple[str | None, dict[str, int]]:
    """Write ``df`` once, as Parquet parted by the boolean column ``by``; its true rows become run ``run_ts`` of ``domain``.

    The false rows are left beside it for the caller to read and then give up (``drop_split``): their folder is
    returned, None where there are none, with the results of ``counts``, aggregated in the same job. The run has the columns of ``df``
    but ``by``; its files are the ones written, nothing is copied. An existing run of this key is replaced.
    """
    spark, base = df.sparkSession, domain_dir(root, domain)
    name, seen = f"_split-{uuid.uuid4().hex[:12]}", Observation(f"split written to {base}")
    counted = {f"count {i}": c for i, c in enumerate(counts.values())}
    whole = df.observe(seen, *[c.alias(k) for k, c in counted.items()], F.count_if(F.col(by)).alias("true rows"))
    whole.write.partitionBy(by).parquet(f"{base}/{name}")
    numbers = seen.get
    there = {v: f"{base}/{name}/{by}={v}" for v in ("true", "false")}
    for path in list(there.values()):
        fs, p = _hadoop_fs(spark, path)
        if not fs.exists(p):
            there = {v: q for v, q in there.items() if q != path}
    if "true" in there:
        path = there["true"]
        files, size = _files_in(spark, path)
        old: dict = {}

        def make(m: manifest.Manifest) -> list[dict]:
            old.update(m.runs.get(run_ts, {}))
            return [_entry(root, domain, run_ts, path, "parquet", files=files, rows=numbers["true rows"], bytes=size,
                           schema=_schema_of(df.drop(by), "parquet"))]

        _change(spark, root, domain, make)
        _forget(spark, root, domain, run_ts)
        _release(spark, root, domain, run_ts, old)
    else:
        write_run(df.filter(F.lit(False)).drop(by), root, domain, run_ts)
    return there.get("false"), dict(zip(counts, (numbers[k] for k in counted)))


def drop_split(spark: SparkSession, path: str | None) -> None:
    """Delete the folder that ``write_split`` left to its caller."""
    if path:
        fs, p = _hadoop_fs(spark, path)
        fs.delete(p, True)


def compact_run(spark: SparkSession, root: str, domain: str, run_ts: str, file_bytes: int = 128 << 20, fmt: str = "parquet") -> int:
    """Rewrite a run as files of about ``file_bytes``, in one job without a shuffle; returns their number.

    Spark packs small files into one task's input up to that size and cuts larger ones (Parquet at row
    groups), and each task writes one file: no task takes more than ``file_bytes`` of input, and a run
    smaller than that becomes a single file. The new files are committed in place of the old ones at
    once; the old are deleted unless other layers refer to them. Raises ``RuntimeError``, with the run as it was, when
    the rows differ in number or another writer has changed the run in the meantime.
    """
    own = session_with(spark, {"spark.sql.files.maxPartitionBytes": str(file_bytes), "spark.sql.files.openCostInBytes": "0",
                               "spark.sql.files.minPartitionNum": "1"})
    old = _entries(spark, root, domain).get(check_run(run_ts))
    if old is None:
        raise FileNotFoundError(f"no committed run {run_ts} of domain {domain!r} under {domain_dir(root, domain)}")
    if old["packed"]:
        raise ValueError(f"run {run_ts} shares its files with other runs")
    df = read_run(own, root, domain, run_ts, fmt)
    path = f"{domain_dir(root, domain)}/_again-{uuid.uuid4().hex[:8]}/{RUN_COLUMN}={run_ts}"
    rows = _save(df, path, fmt, preserve_whitespace=True)
    if old["rows"] is not None and rows != old["rows"]:
        raise RuntimeError(f"{path} has {rows} rows, run {run_ts} has {old['rows']}")
    files, size = _files_in(spark, path)
    kept = _place(root, domain, old)

    def swap(m: manifest.Manifest) -> list[dict]:
        if m.runs.get(run_ts) != {k: v for k, v in old.items() if k not in ("op", "run")}:
            raise RuntimeError(f"run {run_ts} was changed while it was compacted")
        entry = _entry(root, domain, run_ts, path, fmt, files=files, rows=rows, bytes=size, schema=old["schema"])
        return [entry | {"ledger": old["ledger"]} if old.get("ledger") else entry]

    after = _change(spark, root, domain, swap)
    _release(spark, root, domain, run_ts, old)
    if not old.get("log") and kept not in after.references:
        fs, p = _hadoop_fs(spark, kept)
        fs.delete(p, True)
    return files


def drop_run(spark: SparkSession, root: str, domain: str, run_ts: str) -> None:
    """Take a run out of its layer and delete its data.

    Data that other layers refer to is not given up: ``ValueError``, and nothing changes. A run that itself
    refers to another layer only gives back its reference, and files that runs share go with the last of them. Raises ``FileNotFoundError`` without such a run.
    """
    gone: dict = {}

    def make(m: manifest.Manifest) -> list[dict]:
        if run_ts not in m.runs:
            raise FileNotFoundError(f"no committed run {run_ts} of domain {domain!r} under {domain_dir(root, domain)}")
        entry = m.runs[run_ts]
        holders = m.references.get(_place(root, domain, entry), [])
        shared = any(k != run_ts and r["path"] == entry["path"] for k, r in m.runs.items())
        if holders and not shared:
            raise ValueError(f"run {run_ts} is referred to by {holders}")
        gone.update(entry, shared=shared)
        return [{"op": "drop", "run": run_ts}]

    _change(spark, root, domain, make)
    _forget(spark, root, domain, run_ts)
    if gone.get("log"):
        _release(spark, root, domain, run_ts, gone)
    elif not gone["shared"]:
        fs, path = _hadoop_fs(spark, _place(root, domain, gone))
        fs.delete(path, True)


def read_run(
    spark: SparkSession,
    root: str,
    domain: str,
    run_ts: str,
    fmt: str = "parquet",
    with_run_ts: bool = False,
) -> DataFrame:
    """All rows of one run (its data columns; plus ``run_ts`` when asked), wherever the run log says they lie.

    Columns and types come from the log, where it has them; no file is opened to plan the read.
    """
    state = manifest.load(spark, domain_dir(root, domain))
    entry = state.runs.get(run_ts) if state else None
    if entry is None:
        df = load_files(spark, fmt, run_dir(root, domain, run_ts))
    elif entry["packed"]:
        df = _packed(spark, root, domain, [(run_ts, entry)], fmt)
        return df if with_run_ts else df.drop(RUN_COLUMN)
    else:
        schema = T.StructType.fromJson(json.loads(entry["schema"])) if entry["schema"] else None
        df = load_files(spark, fmt, _place(root, domain, entry), schema)
    if with_run_ts:
        df = df.withColumn(RUN_COLUMN, F.lit(run_ts))
    return df


def _packed(spark: SparkSession, root: str, domain: str, runs: list[tuple[str, dict]], fmt: str) -> DataFrame:
    """The rows of some runs that one write has packed together, with ``run_ts``."""
    entry = runs[0][1]
    fields = T.StructType.fromJson(json.loads(entry["schema"])).fields
    schema = T.StructType([*fields, T.StructField(RUN_COLUMN, T.StringType())])
    df = _reader(spark, fmt).schema(schema).load(_place(root, domain, entry))
    keys = [key for key, _ in runs]
    # files are sorted by run: the key's range leaves out files and row groups
    return df if len(keys) == entry["packed"] else df.filter(F.col(RUN_COLUMN).isin(keys))


def read_layer(spark: SparkSession, root: str, domain: str, fmt: str = "parquet", day: str | None = None,
               runs: list[str] | None = None) -> DataFrame:
    """Every committed run of ``domain`` (of ``day``, or of ``runs``, when given) as one lazy frame with a string ``run_ts`` column.

    Planned from the run log: neither other runs' folders nor any file footer is read. The
    schema has the columns of all Parquet runs (a run that lacks one reads
    NULL there); CSV runs must have one header. It is given explicitly so that ``run_ts`` stays
    text; filters on ``run_ts`` prune directories. Raises ``FileNotFoundError`` without runs.
    """
    base = domain_dir(root, domain)
    entries = {k: e for k, e in _entries(spark, root, domain, check_day(day)).items() if runs is None or k in runs}
    if not entries:
        raise FileNotFoundError(f"no run of domain {domain!r} under {base}")
    groups: dict[tuple[str, int], list[tuple[str, dict]]] = {}
    for key in sorted(entries):
        place = _place(root, domain, entries[key])
        packed = entries[key]["packed"]
        groups.setdefault((place if packed else place.rpartition("/")[0], packed), []).append((key, entries[key]))
    fields = _merged_fields([e["schema"] for e in entries.values()])
    frames = []
    for (parent, packed), group in groups.items():
        if packed:
            frames.append(_packed(spark, root, domain, group, fmt))
            continue
        paths = [_place(root, domain, e) for _, e in group]
        reader = _reader(spark, fmt).option("basePath", parent)
        if fields is None:
            inferred = reader.option("mergeSchema", fmt == "parquet").load(paths).schema
            own = [f for f in inferred.fields if f.name != RUN_COLUMN]
        else:
            own = fields
        schema = T.StructType([*own, T.StructField(RUN_COLUMN, T.StringType(), True)])
        frames.append(_reader(spark, fmt).option("basePath", parent).schema(schema).load(paths))
    whole = frames[0]
    for df in frames[1:]:
        whole = whole.unionByName(df, allowMissingColumns=True)
    return whole


def _merged_fields(schemas: list[str | None]) -> list[T.StructField] | None:
    """The columns of all schemas; None where one is unknown or a column has two types: the files must tell."""
    found: dict[str, T.StructField] = {}
    for text in dict.fromkeys(schemas):
        if text is None:
            return None
        for f in T.StructType.fromJson(json.loads(text)).fields:
            if found.setdefault(f.name, f).dataType != f.dataType:
                return None
    return list(found.values())


def write_runs(df: DataFrame, root: str, domain: str, run_col: str = RUN_COLUMN, fmt: str = "parquet",
               packed: bool = False) -> list[str]:
    """Write each row of ``df`` to the run that ``run_col`` names, all runs in one job and one entry of the run log.

    Runs that occur in ``df`` are replaced, others stay. Rows without a run key are refused.
    Each run gets its directory; with ``packed`` (Parquet only), which suits many small runs, all of them share the
    files of this write, ordered by run so that a run is found by file and row-group statistics. The files then
    are as large as Spark's advisory partition size makes them, however the rows are spread over the runs.
    Returns the run keys, newest first.
    """
    spark = df.sparkSession
    base = domain_dir(root, domain)
    if packed and fmt != "parquet":
        raise ValueError("packed runs are Parquet")
    seen = Observation(f"runs written to {base}")
    key = F.col(run_col)
    good = F.coalesce(key.rlike("^[0-9]{12}$"), F.lit(False))
    checked = F.when(good, key).otherwise(F.raise_error(F.concat(F.lit("not a run key: "), F.coalesce(key, F.lit("NULL")))))
    rows = df.withColumn(RUN_COLUMN, checked)
    columns = rows.drop(RUN_COLUMN)
    rows = rows.observe(seen, F.collect_set(RUN_COLUMN).alias("runs"))
    if packed:
        path = f"{base}/_packed-{uuid.uuid4().hex[:12]}"
        rows.sortWithinPartitions(RUN_COLUMN).write.parquet(path)
    else:
        log_now = manifest.load(spark, base)
        if log_now and log_now.references:
            raise ValueError(f"other layers refer to runs of {base}: write them one by one")
        w = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN_COLUMN)
        if _check_format(fmt) != "parquet":
            w = w.option("header", True)
        w.format("parquet" if fmt == "parquet" else "csv").save(base)
    keys = sorted(seen.get["runs"], reverse=True)
    schema = _schema_of(columns, fmt)
    replaced: dict = {}

    def make(m: manifest.Manifest) -> list[dict]:
        replaced.update({k: m.runs[k] for k in keys if k in m.runs})
        return [_entry(root, domain, k, path if packed else run_dir(root, domain, k), fmt, schema=schema,
                       packed=len(keys) if packed else 0) for k in keys]

    _change(spark, root, domain, make)
    for k in replaced:
        _forget(spark, root, domain, k)
    for k, old in replaced.items():
        _release(spark, root, domain, k, old)
    return keys


def _hadoop_fs(spark: SparkSession, path: str):
    sc = jvm_context(spark)
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def _writes_success_marker(spark: SparkSession) -> bool:
    conf = jvm_context(spark)._jsc.hadoopConfiguration()
    return conf.getBoolean("mapreduce.fileoutputcommitter.marksuccessfuljobs", True)


def _run_complete(fs, path, need_marker: bool) -> bool:
    """A committed run: it has the ``_SUCCESS`` marker, or -- where jobs write
    no marker -- at least one ``part-`` file. Listed page by page; stops early."""
    has_part = False
    it = fs.listStatusIterator(path)
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if name == "_SUCCESS":
            return True
        if st.isFile() and name.startswith("part-"):
            has_part = True
            if not need_marker:
                return True
    return has_part and not need_marker


def literal_path(path: str) -> str:
    """A glob pattern that matches ``path`` alone."""
    return re.sub(r"([][{}*?^,\\])", r"\\\1", path)


def list_landing(spark: SparkSession, landing: str) -> list[str]:
    """CSV entries of a landing folder (files, plain or compressed, or folders
    of part files; any letter case), as full paths, sorted. Hidden entries
    (``_``, ``.``) are skipped; any other entry raises ``ValueError``. One
    directory listing, page by page."""
    fs, base = _hadoop_fs(spark, landing)
    if not fs.exists(base):
        return []
    taken, others = [], []
    it = fs.listStatusIterator(base)
    while it.hasNext():
        path = it.next().getPath()
        if not path.getName().startswith(("_", ".")):
            (taken if RAW_SUFFIX.search(path.getName()) else others).append(path.toString())
    if others:
        raise ValueError(f"not CSV, under {landing}: {sorted(others)[:10]} ({len(others)} in all)")
    return sorted(taken)


def run_bytes(spark: SparkSession, root: str, domain: str, run_ts: str) -> int:
    """Total size in bytes of the files of one run (from the run log, or one metadata call)."""
    state = manifest.load(spark, domain_dir(root, domain))
    entry = state.runs.get(run_ts) if state else None
    if entry and entry["bytes"] is not None:
        return entry["bytes"]
    fs, path = _hadoop_fs(spark, _place(root, domain, entry) if entry else run_dir(root, domain, run_ts))
    return int(fs.getContentSummary(path).getLength())


def run_rows(spark: SparkSession, root: str, domain: str, run_ts: str) -> int:
    """The rows of one committed run (from the run log, or counted)."""
    entry = _entries(spark, root, domain)[run_ts]
    return entry["rows"] if entry["rows"] is not None else read_run(spark, root, domain, run_ts).count()


def state_dir(root: str, domain: str) -> str:
    """Where what is known about a domain's runs, beside the run log, is kept."""
    return f"{domain_dir(root, domain)}/_state"


def is_state(spark: SparkSession, path: str) -> bool:
    """Whether the state of a run is complete: its filter, which is written last, is committed."""
    return state_is_written(spark, f"{path}/kind=bloom")


def state_is_written(spark: SparkSession, path: str) -> bool:
    """Whether one kind of state of a run is committed."""
    fs, p = _hadoop_fs(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


def run_files_of(spark: SparkSession, root: str, domain: str, run_ts: str) -> str:
    """The directory that holds a committed run's files, and those of no other run.

    Raises ``FileNotFoundError`` without such a run, ``ValueError`` where it shares its files (``write_runs(packed=True)``).
    """
    entry = _entries(spark, root, domain).get(check_run(run_ts))
    if entry is None:
        raise FileNotFoundError(f"no committed run {run_ts} of domain {domain!r} under {domain_dir(root, domain)}")
    if entry["packed"]:
        raise ValueError(f"run {run_ts} shares its files with other runs")
    return _place(root, domain, entry)


def list_runs(spark: SparkSession, root: str, domain: str, day: str | None = None) -> list[str]:
    """Run keys of ``domain`` (of ``day`` when given), newest first: those in the run log and those with a directory.

    One directory listing of ``LOCAL_<DOMAIN>/`` -- metadata only, one entry
    per run, no data file is opened.
    """
    check_day(day)
    state = manifest.load(spark, domain_dir(root, domain))
    keys = {k for k in (state.runs if state else {}) if day is None or k.startswith(day)}
    fs, base = _hadoop_fs(spark, domain_dir(root, domain))
    if not fs.exists(base):
        return []
    it = fs.listStatusIterator(base)
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if not (st.isDirectory() and name.startswith(f"{RUN_COLUMN}=")):
            continue
        key = name[len(RUN_COLUMN) + 1:]
        if RUN_KEY.fullmatch(key) and (day is None or key.startswith(day)):
            keys.add(key)
    return sorted(keys, reverse=True)


def _marked(spark: SparkSession, root: str, domain: str, run_ts: str) -> bool:
    fs, path = _hadoop_fs(spark, run_dir(root, domain, run_ts))
    return fs.exists(path) and _run_complete(fs, path, _writes_success_marker(spark))


def _marked_runs(spark: SparkSession, root: str, domain: str, day: str | None = None) -> list[str]:
    """Runs with a commit marker: one look-up of all markers, or run by run where jobs write none."""
    keys = list_runs(spark, root, domain, day)
    if not _writes_success_marker(spark):
        return [key for key in keys if _marked(spark, root, domain, key)]
    base = re.sub(r"([][{}*?^\\])", r"\\\1", domain_dir(root, domain))
    fs, markers = _hadoop_fs(spark, f"{base}/{RUN_COLUMN}={day or ''}*/_SUCCESS")
    marked = {st.getPath().getParent().getName() for st in fs.globStatus(markers) or []}
    return [key for key in keys if f"{RUN_COLUMN}={key}" in marked]


def _entries(spark: SparkSession, root: str, domain: str, day: str | None = None) -> dict[str, dict]:
    """Run key -> log entry of the committed runs (of ``day`` when given).

    Without a log, the runs with a commit marker; where jobs write no markers, other programs' runs
    are known by their files only, and count beside those of the log.
    """
    state = manifest.load(spark, domain_dir(root, domain))
    marked = [] if state and _writes_success_marker(spark) else _marked_runs(spark, root, domain, day)
    found = {k: _entry(root, domain, k, run_dir(root, domain, k), None) for k in marked}
    return found | {k: e for k, e in (state.runs if state else {}).items() if day is None or k.startswith(day)}


def is_committed(spark: SparkSession, root: str, domain: str, run_ts: str) -> bool:
    """Whether a run is in the domain's run log. (A domain without a log: whether it carries the ``_SUCCESS``
    marker. When the Hadoop setting ``mapreduce.fileoutputcommitter.marksuccessfuljobs`` is off, a ``part-`` file is enough.)"""
    state = manifest.load(spark, domain_dir(root, domain))
    if state and (run_ts in state.runs or _writes_success_marker(spark)):
        return run_ts in state.runs
    return _marked(spark, root, domain, run_ts)


def committed_runs(spark: SparkSession, root: str, domain: str, day: str | None = None) -> list[str]:
    """Keys of the committed runs of ``domain`` (of ``day`` when given), newest first."""
    return sorted(_entries(spark, root, domain, check_day(day)), reverse=True)


def resolve_run(spark: SparkSession, root: str, domain: str, day: str | None = None) -> str:
    """Key of the latest committed run of ``domain`` (of ``day`` when given).

    Read off the run log; a run left empty or half-written by a failed job is not in it.
    Raises ``FileNotFoundError`` when there is none.
    """
    keys = committed_runs(spark, root, domain, day)
    if keys:
        return keys[0]
    when = f"day {day}" if day else "any day"
    raise FileNotFoundError(f"no run of domain {domain!r} for {when} under {domain_dir(root, domain)}")


def read_latest(
    spark: SparkSession,
    root: str,
    domain: str,
    day: str | None = None,
    fmt: str = "parquet",
    with_run_ts: bool = False,
    source_run: str | None = None,
) -> tuple[str, DataFrame]:
    """``(run_ts, frame)`` of run ``source_run``, or else of the latest committed run (of ``day`` when given).

    One listing, then a scan of that run's files only. Raises
    ``FileNotFoundError`` when there is no such committed run.
    """
    if source_run is None:
        key = resolve_run(spark, root, domain, day)
    else:
        key = check_run(source_run)
        if not is_committed(spark, root, domain, key):
            raise FileNotFoundError(f"no committed run {key} of domain {domain!r} under {domain_dir(root, domain)}")
    return key, read_run(spark, root, domain, key, fmt, with_run_ts)
