"""The layer hand-offs: raw -> bronze -> silver -> diamond -> table + gold.

Each step reads one run and writes one run; the write is the step's only
action, so the step is one Spark job over the whole data (plus one small
listing to find the input run). Writing every layer to shared storage also
cuts lineage: a lost executor costs a recomputation of the current step
only. The driver handles paths and run keys, never rows.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.fixed import DOMAIN_NAME_SEPARATOR, PUBLISHED_TABLE_SUFFIX
from strata.operators.incremental import admitted, bloom, filter_bits, row_digest, without_known
from strata.operators.refine import APPOINTMENTS, RefineSpec, broken_rules, refine, retype, rules_of
from strata.operators.runs import check_day, check_run, domain_of, run_stamp
from strata.session import DEDUP_INPUT_BYTES_PER_PARTITION, scratch_dir, session_with, shuffle_partitions_for
from strata.sources.layers import (
    committed_runs, drop_split, is_state, lease, list_landing, literal_path, new_files, read_latest, read_layer,
    read_raw_csv, read_run, refer_run, resolve_run, run_bytes, run_rows, state_dir, write_run, write_split,
)
from strata.sources.tables import JdbcTarget, publish_jdbc, publish_table_at, to_publishable


log = logging.getLogger("strata")


@dataclass(frozen=True)
class LakeRoots:
    """Root URI of each layer (any Hadoop file system)."""

    bronze: str
    silver: str
    diamond: str
    gold: str

    @classmethod
    def under(cls, base: str) -> "LakeRoots":
        base = base.rstrip("/")
        return cls(f"{base}/bronze", f"{base}/silver", f"{base}/diamond", f"{base}/gold")


@dataclass(frozen=True)
class PublishResult:
    table: str
    created: bool
    source_run: str
    backup_run: str


def ingest(
    spark: SparkSession,
    raw_uri: str,
    bronze_root: str,
    run_ts: str | None = None,
    domain: str | None = None,
    num_files: int | None = None,
    preserve_whitespace: bool = False,
) -> tuple[str, str]:
    """Raw CSV (header, all text) -> bronze CSV run. Returns ``(domain, run_ts)``.

    The domain defaults to the raw file's name up to the first ``_``.
    """
    domain = domain or domain_of(raw_uri)
    run_ts = check_run(run_ts or run_stamp())
    path = write_run(read_raw_csv(spark, raw_uri), bronze_root, domain, run_ts, "csv", num_files,
                     preserve_whitespace)
    log.info("ingest: %s -> %s", raw_uri, path)
    return domain, run_ts


def ingest_landing(
    spark: SparkSession,
    landing: str,
    bronze_root: str,
    run_ts: str | None = None,
    num_files: int | None = None,
    preserve_whitespace: bool = False,
    parallel_domains: int = 4,
    only_new: bool = False,
) -> dict[str, str]:
    """Every raw CSV in a landing folder, plain or compressed -> one bronze run per domain.

    Files are grouped by the domain in their names (``pacientes_a.csv`` and
    ``pacientes_b.csv`` load together); each domain is one distributed read
    of all its files, so files of different domains (different headers)
    never mix. Up to ``parallel_domains`` domain jobs are submitted at once,
    so many small domains do not leave the cluster idle between jobs; every
    domain is attempted and the first failure is raised at the end. Returns
    ``{domain: run_ts}``; raises ``FileNotFoundError`` when the folder holds
    no CSV, and ``ValueError`` before anything is loaded when it holds other entries.
    A domain's files reach Spark as a few name patterns, not as a path each.

    With ``only_new``, files that an earlier such call has loaded are left out, and a domain without other files
    gets no run and is not in the result. Which files a run was loaded from is committed with the run
    (``layers.new_files``): a call that dies before that has loaded nothing, and of two calls at
    once one is refused with ``RuntimeError``. So is a second call with new files under a run key that is taken. Files must be put into
    the folder whole. Dropping a run gives its files free again; runs of calls without ``only_new`` are not remembered.
    """
    run_ts = check_run(run_ts or run_stamp())
    groups: dict[str, list[str]] = {}
    for path in list_landing(spark, landing):
        groups.setdefault(domain_of(path), []).append(path)
    if not groups:
        raise FileNotFoundError(f"no raw CSV under {landing}")

    def one(domain: str) -> bool:
        paths, ledger = _patterns(groups[domain]), None
        if only_new:
            ledger, files = new_files(spark, bronze_root, domain, paths)
            if not files:
                return False
            paths = [literal_path(f) for f in files]
        raw = read_raw_csv(spark, paths)
        path = write_run(raw, bronze_root, domain, run_ts, "csv", num_files, preserve_whitespace,
                         ledger.guard(run_ts) if ledger else None)
        log.info("ingest: %d file(s) of domain %s -> %s", len(paths) if only_new else len(groups[domain]), domain, path)
        return True

    with ThreadPoolExecutor(max_workers=max(1, min(parallel_domains, len(groups)))) as pool:
        futures = {d: pool.submit(one, d) for d in sorted(groups)}
    errors = [f.exception() for f in futures.values() if f.exception() is not None]
    if errors:
        raise errors[0]
    return {d: run_ts for d in groups if futures[d].result()}



def _patterns(paths: list[str]) -> list[str]:
    """Glob patterns that match exactly ``paths``, entries of one domain in a folder without
    other entries: one for each spelling of the domain, with and without a name part after it."""
    found = set()
    for path in paths:
        folder, _, name = path.rpartition("/")
        stem, sep, _ = name.partition(DOMAIN_NAME_SEPARATOR)
        if not sep:
            stem, sep, _ = name.partition(".")
        found.add(f"{folder}/{literal_path(stem)}{sep}*")
    return sorted(found)


def refine_latest(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    domain: str,
    spec: RefineSpec = APPOINTMENTS,
    day: str | None = None,
    run_ts: str | None = None,
    num_files: int | None = None,
    bytes_per_partition: int = DEDUP_INPUT_BYTES_PER_PARTITION,
    source_run: str | None = None,
) -> str:
    """Bronze run -> ``refine`` -> silver Parquet run. Returns the new run key.

    Takes run ``source_run``, or else the latest of ``day``. The dedup's
    reducer count is sized from the input run's bytes (about
    ``bytes_per_partition`` of input per reducer, never fewer reducers than
    the session asks for), so that a reducer's input does not grow with the
    run; AQE merges reducers that end up small. The count is set on a session of the
    step's own. Raises ``FileNotFoundError`` when bronze has no such run.
    """
    check_day(day)
    src, _ = read_latest(spark, bronze_root, domain, day, "csv", source_run=source_run)
    out = check_run(run_ts or run_stamp())
    parts = shuffle_partitions_for(spark, run_bytes(spark, bronze_root, domain, src), bytes_per_partition)
    own = session_with(spark, {"spark.sql.shuffle.partitions": str(parts)})
    refined = refine(read_run(own, bronze_root, domain, src, "csv"), spec)
    path = write_run(refined, silver_root, domain, out, "parquet", num_files)
    log.info("refine: bronze run %s (%d dedup reducers) -> %s", src, parts, path)
    return out


@dataclass(frozen=True)
class RefineResult:
    """``rejected`` + ``kept`` is the input; ``kept`` is counted before the dedup. ``by_rule``: rows that break each rule."""

    run_ts: str
    kept: int
    rejected: int
    by_rule: dict[str, int]


def refine_with_rejects(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    rejects_root: str,
    domain: str,
    spec: RefineSpec = APPOINTMENTS,
    day: str | None = None,
    run_ts: str | None = None,
    source_run: str | None = None,
) -> RefineResult:
    """Bronze run -> ``refine`` -> silver run as ``refine_latest`` does, and the rows it drops -> run of the layer at ``rejects_root``.

    A rejected row keeps its bronze text, with ``broken`` as the bit set of the rules it breaks (``refine.rules_of``). Bronze
    is scanned once: the rules are computed once a row, all counts come from the same job, and its rows are written once,
    parted into kept and rejected. The rejected part is the run; the kept part is read back, as Parquet, for retyping and dedup, and then
    deleted. Parted by kept and rejected only, not by rule set, so a task writes two files at most.
    A run without rejected rows gets an empty run of rejects. The two runs have one key; the rejects are
    committed first. Raises ``ValueError`` for a bronze column ``broken`` or ``rejected``, ``FileNotFoundError`` without such a bronze run.
    """
    src, rows = read_latest(spark, bronze_root, domain, check_day(day), "csv", source_run=source_run)
    out = check_run(run_ts or run_stamp())
    taken = {"broken", "rejected"} & {c.lower() for c in rows.columns}
    if taken:
        raise ValueError(f"bronze columns {sorted(taken)} have names that rejected rows need")
    parts = shuffle_partitions_for(spark, run_bytes(spark, bronze_root, domain, src))
    own = session_with(spark, {"spark.sql.shuffle.partitions": str(parts)})
    # Two projections: the bit set is used by the partition, the counts and the column
    judged = read_run(own, bronze_root, domain, src, "csv").withColumn("broken", broken_rules(spec))
    judged = judged.withColumn("rejected", F.col("broken") != 0)
    names = list(rules_of(spec))
    counts = {n: F.count_if(F.col("broken").bitwiseAND(F.lit(1 << i).cast("long")) != 0) for i, n in enumerate(names)}
    kept_path, found = write_split(judged, rejects_root, domain, out, "rejected",
                                   {"kept": F.count_if(~F.col("rejected")), "rejected": F.count_if(F.col("rejected")), **counts})
    kept = own.read.schema(rows.schema).parquet(kept_path) if kept_path else rows.filter(F.lit(False))
    kept = retype(kept, spec)
    write_run(kept.dropDuplicates() if spec.dedup else kept, silver_root, domain, out)
    drop_split(spark, kept_path)
    log.info("refine: bronze run %s, %d rows kept, %d rejected -> %s", src, found["kept"], found["rejected"], out)
    return RefineResult(out, found["kept"], found["rejected"], {n: found[n] for n in names})


def refine_incremental(
    spark: SparkSession,
    bronze_root: str,
    silver_root: str,
    domain: str,
    spec: RefineSpec = APPOINTMENTS,
    day: str | None = None,
    run_ts: str | None = None,
    source_run: str | None = None,
) -> tuple[str, list[str]]:
    """Bronze run -> the refined rows that no silver run has yet -> silver run. Returns its key and the silver runs it had to read.

    All silver runs together then hold what whole-row dedup over all bronze runs would give, each row
    once. Which earlier runs may share rows is told by their states (``operators.incremental``): only those
    are read. Runs without a state (written by ``refine_latest``) are always read. The state of
    the new run is written before its run log entry could be missed by the next call: a run whose state
    is missing is simply read. A repeated call with the same ``run_ts`` replaces the run.
    """
    src, _ = read_latest(spark, bronze_root, domain, check_day(day), "csv", source_run=source_run)
    out = check_run(run_ts or run_stamp())
    parts = shuffle_partitions_for(spark, run_bytes(spark, bronze_root, domain, src))
    own = session_with(spark, {"spark.sql.shuffle.partitions": str(parts)})
    new = refine(read_run(own, bronze_root, domain, src, "csv"), spec)
    staged = scratch_dir(own, "refined")
    new.write.parquet(staged)
    new = own.read.schema(new.schema).parquet(staged)
    digests = new.select(row_digest(new.columns).alias("digest"))
    before = [r for r in committed_runs(own, silver_root, domain) if r != out]
    states = {r: f"{state_dir(silver_root, domain)}/run_ts={r}" for r in before}
    kept = [r for r in before if is_state(own, states[r])]
    to_read = [r for r in before if r not in kept]
    if kept:
        def state(kind: str, columns: str) -> DataFrame:
            frames = own.read.option("basePath", state_dir(silver_root, domain)).schema(f"{columns}, run_ts string")
            return frames.parquet(*[f"{states[r]}/kind={kind}" for r in kept])

        asked = admitted(digests, state("bloom", "size int, bucket long, bits binary"))
        hits = asked.join(state("digest", "digest long"), ["run_ts", "digest"], "left_semi")
        to_read += hits.agg(F.collect_set("run_ts").alias("runs")).first().runs
    if to_read:
        known = read_layer(own, silver_root, domain, runs=sorted(to_read))
        new = without_known(new, known)
    path = write_run(new, silver_root, domain, out)
    written = read_run(own, silver_root, domain, out)
    place = f"{state_dir(silver_root, domain)}/run_ts={out}"
    digests = written.select(row_digest(written.columns).alias("digest"))
    digests.write.mode("overwrite").parquet(f"{place}/kind=digest")
    saved = own.read.schema("digest long").parquet(f"{place}/kind=digest")
    bloom(saved, filter_bits(run_rows(own, silver_root, domain, out))).write.mode("overwrite").parquet(f"{place}/kind=bloom")
    log.info("refine: bronze run %s, %d of %d silver runs read -> %s", src, len(to_read), len(before), path)
    return out, sorted(to_read)


def promote(
    spark: SparkSession,
    src_root: str,
    dst_root: str,
    domain: str,
    day: str | None = None,
    fmt: str = "parquet",
    num_files: int | None = None,
    source_run: str | None = None,
    copy: bool = False,
) -> str:
    """Make run ``source_run``, or else the latest run (of ``day``; any day by default), a run of another layer too.

    No data is read or written: the target's run log refers to the source's files, and while it does so
    they cannot be dropped or overwritten (``refer_run``). The run keeps its key. ``copy=True``,
    or ``num_files``, copies the rows instead: a distributed read + write of the run's files, for a target
    that must not depend on the source's storage. Returns the run key.
    """
    check_day(day)
    if copy or num_files is not None:
        key, df = read_latest(spark, src_root, domain, day, fmt, source_run=source_run)
        path = write_run(df, dst_root, domain, key, fmt, num_files)
    else:
        key = check_run(source_run) if source_run else resolve_run(spark, src_root, domain, day)
        path = refer_run(spark, src_root, dst_root, domain, key)
    log.info("promote: run %s -> %s", key, path)
    return key


def publish(
    spark: SparkSession,
    source_root: str,
    backup_root: str,
    domain: str,
    day: str | None = None,
    table: str | None = None,
    table_path: str | None = None,
    jdbc: JdbcTarget | None = None,
    source_format: str = "parquet",
    backup_format: str = "parquet",
    run_ts: str | None = None,
    transform: Callable[[DataFrame], DataFrame] | None = None,
    num_files: int | None = None,
    source_run: str | None = None,
    lease_seconds: float = 6 * 3600,
) -> PublishResult:
    """Source run -> backup run + table ``<domain>_diamond`` (if absent).

    Takes run ``source_run``, or else the latest of ``day``. ``transform`` is
    applied first (a hook for analytic shaping). The backup run is written to
    ``backup_root`` whether or not the table is created. A Parquet backup is
    what the table is then loaded from, so source and ``transform`` run once;
    a CSV backup (``backup_format="csv"``: quoted, see ``write_run``) has no
    types, and the table is loaded from the source. The table goes to
    ``jdbc`` when given, else to the session catalog, external in a folder of this call's own under
    ``table_path`` (default ``<backup_root>/_tables/<table>``).

    One caller publishes a table at a time: it holds a lease in the backup's run log (``layers.lease``), and others are refused with
    ``RuntimeError`` before they write. A caller that holds it longer than ``lease_seconds`` may be overtaken; its backup is then
    refused, and it creates no table once it has seen so. From there on the catalog decides: it takes a name once. Which run the table was loaded from is in the log
    (``layers.published_run``).
    """
    src, df = read_latest(spark, source_root, domain, check_day(day), source_format, source_run=source_run)
    if transform is not None:
        df = transform(df)
    name = table or f"{domain}{PUBLISHED_TABLE_SUFFIX}"
    backup_run = check_run(run_ts or run_stamp())
    with lease(spark, backup_root, domain, name, lease_seconds) as held:
        if backup_format == "csv":
            path = write_run(to_publishable(df), backup_root, domain, backup_run, "csv_quoted", num_files, guard=held.guard)
        else:
            path = write_run(df, backup_root, domain, backup_run, backup_format, num_files, guard=held.guard)
            df = read_run(spark, backup_root, domain, backup_run, backup_format)
        out = to_publishable(df)
        held.check()
        if jdbc:
            created = publish_jdbc(out, jdbc, name)
        else:
            base = (table_path or f"{backup_root.rstrip('/')}/_tables/{name}").rstrip("/")
            created = publish_table_at(out, name, f"{base}/lease-{held.number}-{uuid.uuid4().hex[:8]}")
        if created:
            held.record(backup_run)
    log.info("publish: run %s -> table %s (%s); backup -> %s", src, name,
             "created" if created else "already present, left as is", path)
    return PublishResult(name, created, src, backup_run)


def run_pipeline(
    spark: SparkSession,
    raw_uri: str,
    roots: LakeRoots,
    spec: RefineSpec = APPOINTMENTS,
    run_ts: str | None = None,
    table: str | None = None,
    table_path: str | None = None,
    jdbc: JdbcTarget | None = None,
    gold_transform: Callable[[DataFrame], DataFrame] | None = None,
    num_files: int | None = None,
) -> PublishResult:
    """Raw CSV -> bronze -> silver -> diamond -> table + gold, all under one run key.

    Every step takes the run of this key, also when later runs exist (a backfill).
    """
    run_ts = check_run(run_ts or run_stamp())
    domain, _ = ingest(spark, raw_uri, roots.bronze, run_ts, num_files=num_files)
    refine_latest(spark, roots.bronze, roots.silver, domain, spec, run_ts=run_ts, num_files=num_files, source_run=run_ts)
    promote(spark, roots.silver, roots.diamond, domain, num_files=num_files, source_run=run_ts)
    return publish(spark, roots.diamond, roots.gold, domain, None, table, table_path, jdbc,
                   run_ts=run_ts, transform=gold_transform, num_files=num_files, source_run=run_ts)
