"""Registered queries over the benchmark tables, and their DuckDB oracles.

Each query takes ``(spark, sf_dir)`` and returns a lazy DataFrame. Queries
that exercise storage (layers, tables) write under a fresh folder in the
session's checkpoint root first; the returned frame reads what was written.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.refine import APPOINTMENTS, RefineSpec, refine, rule_names
from strata.operators.runs import RUN_COLUMN, latest_run, run_of_path
from strata.functions.rules import date_prefix, int_between_exclusive, not_blank
from strata.plans.pipeline import (
    LakeRoots, ingest, ingest_landing, promote, publish, refine_incremental, refine_with_rejects, run_pipeline,
)
from strata.plans.views import (
    appointments_view, hourly_runs_view, padded_customers_view, part_ages_view, table,
)
from strata.session import scratch_dir
from strata.sources.layers import (
    compact_run, domain_dir, published_run, read_latest, read_layer, read_run, resolve_run, run_bytes, run_dir, write_run, write_runs,
)
from strata.sources.legacy import adopt_legacy_backups, adopt_legacy_runs
from strata.sources.tables import publish_table, publishable_column, to_publishable
from strata.sources.zones import build_zones, read_between

DAY = "20240110"
FIRST_RUN = "202412311800"
EARLY_RUN = "202501010900"
LATE_RUN = "202501021000"
GOLD_RUN = "202505151030"


def refine_appointments(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship, CMP-2 core: the appointments rule set over the derived view of ``events``."""
    return refine(appointments_view(table(spark, sf, "events")).drop("event_id"), APPOINTMENTS)


def not_blank_names(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-1: names that are neither NULL nor empty (whitespace-only counts as present)."""
    v = appointments_view(table(spark, sf, "events"))
    return v.filter(not_blank("nombre")).select("event_id", "nombre")


def int_range(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-2, FN-6: 0 < int(text) < 120 with legacy-cast truncation ('120.5' -> 120, dropped)."""
    return part_ages_view(table(spark, sf, "part")).filter(int_between_exclusive("edad", 0, 120))


def date_prefix_retype(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-1, FN-1..3, FLT-3: text before the first space -> date; unparsable rows dropped."""
    v = appointments_view(table(spark, sf, "events"))
    return (v.select("event_id", date_prefix("fecha_turno").alias("fecha_turno"))
            .dropna(subset=["fecha_turno"]))


def distinct_after_retype(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-1, S5: whole-row dedup after the time of day is cut off."""
    ev = table(spark, sf, "events").select(
        "user_id", "event_type", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("fecha"))
    return refine(ev, RefineSpec(dates=("fecha",), dedup=True))


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-1, SRC-2: a run written as CSV with a header reads back as all-text columns."""
    root = scratch_dir(spark, "csv_roundtrip")
    write_run(table(spark, sf, "orders"), root, "orders", EARLY_RUN, "csv")
    return read_run(spark, root, "orders", EARLY_RUN, "csv")


def csv_free_text(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-4: free text with line breaks, quotes and backslashes survives the CSV backup of the older publish."""
    roots = LakeRoots.under(scratch_dir(spark, "csv_text"))
    docs = table(spark, sf, "documents").withColumn("quoted", F.concat(F.lit('say "a\\b",\n ,\''), "source", F.lit('"\\')))
    write_run(docs, roots.silver, "documents", EARLY_RUN)
    res = publish(spark, roots.silver, roots.diamond, "documents", day=EARLY_RUN[:8],
                  table=f"documents_diamond_{uuid.uuid4().hex[:12]}", backup_format="csv", run_ts=LATE_RUN)
    return read_run(spark, roots.diamond, "documents", res.backup_run, "csv_quoted")


def _hour_layer(spark: SparkSession, sf: str) -> str:
    """Hourly runs of ``events``, and two newer runs that were written but never committed."""
    root = scratch_dir(spark, "hours")
    runs = hourly_runs_view(table(spark, sf, "events"))
    write_runs(runs, root, "events", packed=True)
    for key in (f"{DAY}2359", "209901010000"):
        runs.drop(RUN_COLUMN).write.parquet(run_dir(root, "events", key))
    return root


def latest_run_of_day(spark: SparkSession, sf: str) -> DataFrame:
    """RUN-1: rows of the latest committed run of one day, found in the run log."""
    return read_latest(spark, _hour_layer(spark, sf), "events", day=DAY, with_run_ts=True)[1]


def latest_run_any_day(spark: SparkSession, sf: str) -> DataFrame:
    """RUN-2: rows of the latest committed run of any day (lazy broadcast semi-join over the layer)."""
    return latest_run(read_layer(spark, _hour_layer(spark, sf), "events"))


def missing_day(spark: SparkSession, sf: str) -> DataFrame:
    """RUN-3: a day without runs raises; the layer's own days do not. Rows of the found run, with both outcomes."""
    root = _hour_layer(spark, sf)
    try:
        resolve_run(spark, root, "events", "19990101")
        raised = False
    except FileNotFoundError:
        raised = True
    return read_run(spark, root, "events", resolve_run(spark, root, "events", DAY), with_run_ts=True).withColumn(
        "missing_raises", F.lit(raised))


def _orders_by_run(spark: SparkSession, sf: str) -> DataFrame:
    """All ``orders``; the status decides the run."""
    status = F.col("o_orderstatus")
    key = F.when(status == "P", FIRST_RUN).when(status == "F", EARLY_RUN).otherwise(LATE_RUN)
    return table(spark, sf, "orders").withColumn(RUN_COLUMN, key)


def promote_run(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-5, CMP-3: every silver run becomes a diamond run under its key, the latest by default; no row is rewritten."""
    roots = LakeRoots.under(scratch_dir(spark, "promote"))
    write_runs(_orders_by_run(spark, sf), roots.silver, "orders")
    promote(spark, roots.silver, roots.diamond, "orders")
    for key in (FIRST_RUN, EARLY_RUN):
        promote(spark, roots.silver, roots.diamond, "orders", source_run=key)
    return read_layer(spark, roots.diamond, "orders")


def run_of_file(spark: SparkSession, sf: str) -> DataFrame:
    """RUN-5: run key recovered from each file's path (no partition discovery)."""
    roots = LakeRoots.under(scratch_dir(spark, "run_of_file"))
    write_runs(_orders_by_run(spark, sf), roots.silver, "orders")
    files = (spark.read.option("recursiveFileLookup", True)
             .parquet(domain_dir(roots.silver, "orders")))
    return files.select(*table(spark, sf, "orders").columns, run_of_path(F.col("_metadata.file_path")).alias("run_ts"))


def adopt_old_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Runs stored under the old names, with and without part number, are adopted with their keys."""
    base = scratch_dir(spark, "adopt")
    old = domain_dir(base + "/old", "orders")
    runs = _orders_by_run(spark, sf)
    for key, name in ((FIRST_RUN, f"orders_refined_{FIRST_RUN}.parquet"), (EARLY_RUN, f"orders_refined_{EARLY_RUN}00000.parquet"),
                      (LATE_RUN, f"orders_refined_{LATE_RUN}.parquet")):
        runs.filter(F.col(RUN_COLUMN) == key).drop(RUN_COLUMN).write.parquet(f"{old}/{name}")
    adopt_legacy_runs(spark, base + "/old", base + "/silver", "orders")
    return read_layer(spark, base + "/silver", "orders")


def adopt_old_backup(spark: SparkSession, sf: str) -> DataFrame:
    """An older publisher's CSV backup, quotes doubled and line breaks inside fields, is adopted."""
    base = scratch_dir(spark, "adopt_backup")
    docs = table(spark, sf, "documents")
    (docs.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(f"{base}/old/diamond/documents_diamond_{EARLY_RUN}.csv"))
    adopt_legacy_backups(spark, base + "/old", base + "/diamond", "documents", "documents_diamond")
    return read_run(spark, base + "/diamond", "documents", EARLY_RUN, "csv_quoted")


def publish_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-6..8, S10: a second publish, of changed rows, to an existing table changes nothing."""
    base = scratch_dir(spark, "publish")
    name = f"orders_diamond_{uuid.uuid4().hex[:12]}"
    orders = to_publishable(table(spark, sf, "orders"))
    publish_table(orders, name, f"{base}/{name}")
    publish_table(orders.withColumn("o_totalprice", F.lit(0.0)), name, f"{base}/{name}")  # present: nothing happens
    return spark.table(name)


def single_file_run(spark: SparkSession, sf: str) -> DataFrame:
    """PAR-1: a run of many files is compacted to files of 128 MB; a smaller one becomes one file with all rows."""
    root = scratch_dir(spark, "single_file")
    write_run(table(spark, sf, "orders"), root, "orders", EARLY_RUN, num_files=16)
    compact_run(spark, root, "orders", EARLY_RUN, file_bytes=128 << 20)
    run = read_run(spark, root, "orders", EARLY_RUN)
    return run.agg(F.countDistinct(F.col("_metadata.file_path")).alias("files"), F.count(F.lit(1)).alias("n_rows"),
                   F.sum("o_orderkey").alias("key_sum"))


def bounded_files_run(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-2, in place of one file for all: a run of many small files is compacted to files of at most 96 kB of input;
    its rows, and whether there are fewer files than before and every one keeps to twice that size."""
    root = scratch_dir(spark, "bounded_files")
    write_run(table(spark, sf, "lineitem"), root, "lineitem", EARLY_RUN, num_files=64)
    before = run_bytes(spark, root, "lineitem", EARLY_RUN)
    files = compact_run(spark, root, "lineitem", EARLY_RUN, file_bytes=max(96 << 10, before // 16))
    run = read_run(spark, root, "lineitem", EARLY_RUN)
    return run.agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("l_orderkey").alias("key_sum"), F.sum("l_quantity").alias("quantity_sum"),
        (F.countDistinct(F.col("_metadata.file_path")) == files).alias("as_reported"),
        (F.countDistinct(F.col("_metadata.file_path")) < 64).alias("fewer_files"),
        (F.max(F.col("_metadata.file_size")) <= 2 * max(96 << 10, before // 16)).alias("in_band"))


def publishable_types(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-7, §1.3: arrays, structs, maps, zoned timestamps and intervals become types any SQL table can hold."""
    o = table(spark, sf, "orders")
    return to_publishable(o.select(
        "o_orderkey",
        F.array("o_orderkey", "o_custkey").alias("keys"),
        F.array("o_orderstatus", "o_orderpriority").alias("words"),
        F.struct(F.col("o_custkey").alias("cust"), F.col("o_orderpriority").alias("priority")).alias("nested"),
        F.create_map(F.col("o_orderstatus"), F.col("o_custkey")).alias("by_status"),
        F.col("o_orderdate").cast("timestamp").alias("ordered_at"),
        F.make_dt_interval((F.col("o_custkey") % 28).cast("int")).alias("span"),
        "o_totalprice"))


def publishable_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-7: the JSON text a published array becomes parses back to the same array."""
    emb = table(spark, sf, "embeddings")
    kind = emb.schema["embedding"].dataType
    back = F.from_json(publishable_column(F.col("embedding"), kind), kind)
    # Two projections: Spark keeps the parse in the first (it does not inline
    # a costly expression that is used twice), so each row is parsed once.
    return (emb.select("vec_id", "label", "embedding", back.alias("parsed"))
            .select("vec_id", "label", F.array_size("parsed").alias("dims"),
                    F.col("parsed").eqNullSafe(F.col("embedding")).alias("roundtrip_exact")))


def publish_csv_backup(spark: SparkSession, sf: str) -> DataFrame:
    """CMP-5, SNK-4: older publish variant -- silver -> table, backup to diamond as CSV."""
    roots = LakeRoots.under(scratch_dir(spark, "publish_csv"))
    write_run(table(spark, sf, "orders"), roots.silver, "orders", EARLY_RUN)
    res = publish(spark, roots.silver, roots.diamond, "orders", day=EARLY_RUN[:8],
                  table=f"orders_diamond_{uuid.uuid4().hex[:12]}",
                  table_path=f"{roots.gold}/table", backup_format="csv", run_ts=LATE_RUN)
    return read_run(spark, roots.diamond, "orders", res.backup_run, "csv_quoted")


def ingest_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """CMP-1, S4: raw -> bronze trims outer blanks; blank-only text becomes NULL."""
    base = scratch_dir(spark, "ingest")
    raw = f"{base}/landing/customers_raw.csv"
    (padded_customers_view(table(spark, sf, "customer")).write
     .option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(raw))
    domain, key = ingest(spark, raw, f"{base}/bronze", EARLY_RUN)
    return read_run(spark, f"{base}/bronze", domain, key, "csv")


def landing_many_files(spark: SparkSession, sf: str) -> DataFrame:
    """RUN-4: a landing folder with two files of domain ``orders`` and one of ``customers``, spelled
    and compressed in different ways; the rows of both domains."""
    base = scratch_dir(spark, "landing")
    o = table(spark, sf, "orders")
    status_f = F.col("o_orderstatus") == "F"
    o.filter(status_f).write.option("header", True).csv(f"{base}/landing/orders_f.CSV")
    o.filter(~status_f).write.option("header", True).option("compression", "gzip").csv(f"{base}/landing/Orders_rest.csv")
    table(spark, sf, "customer").write.option("header", True).csv(f"{base}/landing/customers.csv")
    runs = ingest_landing(spark, f"{base}/landing", f"{base}/bronze", EARLY_RUN)
    loaded = [read_run(spark, f"{base}/bronze", d, runs[d], "csv").withColumn("domain", F.lit(d)) for d in sorted(runs)]
    return loaded[0].unionByName(loaded[1], allowMissingColumns=True)


def landing_only_new(spark: SparkSession, sf: str) -> DataFrame:
    """RUN-4, CMP-1, call after call: each landing call loads the files that no earlier one has loaded, and a call without
    new files makes no run. The rows of all runs, with their run."""
    base = scratch_dir(spark, "landing_new")
    orders = table(spark, sf, "orders")
    for key, status in ((FIRST_RUN, "P"), (EARLY_RUN, "F"), (LATE_RUN, "O"), (GOLD_RUN, None)):
        if status:
            (orders.filter(F.col("o_orderstatus") == status).write.option("header", True)
             .csv(f"{base}/landing/orders_{status}.csv"))
        ingest_landing(spark, f"{base}/landing", f"{base}/bronze", key, only_new=True)
    return read_layer(spark, f"{base}/bronze", "orders", "csv")


def backfill_run(spark: SparkSession, sf: str) -> DataFrame:
    """CMP-6: an older raw file that arrives after a newer run was published goes through under its own key."""
    base = scratch_dir(spark, "backfill")
    orders = table(spark, sf, "orders")
    newer = orders.withColumn("o_orderpriority", F.lit("NEWER"))
    roots = LakeRoots.under(f"{base}/lake")
    names = {}
    for key, rows in ((LATE_RUN, newer), (EARLY_RUN, orders)):  # the older one last
        rows.write.option("header", True).csv(f"{base}/landing/{key}/orders_raw.csv")
        names[key] = f"orders_diamond_{uuid.uuid4().hex[:12]}"
        run_pipeline(spark, f"{base}/landing/{key}/orders_raw.csv", roots, RefineSpec(not_blank=("o_orderstatus",)),
                     run_ts=key, table=names[key])
    gold = read_run(spark, roots.gold, "orders", EARLY_RUN)
    return spark.table(names[EARLY_RUN]).withColumn("copy", F.lit("table")).unionByName(
        gold.withColumn("copy", F.lit("gold")))


def zone_pruned_range(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-2, FLT-3 over SRC-2: ranges of parsed numbers and dates in a CSV run, read by its zone map; all rows in
    range, and whether files were left out."""
    root = scratch_dir(spark, "zones")
    by_day = table(spark, sf, "orders").repartitionByRange(16, "o_orderdate")
    write_run(by_day, root, "orders", EARLY_RUN, "csv")
    build_zones(spark, root, "orders", EARLY_RUN, "csv", ("o_totalprice",), ("o_orderdate",), date_sep="T")
    rows = read_between(spark, root, "orders", EARLY_RUN, "csv", {"o_totalprice": (100_000, 400_000)},
                        {"o_orderdate": (dt.date(1996, 1, 1), dt.date(1997, 6, 30))}, date_sep="T")
    fewer = len(rows.inputFiles()) < len(read_run(spark, root, "orders", EARLY_RUN, "csv").inputFiles())
    return rows.withColumn("fewer_files", F.lit(fewer))


def publishers_at_once(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-6, CMP-4: two publishers of one table at once, with different rows. The table's rows, whether they are those of the backup run that
    the run log names, and how many of the two created it."""
    roots = LakeRoots.under(scratch_dir(spark, "at_once"))
    write_run(table(spark, sf, "orders"), roots.silver, "orders", FIRST_RUN)
    name = f"orders_diamond_{uuid.uuid4().hex[:12]}"

    def one(run: str) -> bool:
        try:
            return publish(spark, roots.silver, roots.gold, "orders", table=name, run_ts=run,
                           transform=lambda df: df.withColumn("publisher", F.lit(run))).created
        except RuntimeError:  # refused: the other one is at work
            return False

    with ThreadPoolExecutor(2) as pool:
        created = sum(pool.map(one, (EARLY_RUN, LATE_RUN)))
    backup = published_run(spark, roots.gold, "orders", name)
    return (spark.table(name).withColumn("is_backup", F.col("publisher") == F.lit(backup)).drop("publisher")
            .withColumn("created", F.lit(created)))


def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-1..3, PRJ-1: a bronze run parted in one pass into the rows that the rules keep and those they reject, with the
    rules each breaks; the kept rows as the silver run has them (no dedup), the rejected ones with their bronze text."""
    roots = LakeRoots.under(scratch_dir(spark, "rejects"))
    rejects, spec = f"{roots.silver}_rejects", replace(APPOINTMENTS, dedup=False)
    write_run(appointments_view(table(spark, sf, "events")), roots.bronze, "pacientes", EARLY_RUN, "csv")
    refine_with_rejects(spark, roots.bronze, roots.silver, rejects, "pacientes", spec, run_ts=LATE_RUN)
    kept = read_run(spark, roots.silver, "pacientes", LATE_RUN).withColumn("fecha_turno", F.col("fecha_turno").cast("string"))
    rejected = read_run(spark, rejects, "pacientes", LATE_RUN)
    return kept.withColumn("broken", F.lit("")).unionByName(
        rejected.withColumn("broken", F.array_join(rule_names("broken", spec), ",")))


def incremental_refine(spark: SparkSession, sf: str) -> DataFrame:
    """CMP-2, AGG-1, run after run: three bronze runs that share rows, each refined into the rows that no silver run has yet.
    The rows of all silver runs."""
    roots = LakeRoots.under(scratch_dir(spark, "incremental"))
    rows = appointments_view(table(spark, sf, "events")).drop("event_id")
    month = F.substring("fecha_turno", 9, 2)
    for key, part in ((FIRST_RUN, rows.filter(month <= "20")), (EARLY_RUN, rows.filter(month > "10")), (LATE_RUN, rows)):
        write_run(part, roots.bronze, "pacientes", key, "csv")
        refine_incremental(spark, roots.bronze, roots.silver, "pacientes", run_ts=key, source_run=key)
    return read_layer(spark, roots.silver, "pacientes").drop(RUN_COLUMN)


def raw_to_gold(spark: SparkSession, sf: str) -> DataFrame:
    """CMP-6: raw CSV -> bronze -> silver -> diamond -> table + gold; the gold run."""
    base = scratch_dir(spark, "pipeline")
    raw = f"{base}/landing/pacientes_export.csv"
    appointments_view(table(spark, sf, "events")).drop("event_id").write.option("header", True).csv(raw)
    roots = LakeRoots.under(f"{base}/lake")
    res = run_pipeline(spark, raw, roots, APPOINTMENTS, run_ts=GOLD_RUN,
                       table=f"pacientes_diamond_{uuid.uuid4().hex[:12]}",
                       table_path=f"{base}/tables/pacientes_diamond")
    return read_run(spark, roots.gold, "pacientes", res.backup_run)


QUERIES = {
    "refine_appointments": refine_appointments,
    "not_blank": not_blank_names,
    "int_range": int_range,
    "date_prefix": date_prefix_retype,
    "distinct_after_retype": distinct_after_retype,
    "csv_roundtrip": csv_roundtrip,
    "csv_free_text": csv_free_text,
    "latest_run_of_day": latest_run_of_day,
    "latest_run_any_day": latest_run_any_day,
    "missing_day": missing_day,
    "promote_run": promote_run,
    "run_of_file": run_of_file,
    "adopt_old_layout": adopt_old_layout,
    "adopt_old_backup": adopt_old_backup,
    "single_file_run": single_file_run,
    "bounded_files_run": bounded_files_run,
    "publish_if_absent": publish_if_absent,
    "publishable_types": publishable_types,
    "publishable_roundtrip": publishable_roundtrip,
    "publish_csv_backup": publish_csv_backup,
    "ingest_bronze": ingest_bronze,
    "landing_many_files": landing_many_files,
    "landing_only_new": landing_only_new,
    "backfill_run": backfill_run,
    "rejected_rows": rejected_rows,
    "zone_pruned_range": zone_pruned_range,
    "publishers_at_once": publishers_at_once,
    "incremental_refine": incremental_refine,
    "raw_to_gold": raw_to_gold,
}

# ---------------------------------------------------------------------------
# DuckDB oracles (same derived inputs, written independently in SQL).

_APPOINTMENTS_RAW = """
  SELECT event_id,
    CASE WHEN user_id % 17 = 0 THEN '' ELSE 'user_' || CAST(user_id AS VARCHAR) END AS nombre,
    CASE WHEN event_id % 13 = 0 THEN 'n/a' ELSE CAST(user_id AS VARCHAR) END AS edad,
    CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS obra_social,
    CASE WHEN event_id % 11 = 0 THEN 'sin fecha' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS fecha_turno
  FROM events"""

_REFINED_APPOINTMENTS = f"""
WITH raw AS ({_APPOINTMENTS_RAW})
SELECT DISTINCT nombre, edad, obra_social,
  CAST(try_strptime(split_part(fecha_turno, ' ', 1), '%Y-%m-%d') AS DATE) AS fecha_turno
FROM raw
WHERE nombre IS NOT NULL AND nombre <> ''
  AND trunc(try_cast(edad AS DOUBLE)) > 0 AND trunc(try_cast(edad AS DOUBLE)) < 120
  AND obra_social IS NOT NULL AND obra_social <> ''
  AND try_strptime(split_part(fecha_turno, ' ', 1), '%Y-%m-%d') IS NOT NULL"""

_HOURS = """
WITH r AS (SELECT *, strftime(ts, '%Y%m%d%H') || '00' AS run_ts FROM events)"""

_ORDERS_BY_RUN = f"""
SELECT orders.*, CASE o_orderstatus WHEN 'P' THEN '{FIRST_RUN}' WHEN 'F' THEN '{EARLY_RUN}' ELSE '{LATE_RUN}' END AS run_ts
FROM orders"""

_ORDERS_TEXT = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
  CAST(o_totalprice AS VARCHAR) AS o_totalprice, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%g') AS o_orderdate,
  o_orderpriority
FROM orders"""

ORACLE_SQL = {
    "refine_appointments": _REFINED_APPOINTMENTS,
    "not_blank": f"""
WITH raw AS ({_APPOINTMENTS_RAW})
SELECT event_id, nombre FROM raw WHERE nombre IS NOT NULL AND nombre <> ''""",
    "int_range": """
WITH v AS (
  SELECT p_partkey,
    CASE WHEN p_partkey % 7 = 0 THEN 'abc'
         WHEN p_partkey % 11 = 0 THEN CAST(p_size * 3 AS VARCHAR) || '.5'
         ELSE CAST(p_size * 3 AS VARCHAR) END AS edad
  FROM part)
SELECT p_partkey, edad FROM v
WHERE trunc(try_cast(edad AS DOUBLE)) > 0 AND trunc(try_cast(edad AS DOUBLE)) < 120""",
    "date_prefix": f"""
WITH raw AS ({_APPOINTMENTS_RAW})
SELECT event_id, CAST(try_strptime(split_part(fecha_turno, ' ', 1), '%Y-%m-%d') AS DATE) AS fecha_turno
FROM raw WHERE try_strptime(split_part(fecha_turno, ' ', 1), '%Y-%m-%d') IS NOT NULL""",
    "distinct_after_retype": """
SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS fecha FROM events""",
    "csv_roundtrip": _ORDERS_TEXT,
    "latest_run_of_day": _HOURS + f"""
SELECT * FROM r WHERE run_ts = (SELECT max(run_ts) FROM r WHERE run_ts LIKE '{DAY}%')""",
    "latest_run_any_day": _HOURS + """
SELECT * FROM r WHERE run_ts = (SELECT max(run_ts) FROM r)""",
    "promote_run": _ORDERS_BY_RUN,
    "run_of_file": _ORDERS_BY_RUN,
    "adopt_old_layout": _ORDERS_BY_RUN,
    "publish_if_absent": "SELECT * FROM orders",
    "publishable_roundtrip": """
SELECT vec_id, label, CAST(len(embedding) AS INTEGER) AS dims, true AS roundtrip_exact FROM embeddings""",
    "publish_csv_backup": _ORDERS_TEXT,
    "ingest_bronze": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_name END AS c_name,
  CAST(c_nationkey AS VARCHAR) AS c_nationkey, CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer""",
    "landing_many_files": f"""
WITH o AS ({_ORDERS_TEXT})
SELECT *, NULL::VARCHAR AS c_custkey, NULL::VARCHAR AS c_name, NULL::VARCHAR AS c_nationkey, NULL::VARCHAR AS c_acctbal,
  NULL::VARCHAR AS c_mktsegment, 'orders' AS domain FROM o
UNION ALL BY NAME
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
  CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment, 'customers' AS domain FROM customer""",
    "landing_only_new": f"""
SELECT *, CASE o_orderstatus WHEN 'P' THEN '{FIRST_RUN}' WHEN 'F' THEN '{EARLY_RUN}' ELSE '{LATE_RUN}' END AS run_ts
FROM ({_ORDERS_TEXT})""",
    "raw_to_gold": _REFINED_APPOINTMENTS,
    "zone_pruned_range": f"""
SELECT *, true AS fewer_files FROM ({_ORDERS_TEXT})
WHERE trunc(CAST(o_totalprice AS DOUBLE)) > 100000 AND trunc(CAST(o_totalprice AS DOUBLE)) < 400000
  AND CAST(split_part(o_orderdate, 'T', 1) AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'""",
    "publishers_at_once": "SELECT *, true AS is_backup, 1 AS created FROM orders",
    "rejected_rows": f"""
WITH raw AS ({_APPOINTMENTS_RAW}),
judged AS (
  SELECT *, concat_ws(',',
    CASE WHEN nombre IS NULL OR nombre = '' THEN 'not_blank:nombre' END,
    CASE WHEN obra_social IS NULL OR obra_social = '' THEN 'not_blank:obra_social' END,
    CASE WHEN coalesce(trunc(try_cast(edad AS DOUBLE)) > 0 AND trunc(try_cast(edad AS DOUBLE)) < 120, false) THEN NULL
         ELSE 'int_range:edad:0:120' END,
    CASE WHEN try_strptime(split_part(fecha_turno, ' ', 1), '%Y-%m-%d') IS NULL THEN 'date:fecha_turno' END) AS broken
  FROM raw)
SELECT CAST(event_id AS VARCHAR) AS event_id, nullif(nombre, '') AS nombre, edad, obra_social,  -- bronze has NULL for blank text
  CASE WHEN broken = '' THEN split_part(fecha_turno, ' ', 1) ELSE fecha_turno END AS fecha_turno, broken
FROM judged""",
    "incremental_refine": _REFINED_APPOINTMENTS,
    "csv_free_text": """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars,
  'say "a\\b",' || chr(10) || ' ,''' || source || '"\\' AS quoted
FROM documents""",
    "adopt_old_backup": """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang, source, CAST(n_chars AS VARCHAR) AS n_chars FROM documents""",
    "missing_day": _HOURS + f"""
SELECT *, true AS missing_raises FROM r WHERE run_ts = (SELECT max(run_ts) FROM r WHERE run_ts LIKE '{DAY}%')""",
    "single_file_run": """
SELECT CAST(1 AS BIGINT) AS files, count(*) AS n_rows, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders""",
    "bounded_files_run": """
SELECT count(*) AS n_rows, CAST(sum(l_orderkey) AS BIGINT) AS key_sum, sum(l_quantity) AS quantity_sum,
  true AS as_reported, true AS fewer_files, true AS in_band FROM lineitem""",
    "backfill_run": f"""
WITH r AS ({_ORDERS_TEXT})
SELECT *, 'table' AS copy FROM r UNION ALL SELECT *, 'gold' FROM r""",
    "publishable_types": """
SELECT o_orderkey, '[' || o_orderkey || ',' || o_custkey || ']' AS keys,
  '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS words,
  '{"cust":' || o_custkey || ',"priority":"' || o_orderpriority || '"}' AS nested,
  '{"' || o_orderstatus || '":' || o_custkey || '}' AS by_status,
  o_orderdate AS ordered_at,
  'INTERVAL ''' || (o_custkey % 28) || ' 00:00:00'' DAY TO SECOND' AS span,
  o_totalprice
FROM orders""",
}
