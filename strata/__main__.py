"""Command line: one subcommand per pipeline step, for schedulers and spark-submit.

    python -m strata ingest  --raw s3a://landing/pacientes_x.csv --bronze s3a://lake-bronze
    python -m strata refine  --bronze ... --silver ... --domain pacientes [--day 20250515]
    python -m strata promote --silver ... --diamond ... --domain pacientes
    python -m strata publish --diamond ... --gold ... --domain pacientes [--jdbc-url ...]
    python -m strata run     --raw ... --lake s3a://lake   (all four steps)

The Spark session comes from the environment (``spark-submit`` settings,
``spark-defaults.conf``); object-store credentials belong there too.
Each command prints one JSON line describing what it wrote.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import asdict

from pyspark.sql import SparkSession

from strata.operators.refine import APPOINTMENTS, spec_from_dict
from strata.plans.pipeline import (
    LakeRoots, ingest, ingest_landing, promote, publish, refine_latest, run_pipeline,
)
from strata.sources.tables import JdbcTarget


def _jdbc(args) -> JdbcTarget | None:
    if not args.jdbc_url:
        return None
    props = {}
    if args.jdbc_properties_file:
        with open(args.jdbc_properties_file) as fh:
            for line in fh:
                line = line.strip()
                if line and not line.startswith("#") and "=" in line:
                    k, v = line.split("=", 1)
                    props[k.strip()] = v.strip()
    for kv in args.jdbc_property or []:
        k, v = kv.split("=", 1)
        props[k] = v
    return JdbcTarget(args.jdbc_url, props, num_partitions=args.jdbc_connections)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m strata", description=__doc__.split("\n\n")[0])
    sub = p.add_subparsers(dest="step", required=True)

    def common(sp, *roots):
        for r in roots:
            sp.add_argument(f"--{r}", required=True, help=f"{r} layer root URI")
        sp.add_argument("--run-ts", help="run key YYYYMMDDHHMM (default: now)")
        sp.add_argument("--num-files", type=int, help="fixed file count per written run")

    def publishing(sp):
        sp.add_argument("--table", help="table name (default <domain>_diamond)")
        sp.add_argument("--table-path", help="location of an external catalog table")
        sp.add_argument("--jdbc-url", help="publish over JDBC instead of the catalog")
        sp.add_argument("--jdbc-property", action="append", help="key=value (user, driver, ...)")
        sp.add_argument("--jdbc-properties-file", help="file of key=value lines (e.g. password)")
        sp.add_argument("--jdbc-connections", type=int, default=32, help="parallel connections")

    sp = sub.add_parser("ingest", help="raw CSV file or landing folder -> bronze run(s)")
    common(sp, "bronze")
    src = sp.add_mutually_exclusive_group(required=True)
    src.add_argument("--raw", help="one raw CSV (file or folder); domain from its name")
    src.add_argument("--landing", help="folder of raw CSVs; one run per domain")
    sp.add_argument("--domain", help="override the domain taken from --raw")
    sp.add_argument("--preserve-whitespace", action="store_true")

    sp = sub.add_parser("refine", help="latest bronze run of a day -> silver run")
    common(sp, "bronze", "silver")
    sp.add_argument("--domain", required=True)
    sp.add_argument("--spec", help="JSON file with a refine spec (default: the appointments rules)")
    sp.add_argument("--day", help="YYYYMMDD (default: the day of --run-ts / today)")

    sp = sub.add_parser("promote", help="latest silver run (any day) -> diamond")
    common(sp, "silver", "diamond")
    sp.add_argument("--domain", required=True)
    sp.add_argument("--day", help="restrict to runs of this day")
    sp.add_argument("--format", default="parquet", choices=["parquet", "csv"], help="layer format")

    sp = sub.add_parser("publish", help="latest diamond run of a day -> table + gold backup")
    common(sp, "diamond", "gold")
    sp.add_argument("--domain", required=True)
    sp.add_argument("--day", help="YYYYMMDD (default: the day of --run-ts / today)")
    sp.add_argument("--source-format", default="parquet", choices=["parquet", "csv"])
    sp.add_argument("--backup-format", default="parquet", choices=["parquet", "csv"])
    publishing(sp)

    sp = sub.add_parser("run", help="raw CSV -> bronze -> silver -> diamond -> table + gold")
    sp.add_argument("--raw", required=True)
    sp.add_argument("--lake", required=True, help="base URI; layers go to <lake>/{bronze,silver,diamond,gold}")
    sp.add_argument("--run-ts")
    sp.add_argument("--num-files", type=int)
    publishing(sp)
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    from strata.operators.runs import run_stamp

    args = _parser().parse_args(argv)
    import logging

    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    spark = spark or (SparkSession.builder.appName(f"strata-{args.step}")
                      .config("spark.ui.showConsoleProgress", "false")  # keep stderr to log lines
                      .getOrCreate())
    run_ts = args.run_ts or run_stamp()
    day = getattr(args, "day", None)
    if args.step == "ingest":
        if args.landing:
            out = {"runs": ingest_landing(spark, args.landing, args.bronze, run_ts, args.num_files,
                                          args.preserve_whitespace)}
        else:
            domain, key = ingest(spark, args.raw, args.bronze, run_ts, args.domain, args.num_files,
                                 args.preserve_whitespace)
            out = {"runs": {domain: key}}
    elif args.step == "refine":
        spec = APPOINTMENTS
        if args.spec:
            with open(args.spec) as fh:
                spec = spec_from_dict(json.load(fh))
        out = {"run_ts": refine_latest(spark, args.bronze, args.silver, args.domain, spec,
                                       day or run_ts[:8], run_ts, args.num_files)}
    elif args.step == "promote":
        out = {"run_ts": promote(spark, args.silver, args.diamond, args.domain, day, args.format,
                                 args.num_files)}
    elif args.step == "publish":
        out = asdict(publish(spark, args.diamond, args.gold, args.domain, day or run_ts[:8],
                             args.table, args.table_path, _jdbc(args), args.source_format,
                             args.backup_format, run_ts, num_files=args.num_files))
    else:
        out = asdict(run_pipeline(spark, args.raw, LakeRoots.under(args.lake), APPOINTMENTS, run_ts,
                                  args.table, args.table_path, _jdbc(args), num_files=args.num_files))
    print(json.dumps({"step": args.step, **out}))
    return out


def _cli() -> None:
    main(sys.argv[1:])


if __name__ == "__main__":
    _cli()
