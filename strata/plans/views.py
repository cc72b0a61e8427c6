"""Derived inputs over the benchmark tables.

The benchmark tables carry no appointment records and almost no dirt, so
the inputs the rules need are derived from them deterministically (the
same expressions appear in the DuckDB oracle SQL). Every view reads its
whole table; the modulo tests only decide which rows get which kind of dirt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def table(spark: SparkSession, sf_dir, name: str) -> DataFrame:
    """One benchmark table (``<sf_dir>/<name>.parquet``); ``sf_dir`` may be a str or a Path."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def appointments_view(events: DataFrame) -> DataFrame:
    """Appointment-shaped text rows, one per event, with blank names, bad ages,
    missing insurers and unparsable dates mixed in; keeps ``event_id``."""
    uid = F.col("user_id")
    eid = F.col("event_id")
    return events.select(
        eid.alias("event_id"),
        F.when(uid % 17 == 0, F.lit("")).otherwise(F.concat(F.lit("user_"), uid.cast("string"))).alias("nombre"),
        F.when(eid % 13 == 0, F.lit("n/a")).otherwise(uid.cast("string")).alias("edad"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
        .otherwise(F.col("event_type")).alias("obra_social"),
        F.when(eid % 11 == 0, F.lit("sin fecha"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("fecha_turno"),
    )


def part_ages_view(part: DataFrame) -> DataFrame:
    """``p_partkey`` with a text age: words, fractions (``'120.5'``) and integers."""
    key = F.col("p_partkey")
    age = (F.col("p_size") * 3).cast("string")
    return part.select(
        key.alias("p_partkey"),
        F.when(key % 7 == 0, F.lit("abc"))
        .when(key % 11 == 0, F.concat(age, F.lit(".5")))
        .otherwise(age).alias("edad"),
    )


def hourly_runs_view(events: DataFrame) -> DataFrame:
    """Events tagged with the run key ``YYYYMMDDHH00`` of their hour."""
    return events.withColumn("run_ts", F.concat(F.date_format("ts", "yyyyMMddHH"), F.lit("00")))


def padded_customers_view(customer: DataFrame) -> DataFrame:
    """Customers as raw text with outer blanks on some names, blank-only on others."""
    key = F.col("c_custkey")
    padded = (F.when(key % 10 == 0, F.lit("   "))
              .when(key % 3 == 0, F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
              .otherwise(F.col("c_name")))
    return customer.withColumn("c_name", padded)
