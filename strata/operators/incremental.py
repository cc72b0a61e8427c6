"""Refining run after run: a new silver run gets only the rows that no earlier one has.

Each silver run keeps a state beside its data: a 64-bit digest of every row,
and a Bloom filter over the digests, as bitmaps of 32,768 bits. A new run's
rows are tested against the filters first; digests that a filter admits are
looked up among that run's digests; and only runs in which one is found are
read and anti-joined, on all columns, so that equal digests decide nothing by
themselves. Runs without a hit are not opened.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS_PER_ROW = 10  # with PROBES bits a row, about 1.2 % of unknown digests are admitted by a filter
PROBES = 4
SMALLEST = 15      # log2 of the bits of the smallest filter


def row_digest(columns: list[str]) -> Column:
    """64 bits of a row; nulls count, and tell columns apart."""
    return F.xxhash64(*[c for name in columns for c in (F.col(f"`{name}`").isNull(), F.col(f"`{name}`"))])


def filter_bits(rows: int) -> int:
    """log2 of the size in bits of the filter of a run of ``rows`` rows."""
    return max(SMALLEST, math.ceil(math.log2(max(rows, 1) * BITS_PER_ROW)))


def _probes(digest: Column, size: Column | int) -> Column:
    """The places of a digest in a filter of 2 ** ``size`` bits, counted from 1."""
    bits = F.lit(size) if isinstance(size, int) else size
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
    return F.array(*[F.xxhash64(digest, F.lit(j)).bitwiseAND(mask) + 1 for j in range(PROBES)])


def bloom(digests: DataFrame, size: int) -> DataFrame:
    """(size, bucket, bits): the filter of a run with the digests ``digest``."""
    place = digests.select(F.explode(_probes(F.col("digest"), size)).alias("place"))
    return place.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).select(F.lit(size).alias("size"), "bucket", "bits")


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (position % 8).cast("int"))) != 0


def admitted(digests: DataFrame, blooms: DataFrame) -> DataFrame:
    """(run_ts, digest): the digests that each run's filter admits. ``blooms`` are (run_ts, size, bucket, bits).

    Filters come in sizes of powers of two, so a digest's places are computed once a size, not once a run.
    """
    sizes = blooms.agg(F.collect_set("size").alias("sizes")).first().sizes  # powers of two: a few dozen at most
    asked = digests.select("digest").distinct().withColumn("size", F.explode(F.array(*map(F.lit, sorted(sizes)))))
    asked = asked.select("digest", "size", F.posexplode(_probes(F.col("digest"), F.col("size"))).alias("probe", "place"))
    asked = asked.select("digest", "size", "probe", F.bitmap_bucket_number("place").alias("bucket"),
                         F.bitmap_bit_position("place").alias("position"))
    found = asked.join(blooms, ["size", "bucket"]).filter(_is_set(F.col("bits"), F.col("position")))
    return found.groupBy("run_ts", "digest").agg(F.count("probe").alias("n")).filter(F.col("n") == PROBES).select("run_ts", "digest")


def without_known(new: DataFrame, known: DataFrame) -> DataFrame:
    """The rows of ``new`` that are not in ``known``, on all columns of ``new``, nulls equal."""
    names = {c: f"known_{i}" for i, c in enumerate(new.columns)}
    other = known.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    same = F.lit(True)
    for c, n in names.items():
        same = same & new[f"`{c}`"].eqNullSafe(other[n])
    return new.join(other, same, "left_anti")
