"""Balanced shards by longest-processing-time scheduling.

Rows with equal texts form a group that stays together. Groups are scheduled
by size, largest first, each to the least-loaded shard (a heap). So that the
schedule stays bounded however many groups there are, only groups of at
least 1/``BUNDLES`` of all bytes are scheduled one by one (at most
``BUNDLES`` groups can be that large); the smaller ones are first gathered by hash into
``BUNDLES`` bundles, which are scheduled like groups.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import fresh, materialized

BUNDLES = 4096
SLOT_BUCKETS = 1024  # parts of a shard that are numbered at once


def schedule(sizes: list[tuple[tuple, int]], shards: int) -> dict[tuple, int]:
    """Item -> shard: items by size (ties: by key), largest first, each to the least-loaded shard
    (ties: the smaller number)."""
    loads = [(0, shard) for shard in range(shards)]
    placed = {}
    for key, size in sorted(sizes, key=lambda item: (-item[1], item[0])):
        load, shard = heapq.heappop(loads)
        placed[key] = shard
        heapq.heappush(loads, (load + size, shard))
    return placed


def assign(rows: DataFrame, size_col: str, group_col: str, shards: int) -> DataFrame:
    """``rows`` with a column ``shard``; rows with equal ``group_col`` (a long) share a shard.

    Shuffles one row per group and task. The driver gets the size of each
    scheduled item, 2 x ``BUNDLES`` at most, and the tasks get their shards back.
    """
    spark = rows.sparkSession
    bundle = F.pmod(F.xxhash64(group_col), F.lit(BUNDLES))
    groups = materialized(rows.groupBy(group_col).agg(F.sum(size_col).alias("_size")), "groups")
    total = groups.agg(F.sum("_size")).first()[0] or 0
    large = F.col("_size") * BUNDLES >= total
    item = F.struct(large.alias("large"), F.when(large, F.col(group_col)).otherwise(bundle).alias("key"))
    sizes = groups.groupBy(item.alias("item")).agg(F.sum("_size").alias("size")).collect()
    placed = schedule([((r.item.large, r.item.key), r["size"]) for r in sizes], shards)
    key, own, common = fresh("item_key", rows.columns), fresh("own_shard", rows.columns), fresh("bundle_shard", rows.columns)
    one_by_one = spark.createDataFrame([(k, s) for (big, k), s in placed.items() if big], f"{group_col} long, {own} int")
    bundled = spark.createDataFrame([(k, s) for (big, k), s in placed.items() if not big], f"{key} long, {common} int")
    return (rows.withColumn(key, bundle)
            .join(F.broadcast(one_by_one), group_col, "left")   # BUNDLES rows at most
            .join(F.broadcast(bundled), key, "left")            # BUNDLES rows at most
            .withColumn("shard", F.coalesce(own, common)).drop(key, own, common))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (with ``shard``) with a column ``slot``, gapless from 0 in each shard.

    A shard is numbered in ``SLOT_BUCKETS`` hash parts at once: the parts' row
    counts give where each begins.
    """
    part, begins = fresh("slot_part", rows.columns), fresh("slot_begins", rows.columns)
    parted = rows.withColumn(part, F.pmod(F.xxhash64(*order), F.lit(SLOT_BUCKETS)).cast("int"))
    counts = parted.groupBy("shard", part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(begins))
    at = F.row_number().over(Window.partitionBy("shard", part).orderBy(*order)) - 1
    placed = parted.withColumn("slot", at.cast("long"))
    # shards x SLOT_BUCKETS rows at most
    return (placed.join(F.broadcast(offsets), ["shard", part])
            .withColumn("slot", F.col("slot") + F.col(begins)).drop(part, begins))


def shards(docs: DataFrame, count: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row of ``docs``.

    ``size`` is the text's UTF-8 bytes plus 8. Null texts have no bytes and
    the checksum of the empty text, and form a group of their own with empty
    texts. Repeated rows get a slot each. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialized(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("text_hash")), "sizes")
    placed = assign(rows, "size", "text_hash", count)
    return numbered(placed, ["id", "text_hash"]).select("id", "size", "text_crc32", "shard", "slot")
