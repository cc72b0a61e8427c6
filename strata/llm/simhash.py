"""SimHash near-duplicates through per-segment bit counts.

A fingerprint is mapped to the bit counts of its 16 four-bit segments. Each
differing bit changes one count by one, so the Manhattan distance of two
count vectors is a lower bound of the Hamming distance. Fingerprints at
Hamming distance 2 or less therefore have a vector in common within
Manhattan distance 1 of both: every fingerprint visits the 33 grid cells of
its radius-1 neighbourhood, and only fingerprints that meet another one in
a cell are candidates.

Candidates are verified exactly without listing pairs. Two different
fingerprints differ in at most two bits if and only if some 64-bit value lies within
one bit of both, and the count vector of that value is one of the cells in
which they meet. So each candidate names, for each shared cell, the values
of that cell within one bit of itself (four at most), and fingerprints that
name the same value are linked. At most 65 fingerprints can name one value,
whatever the size of a group of near copies, so no group is ever large.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import each_utf8, fresh, materialized
from strata.llm.components import components

SEED = 42
SEGMENTS = 16
BITS = 4
HASH_BLOCK = 1 << 16  # shingle hashes that are expanded to bits at once


def _fingerprint(text: bytes, shingle: int) -> int:
    """The fingerprint of one text as a signed 64-bit number."""
    words = text.lower().split()  # on bytes: A-Z only, and the six ASCII blanks
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.array([xxhash.xxh64_intdigest(g, SEED) for g in grams], dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), HASH_BLOCK):
        block = hashes[start:start + HASH_BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes)).view(np.int64)[0])


def fingerprint(text: str | Column, shingle: int = 3) -> Column:
    """The SimHash of the lower-cased word shingles of a whole text, as a signed 64-bit number.

    Words are what lies between ASCII blanks; a text of fewer words than a
    shingle is one shingle, and null, empty or blank texts have fingerprint 0.
    Python holds one batch of texts and the hashes of one text at a time.
    """
    def run(texts: pa.Array) -> pa.Array:
        return pa.array([_fingerprint(t or b"", shingle) for t in each_utf8(texts)], pa.int64())

    return F.arrow_udf(run, T.LongType())(text)


def _counts(fp: Column) -> Column:
    """The bit counts of the 16 segments, one hexadecimal digit each, plus one each."""
    def of_half(half: Column) -> Column:  # 32 bits at a time: the sums stay clear of the sign bit
        twos = half.bitwiseAND(F.lit(0x55555555)) + F.shiftright(half, 1).bitwiseAND(F.lit(0x55555555))
        return twos.bitwiseAND(F.lit(0x33333333)) + F.shiftright(twos, 2).bitwiseAND(F.lit(0x33333333))

    high, low = F.shiftrightunsigned(fp, 32), fp.bitwiseAND(F.lit(0xFFFFFFFF))
    return F.shiftleft(of_half(high), 32) + of_half(low) + F.lit(0x1111111111111111)


def _cells(fp: Column) -> Column:
    """The 33 cells within Manhattan distance 1 of a fingerprint's count vector."""
    base = _counts(fp)
    steps = [F.lit(1 << (BITS * s)) for s in range(SEGMENTS)]
    return F.array(base, *[base + s for s in steps], *[base - s for s in steps])


def _values_in(cell: Column, fp: Column) -> Column:
    """The values of a cell within one bit of a fingerprint that visits it: four at most."""
    def flip(bit: Column) -> Column:
        return fp.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))

    near = F.concat(F.array(fp), F.transform(F.sequence(F.lit(0), F.lit(63)), flip))
    return F.filter(near, lambda value: _counts(value) == cell)


def links(fps: DataFrame) -> DataFrame:
    """(u, v) edges that connect exactly the distinct fingerprints ``fp`` at two or fewer
    differing bits: each pair at that distance is joined by a path of edges, and every
    edge joins such a pair. Linear in the number of fingerprints: no pairs of a group are listed."""
    visits = fps.select("fp", F.explode(_cells(F.col("fp"))).alias("cell"))
    shared = visits.groupBy("cell").count().filter("count > 1").select("cell")
    met = materialized(visits.join(shared, "cell", "left_semi").select("fp", "cell"), "cells")
    inside = _values_in(F.col("cell"), F.col("fp"))
    named = (met.select("fp", F.explode(inside).alias("value"))
             .groupBy("value").agg(F.sort_array(F.collect_set("fp")).alias("fps"))  # 65 at most
             .filter(F.size("fps") > 1))
    rest = named.select(F.col("fps")[0].alias("u"), F.explode(F.expr("slice(fps, 2, size(fps) - 1)")).alias("v"))
    return rest.distinct()


def _components(fps: DataFrame) -> DataFrame:
    """(fp, label) of distinct fingerprints: the smallest fingerprint reachable."""
    labels = components(links(fps))
    return fps.join(labels, fps.fp == labels.node, "left").select("fp", F.coalesce("label", "fp").alias("label"))


def _first_of_group(rows: DataFrame) -> DataFrame:
    """(fp, first) for every fingerprint of ``rows`` (fp, first): the smallest ``first`` of its component."""
    distinct = materialized(rows.groupBy("fp").agg(F.min("first").alias("first")), "fingerprints")
    labelled = materialized(distinct.join(_components(distinct.select("fp")), "fp"), "members")
    smallest = materialized(labelled.groupBy("label").agg(F.min("first").alias("first")), "components")
    return materialized(labelled.drop("first").join(smallest, "label").select("fp", "first"), "members")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(id, fp, component_id) of every row of ``docs``.

    ``component_id`` is the smallest id among the documents that can be
    reached over links of two or fewer differing bits, the row's own
    included; it is null only where all of them have a null id. Rows with
    equal ids stay separate rows. An empty table gives an empty result; other
    columns of ``docs`` are not read.
    """
    rows = materialized(docs.select(F.col(id_col).alias("id"), fingerprint(text_col, shingle).alias("fp")), "simhash")
    first = _first_of_group(rows.select("fp", F.col("id").alias("first")))
    return rows.join(first.withColumnRenamed("first", "component_id"), "fp").select("id", "fp", "component_id")


def row_keys(docs: DataFrame, id_col: str, text_col: str) -> tuple[dict[str, Column], Column]:
    """128 bits that stand for a row's id and text, as columns by fresh names, and a key that
    orders rows by id (nulls last) and carries those bits as ``row_a`` and ``row_b``."""
    # texts need no second copy on disk
    halves = {fresh("row_a", docs.columns): F.xxhash64(id_col, text_col),
              fresh("row_b", docs.columns): F.xxhash64(F.lit(7), id_col, text_col)}
    return halves, F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"),
                            *[half.alias(name) for name, half in zip(("row_a", "row_b"), halves.values())])


def rows_of(docs: DataFrame, halves: dict[str, Column], winners: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``halves`` are in ``winners``, one of those that have the same."""
    place = fresh("place", docs.columns)
    kept = docs.withColumns(halves).join(winners, list(halves), "left_semi")
    again = F.row_number().over(Window.partitionBy(*halves).orderBy(*halves))
    return kept.withColumn(place, again).filter(F.col(place) == 1).select(*docs.columns)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """The rows of ``docs``, all columns kept, of which one stays for each group of near-duplicates.

    The row with the smallest id stays (null ids last); of rows that repeat
    that id, any one of them.
    """
    halves, key = row_keys(docs, id_col, text_col)
    rows = materialized(docs.select(fingerprint(text_col, shingle).alias("fp"), key.alias("first")), "simhash_rows")
    firsts = _first_of_group(rows).select(F.col("first.row_a"), F.col("first.row_b")).distinct()
    return rows_of(docs, halves, firsts.toDF(*halves))
