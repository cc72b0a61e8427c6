"""Line deduplication over levelled sorted runs of line hashes.

``LineRuns`` keeps what is known about lines as sorted runs of
(hash, documents that hold it, largest document id), one run per batch.
When a level has ``FANOUT`` runs they are compacted into one run of the next
level, so that any number of batches leaves a logarithmic number of runs and
each entry is rewritten once per level. Runs are merged by counting: a line
that is known already changes its count and its largest id as well. The
anti-join of a batch against the runs, ``LineRuns.unseen``, is for callers;
``dedup_lines`` does not need it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import bound, materialized, text_digest
from strata.session import scratch_dir

FANOUT = 4
BATCHES = 8
MIN_LENGTH = 20
MIN_DOCUMENTS = 3

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HASH = ["a", "b"]


def split_lines(text: str | Column) -> Column:
    """The lines of a text; null and empty texts have one empty line."""
    text = F.col(text) if isinstance(text, str) else text
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line without ASCII blanks at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(_BLANKS)), _UPPER, _LOWER)


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_length: int = MIN_LENGTH) -> DataFrame:
    """(id, text_hash, at, a, b): place and 128-bit hash of each line whose key has ``min_length`` code points."""
    lines = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"),
                        F.posexplode(split_lines(text_col)).alias("at", "line"))
    keyed = lines.select("id", "text_hash", "at", line_key(F.col("line")).alias("key"))
    return keyed.filter(F.length("key") >= min_length).select(
        "id", "text_hash", "at", text_digest("key").alias("d")).select("id", "text_hash", "at", "d.a", "d.b")


class LineRuns:
    """Levelled runs (a, b, n_docs, top_id) under one folder of the shared storage.

    Batches must hold different documents: a document's lines all come in one batch.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or scratch_dir(spark, "line_runs")
        self.levels: list[list[str]] = []
        self.written = 0

    def _write(self, entries: DataFrame, level: int) -> None:
        path = f"{self.root}/level={level}/run={self.written}"
        self.written += 1
        entries.sortWithinPartitions(*_HASH).write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def _merged(self, paths: list[str]) -> DataFrame:
        runs = self.spark.read.parquet(*paths)
        return runs.groupBy(*_HASH).agg(F.sum("n_docs").alias("n_docs"), F.max("top_id").alias("top_id"))

    def add(self, lines: DataFrame) -> None:
        """Add a batch's lines (id, a, b) as a run, then compact every level that is full."""
        per_document = lines.select("id", *_HASH).distinct()  # null ids: one document
        self._write(per_document.groupBy(*_HASH).agg(
            F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("top_id")), 0)
        level = 0
        while len(self.levels[level]) >= FANOUT:
            full, self.levels[level] = self.levels[level], []
            self._write(self._merged(full), level + 1)
            level += 1

    def entries(self) -> DataFrame:
        """One row (a, b, n_docs, top_id) for each line hash in the runs."""
        return self._merged(reduce(list.__add__, self.levels, []))

    def unseen(self, lines: DataFrame) -> DataFrame:
        """The rows of ``lines`` whose hash is in no run: the batch anti-joined with each run in turn."""
        for path in reduce(list.__add__, self.levels, []):
            lines = lines.join(self.spark.read.parquet(path).select(*_HASH), _HASH, "left_anti")
        return lines


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_documents: int = MIN_DOCUMENTS, batches: int = BATCHES) -> DataFrame:
    """(id, n_lines, n_dropped, kept) of every row of ``docs``; ``kept`` is the text that remains.

    Lines whose key (see ``line_key``) has ``min_length`` code points and
    occurs in ``min_documents`` documents are dropped from all documents but
    the one with the largest id, where all of them stay. Rows with equal ids
    are one document for counting, and each is cleaned; null ids are one
    document that is smaller than all others. Null and empty texts have one
    empty line. Documents pass through the runs in ``batches`` batches, dealt
    by a hash of the id; the result does not depend on their number.
    """
    spark = docs.sparkSession
    batch = F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int")
    path = scratch_dir(spark, "line_batches")
    line_hashes(docs, id_col, text_col, min_length).withColumn("batch", batch).write.partitionBy("batch").parquet(path)
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, text_hash long, at int, a long, b long, batch int"
    lines = spark.read.schema(schema).parquet(path)
    runs = LineRuns(spark)
    for i in range(batches):
        runs.add(lines.filter(F.col("batch") == i))
    repeated = materialized(runs.entries().filter(F.col("n_docs") >= min_documents), "repeated_lines")
    known = repeated.select(F.col("a").alias("ra"), F.col("b").alias("rb"), "top_id")
    elsewhere = F.col("id").isNull() | (F.col("id") < F.col("top_id"))
    gone = lines.join(known, (F.col("a") == F.col("ra")) & (F.col("b") == F.col("rb")) & elsewhere, "left_semi")
    places = gone.select("id", "text_hash", "at").groupBy("id", "text_hash").agg(F.collect_set("at").alias("gone"))
    places = places.select(F.col("id").alias("gone_id"), F.col("text_hash").alias("gone_hash"), "gone")

    text = F.coalesce(F.col("text"), F.lit(""))
    all_lines = split_lines("text")
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    joined = rows.join(places, F.col("id").eqNullSafe(F.col("gone_id")) & (F.col("text_hash") == F.col("gone_hash")), "left")
    def without(every: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), F.col("gone"))
        return F.array_join(F.transform(left, lambda i: F.get(every, i)), "\n")

    rest = F.when(F.col("gone").isNull(), text).otherwise(bound(all_lines, without))
    return joined.select("id", F.size(all_lines).cast("long").alias("n_lines"),
                         F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), rest.alias("kept"))
