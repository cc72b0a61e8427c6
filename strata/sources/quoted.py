"""CSV with quoted line breaks, one large file read by many tasks.

Whether a place in such a file lies inside quotes is decided by the number of
quotes before it, so a task that starts in the middle cannot tell a record's end from a
line break in a field. But what a block does to that state is a small map:
it keeps it or turns it over. The maps of a file's blocks (one bit each,
counted in a first pass) compose in order to the state in which every block starts.
With it, each task cuts its own lines into records. A record that crosses blocks
leaves pieces, which are put together in order.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUOTE = '"'
_PIECES = "file string, block long, starts boolean, header boolean, text string"


def _lines(spark: SparkSession, uri: str | list[str]) -> DataFrame:
    """The lines of the files; a line belongs to the block in which it starts."""
    return spark.read.option("lineSep", "\n").text(uri).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value")


def _starts_inside(lines: DataFrame) -> DataFrame:
    """(file, block, inside): whether the block's first line begins inside quotes."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    turned = lines.groupBy("file", "block").agg((F.sum(quotes) % 2).alias("turns"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return turned.select("file", "block", (F.coalesce(F.sum("turns").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def _cut(whole: bool):
    """Lines in order -> the records that lie in one block (``whole``), or the pieces of those that do not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, open_, inside, head, header = None, [], False, False, False
        out: list[tuple] = []

        def left_open() -> None:
            if open_ and not whole:
                out.append((*key, not head, header, "\n".join(open_)))

        for batch in batches:
            for file, block, starts_inside, value in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "inside", "value"))):
                if (file, block) != key:
                    left_open()
                    key, open_, inside, head, header = (file, block), [], starts_inside, starts_inside, block == 0
                open_.append(value)
                inside ^= value.count(QUOTE) & 1 == 1
                if not inside:
                    if whole != head:
                        out.append((*key, not head, header, "\n".join(open_)))
                    open_, head, header = [], False, False
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(("file", "block", "starts", "header", "text"), r)) for r in out], _KIND)
                out.clear()
        left_open()
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(("file", "block", "starts", "header", "text"), r)) for r in out], _KIND)

    return run


_KIND = pa.schema([("file", pa.string()), ("block", pa.int64()), ("starts", pa.bool_()), ("header", pa.bool_()), ("text", pa.string())])


def records(spark: SparkSession, uri: str | list[str]) -> DataFrame:
    """(file, header, text): every record of the files as one text, without the line break that ends it."""
    lines = _lines(spark, uri)
    placed = lines.join(_starts_inside(lines), ["file", "block"])
    # a join that shuffles keeps a block together, but not its order
    placed = placed.sortWithinPartitions("file", "block", "line").select("file", "block", "inside", "value")
    whole = placed.mapInArrow(_cut(True), _PIECES).select("file", "header", "text")
    pieces = placed.mapInArrow(_cut(False), _PIECES)
    # at most two pieces a block: the end of a record that came in, the start of one that goes on
    order = Window.partitionBy("file").orderBy("block", "starts")
    numbered = pieces.withColumn("record", F.sum(F.col("starts").cast("int")).over(order))
    joined = numbered.groupBy("file", "record").agg(
        F.max("header").alias("header"), F.sort_array(F.collect_list(F.struct("block", "starts", "text"))).alias("parts"))
    return whole.unionByName(joined.select("file", "header", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text")))


def read_quoted_csv(spark: SparkSession, uri: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """Header CSV with doubled quotes (RFC 4180) as text columns; fields may hold line breaks, quotes and commas.

    Every file's header must name the same columns in the same order (``columns``, or those of the first file),
    else the read fails. Null for empty unquoted and quoted fields, blank lines left out, short rows padded with
    nulls, as Spark's own reader does; line ends may be LF or CRLF, also mixed. Files are cut at any place, so that a file is read by as many
    tasks as its size asks for; a record is put together in one task.
    """
    if columns is None:
        columns = spark.read.option("header", True).option("multiLine", True).option("escape", QUOTE).csv(uri).columns
    if not columns:
        return spark.createDataFrame([], T.StructType([]))
    found = records(spark, uri).withColumn("text", F.regexp_replace("text", "\r$", ""))
    found = found.withColumn("text", F.when(F.col("header"), F.regexp_replace("text", "^\ufeff", "")).otherwise(F.col("text")))
    found = found.filter(F.col("text") != "")
    names = [f"c{i}" for i in range(len(columns))]
    fields = F.from_csv("text", ", ".join(f"{n} string" for n in names), {"escape": QUOTE, "multiLine": "true"})
    parsed = found.select("file", "header", "text", fields.alias("row"))
    same = F.lit(True)
    for n, c in zip(names, columns):
        same = same & F.col("row")[n].eqNullSafe(F.lit(c))
    odd = F.raise_error(F.concat(F.lit(f"the header is not {columns}: "), F.col("text"), F.lit(" in "), F.col("file")))
    rows = parsed.filter(F.when(~F.col("header"), True).when(same, False).otherwise(odd.cast("boolean")))
    return rows.select(*[F.col("row")[n].alias(c) for n, c in zip(names, columns)])
