"""Small helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import jvm_context, scratch_dir, session_with


BATCH_ROWS = 256  # rows that go to Python at once, in sessions for long texts


def written(df: DataFrame, tag: str) -> str:
    """``df`` as Parquet in the session's shared scratch folder; returns the path."""
    path = scratch_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return path


def materialized(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the session's shared scratch folder and read back.

    Cuts the lineage on storage that survives a lost executor, and gives the
    reader real file sizes to plan with.
    """
    return df.sparkSession.read.schema(df.schema).parquet(written(df, tag))


def discard(spark: SparkSession, paths: list[str]) -> None:
    """Delete scratch tables that nothing will read any more: the results made from them are written."""
    sc = jvm_context(spark)
    for path in paths:
        place = sc._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)


def text_session(spark: SparkSession) -> SparkSession:
    """A session that hands Python ``BATCH_ROWS`` rows at once, so that a task's Arrow
    buffers stay small however long the texts are. The caller's settings stay as they are."""
    return session_with(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BATCH_ROWS)})


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """The UTF-8 bytes of an Arrow text column."""
    return column.cast(pa.large_binary()).to_pylist()


def each_utf8(column: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of an Arrow text column one after another, ``BATCH_ROWS`` of them copied at once."""
    for start in range(0, len(column), BATCH_ROWS):
        yield from utf8(column.slice(start, BATCH_ROWS))


def small_batches(batches: Iterator[pa.RecordBatch], text: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``text`` column holds about ``limit`` bytes at most
    (one row at least), so that working copies stay bounded when texts are long."""
    for batch in batches:
        rows = batch.num_rows
        parts = max(1, min(rows, batch.column(text).nbytes // limit + 1))
        step = -(-rows // parts) if rows else 1
        for start in range(0, rows, step):
            yield batch.slice(start, step)


def text_digest(text: str | Column) -> Column:
    """128 bits that stand for a text in joins: two XXH64 values with different seeds."""
    text = F.col(text) if isinstance(text, str) else text
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(7), text).alias("b"))


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores appended until no column of ``taken`` has it (case ignored)."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, also where ``use`` refers to it in a loop."""
    return F.get(F.transform(F.array(value), use), F.lit(0))
