"""Benchmark decontamination over a positional inverted index.

The index holds, for every training document, the postings (position, term)
that a benchmark phrase can use: words of the benchmark's vocabulary inside
stretches of such words at least as long as a phrase. A phrase consists of
consecutive benchmark words, so no occurrence lies outside these stretches.

Phrases are found from their rarest terms, as the index counts them. Each
window of an item is anchored at its rarest term; the anchors' posting lists,
shifted by the anchor's offset in the item, give (document, item, diagonal)
candidates. On a diagonal, the item's offset-adjusted lists are intersected
term by term, which is exact and yields all windows of the item at once.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import discard, fresh, materialized, small_batches, text_digest, text_session, utf8, written

WINDOW = 13
VOCABULARY_BYTES = 32 << 20  # benchmark words sent to the tasks at once; larger benchmarks go in blocks

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | Column) -> Column:
    """Lower-cased (A-Z) words of a text: digits, a-z and all characters beyond ASCII."""
    text = F.col(text) if isinstance(text, str) else text
    lower = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_key, terms): one row per distinct item text; null ids stand as the empty text."""
    rows = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                            words(text_col).alias("terms")).filter(F.size("terms") > 0).distinct()
    return rows.withColumn("item_key", F.monotonically_increasing_id())


def _blocks(items: DataFrame) -> list[DataFrame]:
    """``items`` in parts whose words fit into ``VOCABULARY_BYTES`` (checked by their sum)."""
    size = items.agg(F.sum(F.length(F.array_join("terms", " ")) * 4)).first()[0] or 0
    n = -(-size // VOCABULARY_BYTES)
    return [items.filter(F.pmod(F.xxhash64("item_key"), F.lit(n)) == i) for i in range(n)] if n > 1 else [items]


def _vocabularies(items: DataFrame, window: int) -> dict[int, list[bytes]]:
    """Phrase length -> the words of the items with phrases of that length (one block of items)."""
    length = F.least(F.size("terms"), F.lit(window))
    found: dict[int, list[bytes]] = {}
    for row in items.select(length.alias("n"), F.explode("terms").alias("term")).distinct().collect():
        found.setdefault(row.n, []).append(row.term.encode())
    return found


def build_index(docs: DataFrame, row: str, text_col: str, vocabularies: dict[int, list[bytes]]) -> DataFrame:
    """(row, n_words, positions, terms): one row for each row of ``docs`` with its postings.

    ``positions`` ascend; ``terms`` has the words there. Texts are read whole.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = [(frozenset(v).__contains__, re.compile(b"\x01{%d,}" % n)) for n, v in vocabularies.items()]
        for batch in small_batches(batches, "text"):
            counts, positions, terms = [], [], []
            for text in utf8(batch.column("text")):
                own = (text or b"").translate(_WORD_BYTES).split()
                places: set[int] = set()
                for known, stretch in rules:
                    for m in stretch.finditer(bytes(map(known, own))):
                        places.update(range(*m.span()))
                at = sorted(places)
                counts.append(len(own))
                positions.append(at)
                terms.append([own[i].decode("utf-8", "replace") for i in at])
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(counts, pa.int64()), pa.array(positions, pa.list_(pa.int32())),
                 pa.array(terms, pa.list_(pa.string()))], ["row", "n_words", "positions", "terms"])

    return docs.select(F.col(row).alias("row"), F.col(text_col).alias("text")).mapInArrow(
        run, "row long, n_words long, positions array<int>, terms array<string>")


def _anchors(items: DataFrame, index: DataFrame, window: int) -> DataFrame:
    """(item_key, term, offset): the rarest term of every window; windows with a term
    that the index lacks cannot occur and have none."""
    frequency = index.select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").count()
    placed = items.select("item_key", F.size("terms").alias("n"), F.posexplode("terms").alias("offset", "term"))
    rated = placed.join(frequency, "term", "left")
    first = F.greatest(F.lit(0), F.col("offset") - (window - 1))
    last = F.least(F.col("offset"), F.greatest(F.lit(0), F.col("n") - window))
    each = rated.withColumn("start", F.explode(F.sequence(first, last)))
    best = each.groupBy("item_key", "start").agg(
        F.min(F.struct("count", "term", "offset")).alias("best"),
        F.max(F.col("count").isNull()).alias("dead")).filter(~F.col("dead"))
    return best.select("item_key", "best.term", "best.offset").distinct()


def _covered(window: int, positions: str, terms: str, item: str, diagonal: str) -> Column:
    """Document positions covered by windows of an item on one diagonal."""
    def run(position: pa.Array, term: pa.Array, wanted: pa.Array, start: pa.Array) -> pa.Array:
        out = []
        for at, own, want, d in zip(position.to_pylist(), term.to_pylist(), wanted.to_pylist(), start.to_pylist()):
            n = min(window, len(want))
            at = np.asarray(at, np.int64)
            lo, hi = np.searchsorted(at, [d, d + len(want)])
            same = np.zeros(len(want), bool)
            for i in range(lo, hi):
                same[at[i] - d] = own[i] == want[at[i] - d]
            hit = np.zeros(len(want), bool)
            for m in re.finditer(b"\x01{%d,}" % n, same.tobytes()):
                hit[m.start():m.end()] = True
            out.append((np.flatnonzero(hit) + d).tolist())
        return pa.array(out, pa.list_(pa.int64()))

    return F.arrow_udf(run, T.ArrayType(T.LongType()))(positions, terms, item, diagonal)


def phrase_hits(index: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """(row, item, covered): for each document and item with an occurring window, the
    document positions inside its occurrences (one row per diagonal)."""
    some = index.filter(F.size("positions") > 0)
    anchors = materialized(_anchors(items, some, window), "anchors")
    postings = some.select("row", F.explode(F.arrays_zip("positions", "terms")).alias("p")).select(
        "row", F.col("p.positions").alias("position"), F.col("p.terms").alias("term"))
    diagonals = postings.join(anchors, "term").select(
        "row", "item_key", (F.col("position") - F.col("offset")).cast("long").alias("diagonal")).distinct()
    diagonals = materialized(diagonals, "diagonals")
    lists = items.select("item_key", "item", F.col("terms").alias("wanted"))
    met = diagonals.join(lists, "item_key").join(some.select("row", "positions", "terms"), "row")
    covered = met.select("row", "item", _covered(window, "positions", "terms", "wanted", "diagonal").alias("covered"))
    return covered.filter(F.size("covered") > 0)


def proximity_hits(index: DataFrame, items: DataFrame, slop: int, window: int = WINDOW) -> DataFrame:
    """(row, item, position, other_position): the two rarest terms of an item's window, as the index counts
    them, in that document at most ``slop`` words further apart or closer than in the item.

    Works on the postings that the index holds: both terms lie in stretches of benchmark words, so passages
    with foreign words in between are not found. No query or stage uses it.
    """
    some = index.filter(F.size("positions") > 0)
    frequency = some.select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").count()
    placed = items.select("item_key", "item", F.posexplode("terms").alias("offset", "term")).join(frequency, "term")
    order = Window.partitionBy("item_key", F.floor(F.col("offset") / window)).orderBy("count", "term", "offset")
    ranked = placed.withColumn("place", F.row_number().over(order)).withColumn(
        "part", F.floor(F.col("offset") / window)).filter("place <= 2")
    one = ranked.filter("place = 1").select("item_key", "item", "part", F.col("term").alias("t1"), F.col("offset").alias("o1"))
    two = ranked.filter("place = 2").select("item_key", "part", F.col("term").alias("t2"), F.col("offset").alias("o2"))
    pairs = one.join(two, ["item_key", "part"])
    postings = some.select("row", F.explode(F.arrays_zip("positions", "terms")).alias("p")).select(
        "row", F.col("p.positions").alias("position"), F.col("p.terms").alias("term"))
    left = postings.join(pairs, postings.term == pairs.t1).select(
        "row", "item", "t2", F.col("position").alias("p1"), (F.col("o2") - F.col("o1")).alias("apart"),
        F.explode(F.expr(f"sequence(position + o2 - o1 - {int(slop)}, position + o2 - o1 + {int(slop)})")).alias("p2"))
    right = postings.select("row", F.col("term").alias("t2"), F.col("position").alias("p2"))
    return left.join(right, ["row", "t2", "p2"]).select(
        "row", "item", F.col("p1").alias("position"), F.col("p2").alias("other_position")).distinct()


def _verdicts(docs: DataFrame, id_col: str, text_col: str, benchmark: DataFrame, item_id: str, item_text: str,
              window: int) -> DataFrame:
    """(id, a, b, n_words, n_hit, item_ids) for each row of ``docs``; a and b are the digest of its text.

    The texts are copied to scratch, read in small batches, and discarded when the verdicts are written.
    """
    spark = docs.sparkSession
    small = text_session(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), text_digest(text_col).alias("digest"),
                       F.monotonically_increasing_id().alias("row"))
    scratch = [written(rows, "decontam_rows")]
    texts = small.read.schema(rows.schema).parquet(scratch[0])
    items = small.read.parquet(written(_items(benchmark, item_id, item_text), "items"))
    hits, n_words = [], None
    for block in _blocks(items):
        postings = build_index(texts, "row", "text", _vocabularies(block, window))
        scratch.append(written(postings, "index"))
        index = small.read.schema(postings.schema).parquet(scratch[-1])
        hits.append(phrase_hits(index, block, window))
        n_words = index.select("row", "n_words") if n_words is None else n_words
    per_row = reduce(DataFrame.unionByName, hits).groupBy("row").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("covered")))).cast("long").alias("n_hit"),
        F.sort_array(F.collect_set("item")).alias("item_ids"))
    per_row = materialized(per_row, "hits")
    found = texts.select("id", "digest.a", "digest.b", "row").join(n_words, "row").join(per_row, "row", "left").select(
        "id", "a", "b", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"))
    verdicts = spark.read.schema(found.schema).parquet(written(found, "verdicts"))
    discard(spark, scratch)
    return verdicts


def _is_contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, n_hit, item_ids, contaminated) of every row of ``docs``.

    ``n_hit`` counts the words that lie inside an occurrence of a benchmark
    window (``window`` consecutive words of an item, or a shorter item as a
    whole); ``item_ids`` has the items with occurring windows, as sorted
    texts. A row is contaminated from 5 % hit words on. Null texts have no
    words; items without words and empty tables hit nothing; a null item id
    stands as the empty text, and repeated items count once.
    """
    return _verdicts(docs, id_col, text_col, benchmark, item_id, item_text, window).select(
        "id", "n_words", "n_hit", "item_ids",
        _is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns kept."""
    found = _verdicts(docs, id_col, text_col, benchmark, item_id, item_text, window)
    bad = found.filter(_is_contaminated(F.col("n_hit"), F.col("n_words")))
    digest = fresh("digest", docs.columns)
    marked = docs.withColumn(digest, text_digest(text_col))  # a verdict depends on the text alone
    bad = materialized(bad.select("a", "b").distinct(), "contaminated")
    same = (F.col(digest)["a"] == bad.a) & (F.col(digest)["b"] == bad.b)
    return marked.join(bad, same, "left_anti").select(*docs.columns)
