"""Collocations from a weighted de Bruijn graph of words.

Nodes are pairs of neighbouring words, and each run of three words is an edge
between two overlapping nodes. Every word occurrence starts exactly one longest
gram: the three words from it, or fewer where its piece ends. Only these are
counted and shuffled. Shorter phrases need no counting of their own: a pair
occurs as often as edges leave its node, plus the pieces that end with it,
and a word as often as its pairs, plus the pieces that it ends.

In the part of the graph that is frequent enough, edges that pass a node
alone (all that enters it comes by one edge, all that leaves it goes by one
edge, no piece begins or ends there) are compacted into one path with one
weight. The counts of phrases are read off the paths and off the nodes at
which paths meet.

Words travel as 64-bit hashes of language and word; the table that turns them
back into words also shows that no two of them share a hash (else another
seed is taken), so the counts are exact.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import discard, materialized, utf8, written
from strata.session import session_with

MIN_COUNT = 10
TOP = 2000
COVERED_PERCENT = 50
PARTS = 2               # passes over the texts; each counts the grams of a share of the first words
LOCAL_WORDS = 1 << 21   # words whose grams a task counts together before they are shuffled
UNDETERMINED = "und"
SCALE = 1_000_000
SEEDS = range(8)
SALTS = 16

_END = b"\xff"  # no byte of any text: stands for the end of a piece
_CODE_BITS = 21
_ASCII = bytes(0xFF if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))


class _Codes(dict):
    """Words of one language in the order in which they are met; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


class _Local:
    """Words of some texts as numbers, one sequence a language."""

    def __init__(self):
        self.languages: dict[str, tuple[_Codes, array]] = {}
        self.size = 0

    def add(self, lang: str, text: bytes) -> None:
        codes, words = self.languages.get(lang) or self.languages.setdefault(lang, (_Codes({_END: 0}), array("i")))
        found = text.translate(_ASCII).replace(_END, b" " + _END + b" ").split()
        words.extend(map(codes.__getitem__, found))
        words.append(0)
        self.size += len(found)

    def ids(self, seed: int) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray]]:
        """(language, words, their hashes, the sequence) of each language; the piece end has hash 0."""
        for lang, (codes, words) in self.languages.items():
            prefix = f"{len(lang)}:{lang}".encode()
            hashes = [0] + [xxhash.xxh64_intdigest(prefix + w, seed) for w in list(codes)[1:]]
            yield lang, list(codes), np.array(hashes, np.uint64).view(np.int64), np.frombuffer(words, np.int32).astype(np.int64)


def _locals(batches: Iterator[pa.RecordBatch]) -> Iterator[_Local]:
    local = _Local()
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            rows = batch.slice(start, 256)
            for lang, text in zip(rows.column("lang").to_pylist(), utf8(rows.column("text"))):
                local.add(lang, text)
                if local.size >= LOCAL_WORDS:
                    yield local
                    local = _Local()
    yield local


def _cut(columns: list, names: list[str], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    for start in range(0, len(columns[0]), rows):
        yield pa.RecordBatch.from_arrays([pa.array(c[start:start + rows]) for c in columns], names)


def _grams(local: _Local, seed: int, part: int, parts: int) -> Iterator[pa.RecordBatch]:
    """(a, b, c, n): the longest grams by their first word, counted; 0 stands where the piece has ended."""
    for _, _, ids, words in local.ids(seed):
        at = np.flatnonzero(words)
        at = at[ids.view(np.uint64)[words[at]] % np.uint64(parts) == part]
        ahead = np.concatenate((words, [0, 0]))
        second = ahead[at + 1]
        third = np.where(second != 0, ahead[at + 2], 0)
        # one language's codes stay below 2 ** _CODE_BITS: there are LOCAL_WORDS words and a text's at most ...
        if len(ids) < 1 << _CODE_BITS:
            keys, n = np.unique(ahead[at] << 2 * _CODE_BITS | second << _CODE_BITS | third, return_counts=True)
            mask = (1 << _CODE_BITS) - 1
            codes = (keys >> 2 * _CODE_BITS, keys >> _CODE_BITS & mask, keys & mask)
        else:  # ... or, in one very long text, more
            rows, n = np.unique(np.stack((ahead[at], second, third)), axis=1, return_counts=True)
            codes = tuple(rows)
        yield from _cut([*(ids[c] for c in codes), n], ["a", "b", "c", "n"])


def _words(local: _Local, seed: int) -> Iterator[pa.RecordBatch]:
    for lang, words, ids, _ in local.ids(seed):
        yield from _cut([ids[1:], [lang] * (len(words) - 1), [w.decode() for w in words[1:]]], ["id", "lang", "word"])


def vocabulary(texts: DataFrame) -> tuple[int, DataFrame]:
    """(seed, table (id, lang, word)) of all words of ``texts`` (lang, text), no two words with one id."""
    for seed in SEEDS:
        def run(batches: Iterator[pa.RecordBatch], seed: int = seed) -> Iterator[pa.RecordBatch]:
            for local in _locals(batches):
                yield from _words(local, seed)

        found = materialized(texts.mapInArrow(run, "id long, lang string, word string").distinct(), "words")
        if found.groupBy("id").count().filter("count > 1 OR id = 0").isEmpty():
            return seed, found
    raise RuntimeError(f"words share a 64-bit hash under all of {len(SEEDS)} seeds")


def flows(texts: DataFrame, seed: int, part: int, parts: int, min_count: int) -> DataFrame:
    """(a, b, c, f): edges and nodes (c = 0) with f >= ``min_count``, and all words (b = c = 0), of the grams
    whose first word is in this part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for local in _locals(batches):
            yield from _grams(local, seed, part, parts)

    end = F.lit(0).cast("long")
    # a hot gram is counted in its task first and dealt out as a whole gram: a hot node or word is many grams
    edges = texts.mapInArrow(run, "a long, b long, c long, n long").groupBy("a", "b", "c").agg(F.sum("n").alias("f"))
    nodes = edges.groupBy("a", "b").agg(F.sum("f").alias("f"))  # flow out of the node, with the ends of pieces (c = 0)
    words = nodes.groupBy("a").agg(F.sum("f").alias("f"))

    def often(last: str) -> Column:  # one test of key and count: a filter on the key alone would be pushed
        return F.when(F.col(last) != 0, F.col("f")) >= min_count  # down, and the grams counted once for each use

    return (edges.filter(often("c")).unionByName(nodes.filter(often("b")).select("a", "b", end.alias("c"), "f"))
            .unionByName(words.select("a", end.alias("b"), end.alias("c"), "f")))


def compact(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """(path, f): the edges (a, b, c, f), with those that pass a node alone joined into one path of word ids.

    An edge goes on into the next one where both are all of the node (a, b, f) between them.
    Paths are followed by pointer jumping: each round doubles the steps back to a path's first edge.
    A path is no longer than the longest piece.
    """
    key = F.struct("a", "b", "c")
    entering = edges.select(F.col("b").alias("x"), F.col("c").alias("y"), "f", key.alias("before"))
    leaving = edges.select(F.col("a").alias("x"), F.col("b").alias("y"), "f", key.alias("edge"))
    passed = nodes.toDF("x", "y", "f")
    steps = entering.join(passed, ["x", "y", "f"]).join(leaving, ["x", "y", "f"]).select("edge", "before")
    # an edge that is all of a node has no rival there, so each edge has one step back at most
    place = edges.select(key.alias("edge"), "f").join(steps, "edge", "left").select(
        "edge", "f", F.coalesce("before", "edge").alias("root"), F.col("before").isNotNull().cast("long").alias("back"))
    place = materialized(place, "paths")
    while True:
        ahead = place.select(F.col("edge").alias("root"), F.col("root").alias("far"), F.col("back").alias("more"))
        jumped = materialized(place.join(ahead, "root").select(
            "edge", "f", F.col("far").alias("root"), (F.col("back") + F.col("more")).alias("back"), "more"), "paths")
        done = jumped.filter("more > 0").isEmpty()
        place = jumped.drop("more")
        if done:
            break
    joined = place.groupBy("root", "f").agg(F.sort_array(F.collect_list(F.struct("back", "edge.c"))).alias("rest"))
    return joined.select(F.concat(F.array("root.a", "root.b"), F.transform("rest", lambda r: r["c"])).alias("path"), "f")


def counts(paths: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(triples (a, b, c, f), pairs (a, b, f)): triples and inner pairs read off the paths, other pairs off the nodes."""
    paths = materialized(paths, "compacted")
    triples = paths.select("f", "path", F.explode(F.sequence(F.lit(0), F.size("path") - 3)).alias("i")).select(
        *[F.get("path", F.col("i") + k).alias(n) for k, n in enumerate("abc")], "f")
    inner = paths.filter(F.size("path") > 3).select("f", "path", F.explode(F.sequence(F.lit(1), F.size("path") - 3)).alias("i")).select(
        *[F.get("path", F.col("i") + k).alias(n) for k, n in enumerate("ab")], "f")
    outer = nodes.join(inner, ["a", "b"], "left_anti")
    return triples, outer.unionByName(inner)


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(SCALE * a * a / (left * right)), exact: products as 38-digit decimals."""
    wide = [c.cast("decimal(18,0)") for c in (a, a, left, right)]
    return F.call_function("div", wide[0] * wide[1] * F.lit(SCALE), wide[2] * wide[3])


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, top: int = TOP,
                 covered_percent: int = COVERED_PERCENT, parts: int = PARTS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two to three words.

    Texts are lower-cased (A-Z), split into pieces at ``. , ; : ! ?`` and line ends, and those into words at
    blanks and tabs. ``a`` is the phrase's occurrences (``min_count`` at least), ``n`` the words of its
    language; of the cuts into ``l`` and ``r`` occurrences the one with the lowest ``score``
    (parts per million of a * a / (l * r), rounded down) counts, ties to the earlier one. A phrase that lies inside a longer one
    with ``covered_percent`` of its occurrences or more is left out. The best ``top`` by score, then ``a``,
    then the phrase's bytes, stay.

    Null texts count as empty, null languages as ``und``; repeated rows count as often as they occur; other
    columns are not read; an empty table gives an empty result. A language without a phrase that is
    frequent enough has no rows. The texts are read ``parts`` + 1 times, and what a pass has shuffled is
    deleted after it where the session is one of ``graph_session``.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(lang_col, F.lit(UNDETERMINED)).cast("string").alias("lang"),
                        F.coalesce(text_col, F.lit("")).alias("text"))
    seed, names = vocabulary(texts)
    paths = [written(flows(texts, seed, part, parts, min_count), "flows") for part in range(parts)]
    graph = spark.read.schema("a long, b long, c long, f long").parquet(*paths)
    nodes = graph.filter("b != 0 AND c = 0").select("a", "b", "f")
    triples, pairs = counts(compact(graph.filter("c != 0"), nodes), nodes)
    triples, pairs = materialized(triples, "triples"), materialized(pairs, "pairs")

    known = graph.filter("b = 0").select(F.col("a").alias("id"), "f").join(names, "id")
    sizes = known.groupBy("lang").agg(F.sum("f").alias("n"))
    words = materialized(known.filter(F.col("f") >= min_count), "frequent_words")

    def word(name: str) -> DataFrame:
        return words.select(F.col("id").alias(name), F.col("f").alias(f"f_{name}"), F.col("word").alias(f"word_{name}"),
                            *([F.col("lang")] if name == "a" else []))

    def pair(x: str, y: str) -> DataFrame:
        return pairs.toDF(x, y, f"f_{x}{y}")

    two = pairs.withColumnRenamed("f", "n2").join(word("a"), "a").join(word("b"), "b")
    longer = triples.select("a", "b", "f").unionByName(triples.select(F.col("b").alias("a"), F.col("c").alias("b"), "f"))
    longer = longer.groupBy("a", "b").agg(F.max("f").alias("longest"))
    two = two.join(longer, ["a", "b"], "left").filter(
        F.col("longest").isNull() | (100 * F.col("longest") < covered_percent * F.col("n2")))
    two = two.select("lang", F.concat_ws(" ", "word_a", "word_b").alias("phrase"), F.col("n2").alias("a"),
                     F.col("f_a").alias("l"), F.col("f_b").alias("r"), _score(F.col("n2"), F.col("f_a"), F.col("f_b")).alias("score"))

    three = triples.withColumnRenamed("f", "n3").join(pair("a", "b"), ["a", "b"]).join(pair("b", "c"), ["b", "c"])
    for name in "abc":
        three = three.join(word(name), name)
    cuts = [F.struct(_score(F.col("n3"), F.col(left), F.col(right)).alias("score"), F.lit(k).alias("k"),
                     F.col(left).alias("l"), F.col(right).alias("r")) for k, left, right in ((1, "f_a", "f_bc"), (2, "f_ab", "f_c"))]
    three = three.select("lang", F.concat_ws(" ", "word_a", "word_b", "word_c").alias("phrase"), F.col("n3").alias("a"),
                         F.least(*cuts).alias("cut")).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")

    def best(rows: DataFrame, *groups: str | Column) -> DataFrame:
        order = Window.partitionBy(*groups).orderBy(F.desc("score"), F.desc("a"), "phrase")
        return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)

    # the best of each of SALTS shares of a language first: what one task ranks at the end is bounded
    found = best(best(two.unionByName(three), "lang", F.pmod(F.hash("phrase"), F.lit(SALTS))), "lang")
    found = materialized(found.join(sizes, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"),
                         "collocations")
    discard(spark, paths)
    return found


def graph_session(spark: SparkSession) -> SparkSession:
    """A session whose queries delete their shuffle files when they are done. The caller's settings stay as they are."""
    return session_with(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})
