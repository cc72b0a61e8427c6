"""Exact top-k by inner product with Fagin's threshold algorithm.

Vectors are dealt to blocks of bounded size, and so are queries; every pair of blocks is
one group of a cogroup, so neither side is broadcast or gathered whole.
Inside a block each dimension has a sorted list. A query reads its lists from
their best ends (from the top where its weight is positive, from the bottom
where it is negative), scores every vector it meets, and stops as soon as
the best score that an unmet vector could have, the threshold, lies below
its kth score. Vectors tied with the kth score are always met, as
the scan goes on while the threshold equals it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import materialized

VECTORS = 2048   # vectors of a block
QUERIES = 2048   # queries of a block
DEPTH = 16       # list entries read in the first round; doubled each round


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows; missing components of shorter ones are 0."""
    out = np.zeros((len(column), width), np.int64)
    lists = column.combine_chunks()
    values, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    lengths = np.diff(offsets)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    places = np.arange(offsets[0], offsets[-1]) - np.repeat(offsets[:-1], lengths)
    out[rows, places] = values[offsets[0]:offsets[-1]]
    return out


def _exact(vectors: np.ndarray, queries: np.ndarray) -> type:
    """The fastest number type in which all inner products are exact."""
    most = int(np.abs(vectors).max(initial=0)) * int(np.abs(queries).max(initial=0)) * max(1, vectors.shape[1])
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else np.int64


class Lists:
    """The sorted lists of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(vectors, self.order, axis=0)

    def search(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best vectors other than ``own``; ties go to the smaller id."""
        n = len(self.ids)
        up, down = np.flatnonzero(query > 0), np.flatnonzero(query < 0)
        met = np.zeros(n, bool)
        ids, scores = self.ids[:0], np.empty(0, query.dtype)
        depth = min(DEPTH, n)
        while True:
            fresh = np.zeros(n, bool)
            fresh[self.order[n - depth:, up].ravel()] = True
            fresh[self.order[:depth, down].ravel()] = True
            if depth == n:  # also where all weights are 0 and no list is read
                fresh[:] = True
            fresh &= ~met
            met |= fresh
            at = np.flatnonzero(fresh)
            got = (self.vectors @ query)[at] if 8 * len(at) > n else self.vectors[at] @ query
            other = self.ids[at] != own
            ids, scores = np.concatenate((ids, self.ids[at][other])), np.concatenate((scores, got[other]))
            best = np.lexsort((ids, -scores))[:k] if len(ids) > k else np.lexsort((ids, -scores))
            ids, scores = ids[best], scores[best]
            threshold = self.values[n - depth, up] @ query[up] + self.values[depth - 1, down] @ query[down]
            if depth == n or (len(ids) == k and scores[-1] > threshold):
                return ids, scores
            depth = min(2 * depth, n)


def _search_blocks(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": [], "query_hash": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            width = max(max(t.column("v").combine_chunks().value_lengths().to_numpy(), default=0) for t in (left, right))
            vectors, queries = _matrix(left.column("v"), width), _matrix(right.column("v"), width)
            kind = _exact(vectors, queries)
            lists = Lists(left.column("id").to_numpy(), vectors.astype(kind))
            for own, code, query in zip(right.column("id").to_pylist(), right.column("h").to_pylist(), queries.astype(kind)):
                ids, scores = lists.search(own, query, k)
                out["query_id"] += [own] * len(ids)
                out["query_hash"] += [code] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += scores.astype(np.int64).tolist()
        return pa.table({c: pa.array(v, pa.int64()) for c, v in out.items()})

    return run


def top_k(vectors: DataFrame, queries: Column, k: int, id_col: str = "vec_id",
          vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other vectors for each row where ``queries`` holds.

    Components count as floor(scale * x); the score is their integer inner
    product, and ties go to the smaller id. Rows whose vector is null or has
    a null or non-finite component, or whose id is null, take no part. A
    row repeated whole counts once; rows with the query's id are its own.
    Missing components of shorter vectors count as 0. Ids are integers.
    """
    x = F.col(vector_col)
    finite = ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    whole = F.transform(x, lambda v: F.floor(v.cast("double") * scale))
    rows = vectors.filter(F.col(id_col).isNotNull() & x.isNotNull() & finite).select(
        F.col(id_col).cast("long").alias("id"), whole.alias("v"), queries.alias("asks"))
    rows = rows.withColumn("h", F.xxhash64("v")).dropDuplicates(["id", "h"])
    rows = materialized(rows, "vectors")
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("q")).first()
    vector_blocks, query_blocks = max(1, -(-sizes.n // VECTORS)), max(1, -(-sizes.q // QUERIES))

    def blocks(own: str, n: int, other: str, m: int) -> list[Column]:
        every = F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))
        return [F.pmod(F.xxhash64("id"), F.lit(n)).alias(own), F.explode(every).alias(other)]

    left = rows.select("id", "v", *blocks("vb", vector_blocks, "qb", query_blocks)).select("vb", "qb", "id", "v")
    right = rows.filter("asks").select("id", "v", "h", *blocks("qb", query_blocks, "vb", vector_blocks)).select(
        "vb", "qb", "id", "v", "h")
    found = left.groupBy("vb", "qb").cogroup(right.groupBy("vb", "qb")).applyInArrow(
        _search_blocks(k), "query_id long, query_hash long, vec_id long, score long")
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
