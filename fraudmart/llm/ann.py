"""Approximate nearest neighbours by a permutation index.

``pivots`` vectors are chosen from a bounded sample.  Every vector is
represented by its ``prefix`` nearest pivots in order and posted, with its place for
each, in those pivots' inverted files.  A query ranks candidates by footrule
distance: the sum over its own pivots of the difference of places, a pivot that the
candidate lacks counting as place ``prefix``.  The best ``share`` of a block is
reranked by inner product on the original vectors in double precision.

Vectors are dealt by hash of their id into blocks of about ``BLOCK_ROWS`` and the
queries into chunks of about ``CHUNK_ROWS``; a task holds one block and one chunk and
returns at most ``k`` rows a query, which are merged.  Dealing by id spreads copies of
one vector evenly.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components,
and rows with a null id, take no part; neither do vectors whose length is not the most
frequent one (then smaller) of the table; equal scores go to the smaller id; of rows that
share an id the one with the least vector stands, the others take no part; with fewer than ``k`` candidates
all are returned; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudmart.llm.common import tidy_cogroup

PIVOTS, PREFIX = 256, 96
#: Vectors that pivots are chosen from.
SAMPLE = 2048
#: Part of a block's candidates that is reranked; never fewer than so many for each neighbour wanted.
SHARE, PER_NEIGHBOUR = 0.35, 10
BLOCK_ROWS, CHUNK_ROWS = 20_000, 4_000
SCHEMA = "query_id long, vec_id long, score double"


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part, as doubles."""
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    )
    length = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    whole = rows.where(F.size("v") == (length.n if length else 0))
    return whole.groupBy("vec_id").agg(F.min("v").alias("v"))


def choose_pivots(rows: DataFrame, pivots: int, sample: int) -> np.ndarray:
    """At most ``pivots`` vectors, each as far as can be from those before it.

    They are taken from a sample of at most ``sample`` distinct vectors, those of the
    smallest hashes, so that a large group of near copies doesn't use up the pivots.
    """
    chosen = rows.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(sample).collect()
    vectors = np.array([r.v for r in chosen], np.float64)
    if len(vectors) <= pivots:
        return vectors
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    picked = [0]
    nearest_one = unit @ unit[0]
    while len(picked) < pivots:
        picked.append(int(nearest_one.argmin()))
        nearest_one = np.maximum(nearest_one, unit @ unit[picked[-1]])
    return vectors[picked]


def matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    values = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(values, np.float64).reshape(n, -1)


def prefixes(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Each row's nearest pivots (by inner product of unit vectors, ties to the first), in order."""
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    near = unit @ (pivots / np.linalg.norm(pivots, axis=1, keepdims=True)).T
    return np.argsort(-near, axis=1, kind="stable")[:, :prefix]


def inverted_files(order: np.ndarray, n_pivots: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, their places) posted for every pivot."""
    prefix = order.shape[1]
    pivot = order.ravel()
    by_pivot = np.argsort(pivot, kind="stable")
    rows, places = by_pivot // prefix, by_pivot % prefix
    ends = np.cumsum(np.bincount(pivot, minlength=n_pivots))
    return [(rows[a:b], places[a:b]) for a, b in zip(np.concatenate(([0], ends[:-1])), ends)]


def spread_files(files: list[tuple[np.ndarray, np.ndarray]], n: int, prefix: int) -> np.ndarray:
    """The inverted files as arrays over a block's rows (pivots x rows): each row's place, ``prefix`` where it isn't posted.

    A file holds ``prefix`` / pivots of the rows, so an array is read faster than a list of them.
    """
    spread = np.full((len(files), n), prefix, np.int8 if prefix < 128 else np.int16)
    for pivot, (rows, places) in enumerate(files):
        spread[pivot, rows] = places
    return spread


def search_block(index: pa.Table, queries: pa.Table, pivots: np.ndarray, prefix: int, share: float, k: int) -> pa.Table:
    """The nearest ``k`` in one block for one chunk of queries."""
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if len(index) and len(queries):
        index = index.sort_by("vec_id")
        ids, vectors = index["vec_id"].to_numpy(), matrix(index["v"], len(index))
        # copies are one candidate; their rows stand together, smaller ids first
        _, first, copy_of = np.unique(vectors.view(f"V{vectors.strides[0]}").ravel(), return_index=True, return_inverse=True)
        vectors, ids = vectors[first], ids[np.argsort(copy_of, kind="stable")]
        ends = np.cumsum(np.bincount(copy_of))
        starts = np.concatenate(([0], ends[:-1]))
        n = len(vectors)
        asked, asked_vectors = queries["vec_id"].to_numpy(), matrix(queries["v"], len(queries))
        files = inverted_files(prefixes(vectors, pivots, prefix), len(pivots))
        prefix = min(prefix, len(pivots))
        files = spread_files(files, n, prefix)
        apart = np.empty(n, files.dtype)
        wanted = max(PER_NEIGHBOUR * k, math.ceil(share * n), k + 1)
        rough_vectors = vectors.astype(np.float32)
        longest = np.abs(vectors).sum(axis=1).max()
        for query, vector, order in zip(asked, asked_vectors, prefixes(asked_vectors, pivots, prefix)):
            candidates = np.arange(n)
            if wanted < n:
                distance = np.zeros(n, np.int16 if prefix < 128 else np.int32)
                for place, pivot in enumerate(order):
                    np.subtract(files[pivot], place, out=apart)
                    np.abs(apart, out=apart)
                    np.add(distance, apart, out=distance)
                # equal distances go to the smaller id, which comes first among the first copies
                rank = distance.astype(np.int64) * len(index) + first
                candidates = np.argpartition(rank, wanted - 1)[:wanted]
            if len(candidates) > k + 1:  # one of them may be the query's own
                rough = rough_vectors[candidates] @ vector.astype(np.float32)
                least_score = float(np.partition(rough, len(rough) - k - 1)[-k - 1])
                # more than the rounding of single precision; what is left is scored exactly
                slack = 1e-5 * longest * np.abs(vector).max()
                if np.isfinite(least_score) and np.isfinite(slack):
                    candidates = candidates[rough >= least_score - slack]
            exact = (vectors[candidates] * vector).sum(axis=1)  # row by row, not as a matrix product
            # of copies the k + 1 smallest ids are enough
            some = np.minimum(ends[candidates] - starts[candidates], k + 1)
            row = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some) + np.repeat(starts[candidates], some)
            near, scores = ids[row], np.repeat(exact, some)
            near, scores = near[near != query], scores[near != query]
            best = np.lexsort((near, -scores))[:k]
            found.append((np.full(len(best), query), near[best], scores[best]))
    columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)]
    return pa.table(dict(zip(("query_id", "vec_id", "score"), columns)))


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    pivots: int = PIVOTS,
    prefix: int = PREFIX,
    sample: int = SAMPLE,
    share: float = SHARE,
    block_rows: int = BLOCK_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` rows found nearest to each row where ``is_query`` (of vec_id) holds."""
    rows = usable(vectors, id_col, vector_col)
    queries = rows.where(is_query)
    points = choose_pivots(rows, pivots, sample)
    n, asked = rows.count(), queries.count()
    blocks, chunks = max(1, math.ceil(n / block_rows)), max(1, math.ceil(asked / chunk_rows))

    def dealt(df: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        """Each row in its own share, once for every share of the other side."""
        spread = df.withColumn(own, F.pmod(F.xxhash64("vec_id"), F.lit(n_own)))
        return spread.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_other - 1).cast("long"))))

    shared = vectors.sparkSession.sparkContext.broadcast(points)  # pivots x components

    def search(index: pa.Table, asked_rows: pa.Table) -> pa.Table:
        return search_block(index, asked_rows, shared.value, prefix, share, k)

    index = dealt(rows, "block", blocks, "chunk", chunks).groupBy("block", "chunk")
    found = index.cogroup(dealt(queries, "chunk", chunks, "block", blocks).groupBy("block", "chunk")).applyInArrow(tidy_cogroup(search), SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def recall(found: np.ndarray, exact: np.ndarray) -> float:
    """Share of the exact scores (queries x k) that the found ones reach."""
    return float((found >= exact.min(axis=1, keepdims=True) - 1e-12).mean())
