"""Exact top-k inner products by columnar branch-and-bound.

Queries and candidates are cut into numbered blocks of bounded size, and every
query block meets every candidate block once, in a task of its own.  There the
candidates lie in vertical layout (one row per dimension).  Scores grow one
block of dimensions at a time; after each, a candidate can gain at most the
product of the two remaining norms (Cauchy-Schwarz), so those that cannot
reach the k-th best score seen so far are dropped and the survivors compacted
into a smaller matrix.  Blocks return k rows per query, merged by a window.
Dimensions with the most mass come first, so the bounds tighten early.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K, EVERY = 5, 50
DIMENSIONS = 16
#: Vectors of a block.
QUERY_BLOCK, CANDIDATE_BLOCK = 512, 8192
CHUNK = 64


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """vec_id and v, the components as floor(scale * x), of vectors without null or non-finite components."""
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    whole = F.transform(x, lambda e: F.floor(e * scale).cast("long"))
    return vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & fine).select(
        F.col(id_col).cast("long").alias("vec_id"), whole.alias("v"))


def best(query: np.ndarray, ids: np.ndarray, query_ids: np.ndarray, columns: np.ndarray, k: int = K) -> Iterator[tuple[int, int, int]]:
    """(query id, candidate id, score) of the k best candidates of each row of ``query``; ``columns`` is dims x candidates.

    Ties go to the smaller id; a candidate with the query's own id is left out.
    """
    dims = columns.shape[0]
    order = np.argsort(-(columns.astype(float) ** 2).sum(axis=1), kind="stable")
    columns, query = np.ascontiguousarray(columns[order]), query[:, order]
    steps = list(range(0, dims, DIMENSIONS)) or [0]
    rest = [np.sqrt((columns[s:].astype(float) ** 2).sum(axis=0)) for s in [*steps[1:], dims]]
    rest_q = [np.sqrt((query[:, s:].astype(float) ** 2).sum(axis=1)) for s in [*steps[1:], dims]]
    by_id = np.argsort(ids, kind="stable")
    ids, columns = ids[by_id], columns[:, by_id]
    rest = [r[by_id] for r in rest]
    for first in range(0, len(query), CHUNK):
        q = query[first: first + CHUNK]
        partial = q[:, steps[0]: steps[0] + DIMENSIONS] @ columns[steps[0]: steps[0] + DIMENSIONS]
        for i in range(len(q)):
            live = np.flatnonzero(ids != query_ids[first + i])
            score = partial[i, live]
            for step in range(len(steps)):
                if step:
                    block = slice(steps[step], steps[step] + DIMENSIONS)
                    score = score + q[i, block] @ columns[block, live]
                if len(live) > k and step < len(steps) - 1:
                    room = rest_q[step][first + i] * rest[step][live] * (1 + 1e-9)
                    floor = np.partition(score - room, len(live) - k)[len(live) - k]
                    stay = score + room >= floor
                    live, score = live[stay], score[stay]
            top = np.lexsort((ids[live], -score))[:k]
            for j in top:
                yield int(query_ids[first + i]), int(ids[live[j]]), int(score[j])


def search(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the k highest integer inner products of each query.

    ``vectors`` and ``queries`` have vec_id and v.  A vector with fewer
    components counts the missing ones as 0.  Repeated ids are candidates of
    their own; a query never finds its own id.  Scores must fit 63 bits.  No
    query or no candidate gives no row.
    """
    spark = vectors.sparkSession
    n, m = vectors.count(), queries.count()
    if not n or not m:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    rows, cols = -(-m // QUERY_BLOCK), -(-n // CANDIDATE_BLOCK)
    left = queries.withColumn("_r", F.pmod(F.xxhash64("vec_id", "v"), F.lit(rows)).cast("int")).withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(cols - 1))))
    right = vectors.withColumn("_c", F.pmod(F.xxhash64("v", "vec_id"), F.lit(cols)).cast("int")).withColumn("_r", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        lists = table.column("v").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        sizes = np.diff(lists.offsets.to_numpy())
        out = np.zeros((len(lists), int(sizes.max(initial=0))), np.int64)
        out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten().to_numpy()
        return out, table.column("vec_id").to_numpy()

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        found = []
        if a.num_rows and b.num_rows:
            q, q_ids = matrix(a)
            v, ids = matrix(b)
            dims = max(q.shape[1], v.shape[1])
            q, v = (np.pad(x, ((0, 0), (0, dims - x.shape[1]))) for x in (q, v))
            # Products and sums are exact in doubles below 2^53, and use the faster matrix product.
            bound = np.sqrt((q.astype(float) ** 2).sum(axis=1).max()) * np.sqrt((v.astype(float) ** 2).sum(axis=1).max())
            kind = np.float64 if bound < 2 ** 52 else np.int64
            found = list(best(q.astype(kind), ids, q_ids, np.ascontiguousarray(v.T.astype(kind)), k))
        columns = list(zip(*found, strict=True)) or [[], [], []]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.int64())})

    met = left.groupBy("_r", "_c").cogroup(right.groupBy("_r", "_c")).applyInArrow(cell, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other rows of every row whose vec_id is divisible by 50, over all embeddings."""
    vectors = usable(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))
    return search(vectors, vectors.where(F.col("vec_id") % EVERY == 0), K)


ORACLE = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
