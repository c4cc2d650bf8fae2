"""Exact top-k inner products by MaxScore, over shards of an inverted index.

A component is a term, and a shard's postings of a term are the components of its vectors there.
A query's bound of a term is the most that the shard's postings can add to a score. With the
lowest score that still counts as threshold, the terms with the smallest bounds are non-essential
as long as their bounds together stay below it: no vector can get there by them alone. Essential
postings are traversed for all vectors, a block of queries at a time; the others are probed only
for vectors that can still reach the threshold. The best of all shards are merged by query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isospread.llm.memory import give_back

K = 20
SHARD = 4096
BLOCK = 256
#: Vectors whose scores give the first threshold.
SEED = 256

_PACKED = "part long, ids binary, places binary, width long"


def quantised(vectors: DataFrame, vec_id: str, embedding: str, scale: int = 64) -> DataFrame:
    """``_id`` and ``_v``, the components as whole numbers floor(scale * x); vectors that are
    null or hold a null, infinite or undefined component are left out."""
    as_double = F.transform(F.col(embedding), lambda x: x.cast("double"))
    fine = F.forall(
        as_double,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))),
    )
    return (
        vectors.where(F.col(embedding).isNotNull() & F.coalesce(fine, F.lit(False)))
        .select(
            F.col(vec_id).cast("long").alias("_id"),
            F.transform(as_double, lambda x: F.floor(x * scale).cast("long")).alias("_v"),
        )
        .where(F.col("_id").isNotNull())
    )


def _pack(vectors: DataFrame, parts: int) -> DataFrame:
    """A row for each part of the vectors, the components as a matrix."""

    def pack(table: pa.Table) -> pa.Table:
        part = table.column("part")[0].as_py()
        table = table.sort_by([("_id", "ascending")])
        ids = np.asarray(table.column("_id").to_numpy(), dtype=np.int64)
        lists = table.column("_v").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        width = int(sizes.max(initial=0))
        matrix = np.zeros((len(ids), width), dtype=np.int64)
        matrix[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
        return pa.table(
            {
                "part": pa.array([part], pa.int64()),
                "ids": pa.array([ids.tobytes()], pa.binary()),
                "places": pa.array([matrix.tobytes()], pa.binary()),
                "width": pa.array([width], pa.int64()),
            }
        )

    # the row's number spreads repeated rows, which would all go to one part otherwise
    row = F.xxhash64("_id", "_v", F.monotonically_increasing_id())
    dealt = vectors.withColumn("part", F.pmod(row, F.lit(parts)))
    return dealt.groupBy("part").applyInArrow(pack, _PACKED)


def _unpack(ids: bytes, places: bytes, width: int, to: int) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, dtype=np.int64)
    matrix = np.frombuffer(places, dtype=np.int64).reshape(len(ids), width)
    if width < to:
        matrix = np.pad(matrix, ((0, 0), (0, to - width)))
    return ids, matrix


def search(
    q_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best k of one shard for each query, and all that tie with them: (query's place,
    vector's id, score). A query's own id is no candidate."""
    largest = max(int(np.abs(queries).max(initial=0)), 1) * max(int(np.abs(vectors).max(initial=0)), 1)
    exact = np.float64 if largest * max(vectors.shape[1], 1) < 1 << 52 else np.int64
    q, v = queries.astype(exact), vectors.astype(exact)
    low = np.iinfo(np.int64).min if exact is np.int64 else -np.inf

    def kth(scores: np.ndarray) -> np.ndarray:
        """The k-th best of each query, or the lowest value if there are fewer."""
        if scores.shape[1] < k:
            return np.full(len(scores), low, dtype=exact)
        return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]

    # however often a query's own id is repeated, none of its rows counts for a threshold
    own = q_ids[:, None] == ids
    threshold = kth(np.where(own[:, :SEED], low, q @ v[:SEED].T))
    bounds = np.maximum(q * v.max(axis=0, initial=0), q * v.min(axis=0, initial=0))
    order = np.argsort(bounds, axis=1)
    ordered = np.take_along_axis(bounds, order, axis=1)
    others = np.cumsum(ordered, axis=1) < threshold[:, None]
    non_essential = np.zeros(bounds.shape, dtype=bool)
    np.put_along_axis(non_essential, order, others, axis=1)
    rest = np.where(non_essential, bounds, 0).sum(axis=1)

    partial = np.where(non_essential, 0, q) @ v.T
    probe = np.where(non_essential, q, 0)
    if len(ids) > 4 * k:
        others = np.where(own, low, partial)
        likely = np.argpartition(others, len(ids) - 2 * k, axis=1)[:, len(ids) - 2 * k :]
        full = np.take_along_axis(partial, likely, axis=1)
        full = full + np.einsum("qd,qcd->qc", probe, v[likely])
        full = np.where(np.take_along_axis(own, likely, axis=1), low, full)
        threshold = np.maximum(threshold, kth(full))
    query, vector = np.nonzero((partial + rest[:, None] >= threshold[:, None]) & ~own)
    scores = partial[query, vector]
    for at in range(0, len(query), 1 << 15):
        some = slice(at, at + (1 << 15))
        scores[some] += np.einsum("nd,nd->n", probe[query[some]], v[vector[some]])
    alive = scores >= threshold[query]
    return query[alive], ids[vector[alive]], scores[alive].astype(np.int64)


def top_k(
    queries: DataFrame,
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    k: int = K,
    scale: int = 64,
) -> DataFrame:
    """Each query's ``k`` vectors with the highest inner products: ``query_id``, ``rank`` from
    1, ``vec_id`` and ``score``, a whole number.

    Components become floor(``scale`` * x). Ties go to the smaller id; with fewer than ``k``
    candidates all are returned. A vector with the query's id is no candidate. Vectors that are
    null, hold null or non-finite components, or have a null id take no part, on either side.
    Shorter vectors count as ending in zeros. Repeated rows are candidates each; a repeated
    query row gives its ranks again. Empty tables give an empty result.
    """
    candidates = quantised(vectors, vec_id, embedding, scale)
    asked = quantised(queries, vec_id, embedding, scale)
    shards = max(1, -(-candidates.count() // SHARD))
    blocks = max(1, -(-asked.count() // BLOCK))
    index = _pack(candidates, shards)
    work = (
        _pack(asked, blocks)
        .toDF("block", "q_ids", "q_places", "q_width")
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<long>")))
        .join(index, "part")
        .select("block", "q_ids", "q_places", "q_width", "ids", "places", "width")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, *rest = (c[i].as_py() for c in batch.columns)
                q_ids, q_places, q_width, ids, places, width = rest
                to = max(q_width, width)
                names, q = _unpack(q_ids, q_places, q_width, to)
                found, v = _unpack(ids, places, width, to)
                query, vec, score = search(names, q, found, v, k)
                order = np.lexsort((vec, -score, query))
                query, vec, score = query[order], vec[order], score[order]
                place = np.arange(len(query)) - np.searchsorted(query, query)
                best = place < k
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(block * (1 << 32) + query[best]),
                        pa.array(names[query[best]]),
                        pa.array(vec[best]),
                        pa.array(score[best]),
                    ],
                    ["_query", "query_id", "vec_id", "score"],
                )

    fields = "_query long, query_id long, vec_id long, score long"
    by_query = Window.partitionBy("_query").orderBy(F.desc("score"), "vec_id")
    return (
        work.mapInArrow(give_back(run), fields)
        .withColumn("rank", F.row_number().over(by_query))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
