"""Exact top-k search: matrix products of query tiles and candidate shards, partial selection per tile, merged in a tree.

Vectors become integers, so scores are exact. Queries are packed into tiles; groups of tiles of at most ``group_bytes``
are broadcast, and every shard of candidates (an Arrow batch) is multiplied with each tile of the group. Each task keeps
the k best per query; the lists of the tasks meet in two levels, first by slices of the tasks, then by query.

Rows which repeat a vec_id count as one vector, the smallest of them. Vectors which are null, empty, or hold null or
non-finite components, and rows without an id, take no part. Only vectors of the same length are compared. Scores beyond a long
are cut to its range. Ties go to the smaller vec_id. An empty table gives no rows; fewer candidates than k give shorter lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.common import segments
from postmill.operators.joins import first_per_key

GROUP_BYTES = 64 << 20
TILE = 512
SHARD = 4096
SLICES = 64
_LONG = (-(1 << 63), (1 << 63) - 1)


def integer_vectors(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """``floor(scale * x)`` of every component; one row per vec_id."""
    x = F.transform(F.col("embedding"), lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(v * F.lit(float(scale))).cast("long"))
    kept = embeddings.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & fine)
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), whole.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v"))


def _matrix(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ids in rising order and vectors, by length of the vectors."""
    ids = batch.column(0).to_numpy()
    lists = batch.column(1)
    offsets = lists.offsets.to_numpy()
    flat = lists.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        rows = rows[np.argsort(ids[rows], kind="stable")]
        yield ids[rows], flat[offsets[rows][:, None] + np.arange(length)]


def _scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products; floating point only where it is exact."""
    bound = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(c.astype(float)).max(initial=0)) * q.shape[1]
    if bound < 1 << 24:
        return q.astype(np.float32) @ c.astype(np.float32).T
    if bound < 1 << 53:
        return q.astype(np.float64) @ c.astype(np.float64).T
    if bound < 1 << 62:
        return q @ c.T
    return np.clip(q.astype(object) @ c.astype(object).T, *_LONG).astype(np.int64)


def _best(scores: np.ndarray, q_ids: np.ndarray, c_ids: np.ndarray, k: int):
    """Positions of the k best candidates of each query (candidates in id order), the query itself left out."""
    own = np.searchsorted(c_ids, q_ids)
    there = own < len(c_ids)
    there[there] = c_ids[own[there]] == q_ids[there]
    n = len(c_ids)
    if scores.dtype != np.int64 and n * float(np.abs(scores).max(initial=0)) < 1 << 52:
        keys = scores.astype(np.float64) * n + np.arange(n - 1, -1, -1)
        keys[np.flatnonzero(there), own[there]] = -np.inf
        take = np.argpartition(-keys, k - 1, axis=1)[:, :k] if k < n else np.tile(np.arange(n), (len(q_ids), 1))
    else:
        take = np.argsort(-scores.astype(np.float64), axis=1, kind="stable")[:, : k + 1] if scores.dtype != np.int64 else np.array(
            [np.lexsort((np.arange(n), [-int(s) for s in row]))[: k + 1] for row in scores]
        ).reshape(len(q_ids), -1)
    for row in range(len(q_ids)):
        mine = take[row]
        yield mine[mine != own[row]] if there[row] else mine


def _search(shared, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = shared.value
        slice_no = TaskContext.get().partitionId() % SLICES
        found: list[list[np.ndarray]] = [[] for _ in tiles]

        def keep(n: int) -> None:
            """Merge what a tile has found so far down to k per query."""
            q, c, s = (np.concatenate(x) for x in zip(*found[n], strict=True))
            order = np.lexsort((c, -s.astype(np.float64) if np.abs(s).max(initial=0) < 1 << 53 else np.argsort(np.argsort([-int(x) for x in s])), q))
            q, c, s = q[order], c[order], s[order]
            starts = segments(q)
            rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
            found[n] = [(q[rank < k], c[rank < k], s[rank < k])]

        for batch in batches:
            for begin in range(0, batch.num_rows, SHARD):
                for c_ids, c in _matrix(batch.slice(begin, SHARD)):
                    for n, (q_ids, q) in enumerate(tiles):
                        if q.shape[1] != c.shape[1]:
                            continue
                        scores = _scores(q, c)
                        rows = [(np.full(len(p), q_ids[i]), c_ids[p], scores[i, p].astype(np.int64)) for i, p in enumerate(_best(scores, q_ids, c_ids, k))]
                        found[n].append(tuple(np.concatenate(x) for x in zip(*rows, strict=True)))
                        if len(found[n]) >= 16:
                            keep(n)
        for n in range(len(tiles)):
            if found[n]:
                keep(n)
                q, c, s = found[n][0]
                yield pa.record_batch([pa.array(q), pa.array(c), pa.array(s), pa.array(np.full(len(q), slice_no, np.int32))], names=["query_id", "vec_id", "score", "slice"])

    return search


def _tiles(queries: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    table = queries.select("vec_id", "v").toArrow().combine_chunks()
    out = []
    for batch in table.to_batches():
        for ids, v in _matrix(batch):
            out += [(ids[i : i + TILE], v[i : i + TILE]) for i in range(0, len(ids), TILE)]
    return out


def top_k(vectors: DataFrame, is_query, k: int = 5, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """The k best other vectors of every query: query_id, rank, vec_id, score. ``is_query`` is a condition on vec_id."""
    spark = vectors.sparkSession
    queries = vectors.where(is_query)
    size = queries.agg(F.sum(F.size("v") * 8 + 8)).first()[0] or 0
    groups = int(-(-size // group_bytes)) or 1
    found = None
    for group in range(groups):
        tiles = _tiles(queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == group))
        part = vectors.select("vec_id", "v").mapInArrow(
            _search(spark.sparkContext.broadcast(tiles), k), "query_id long, vec_id long, score long, slice int"
        )
        found = part if found is None else found.unionAll(part)
    order = [F.col("score").desc(), F.col("vec_id")]
    sliced = first_per_key(found, ["query_id", "slice"], order, k)
    merged = first_per_key(sliced, ["query_id"], order, k)
    ranked = merged.groupBy("query_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id", "score"))).alias("top"))
    return ranked.select("query_id", F.posexplode("top").alias("p", "t")).select(
        "query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("t.vec_id").alias("vec_id"), F.col("t.score").alias("score")
    )
