"""Nearest neighbours by a block matrix join.

Vectors are packed into blocks, queries into blocks of their own. Every query
block meets every block of vectors (a join on the block numbers of bounded row
groups, so that a tile is one row). In a tile, int8 products give approximate
distances; the rounding errors of both sides are known vector by vector, so
each distance has a sure interval. Vectors whose lower bound lies above the
k-th smallest upper bound (or above the k-th distance of the heap so far) are
out; the rest are computed again in double precision. Heaps per query merge the
tiles that a block of queries has in a group, are handed on before the next block
of queries begins, and a ranked top-k merges the groups. The result is exact.

Vectors are shuffled once, into groups of ``GROUP_BLOCKS`` blocks (fewer while
there are fewer groups than cores); queries once to each group. For given queries
the shuffle so grows with the vectors, a copy of the queries for every
``GROUP_BLOCKS * BLOCK_BYTES`` of them. A task holds the heaps of one block of
queries.

Defined results. Vectors that are null, empty, all zero, or hold null or
non-finite components take no part; so do null ids. Vectors are compared with
vectors of their own length only. A row is no candidate of its own query: rows
with the query's id are left out. Ties go to the smaller id; rows that repeat
another id count one by one. With fewer candidates than ``k``, all are
returned. An empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

BLOCK_BYTES = 1 << 20
QUERY_BYTES = 1 << 18
# Blocks of vectors that form a group: query blocks are copied once to each.
GROUP_BLOCKS = 128


def _block_batches(limit: int):
    """Packs vectors of equal length into blocks of at most ``limit`` bytes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def flush(dim: int) -> pa.RecordBatch:
            ids, rows = zip(*held.pop(dim))
            ids, rows = np.concatenate(ids), np.concatenate(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([dim]), pa.array([ids.tobytes()], pa.binary()), pa.array([rows.tobytes()], pa.binary())],
                ["dim", "ids", "vectors"])

        for batch in batches:
            vec = batch.column(1)
            flat = np.asarray(vec.flatten().to_numpy(zero_copy_only=False), np.float64)
            dims = np.diff(np.asarray(vec.offsets.to_numpy(zero_copy_only=False)))
            first = np.cumsum(dims) - dims
            ids = batch.column(0).to_numpy()
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                per = max(1, limit // (8 * dim))
                for a in range(0, len(rows), per):
                    at = rows[a: a + per]
                    part = (ids[at], flat[first[at][:, None] + np.arange(dim)])
                    held.setdefault(dim, []).append(part)
                    if sum(len(x[0]) for x in held[dim]) >= per:
                        yield flush(dim)
        for dim in list(held):
            yield flush(dim)

    return work


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows as int8 with one scale each, and the norm of what rounding lost."""
    scale = np.abs(x).max(axis=1) / 127.0
    q = np.rint(x / scale[:, None]).astype(np.int8)
    lost = np.linalg.norm(x - q * scale[:, None], axis=1)
    return q, scale, lost * (1 + 1e-9) + 1e-12 * scale


def distance_bounds(a: tuple, b: tuple, na: np.ndarray, nb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of squared distances between quantised rows; ``na``
    and ``nb`` are the norms of the rows. Products of int8 rows are exact sums
    in double precision."""
    (qa, sa, ea), (qb, sb, eb) = a, b
    kind = np.float32 if qa.shape[1] * 127 * 127 < 1 << 24 else np.float64
    dot = (qa.astype(kind) @ qb.astype(kind).T).astype(np.float64) * sa[:, None] * sb[None, :]
    # x.y = x^.y^ + x^.e + d.y with |x^| <= |x| + |d|
    err = (na + ea)[:, None] * eb[None, :] + ea[:, None] * nb[None, :]
    base = (na ** 2)[:, None] + (nb ** 2)[None, :]
    slack = 2 * err + 1e-9 * base
    near = base - 2 * dot
    return np.nan_to_num(near - slack, nan=0.0, posinf=np.inf), np.nan_to_num(near + slack, nan=np.inf, posinf=np.inf)


def _tile_batches(k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list] = {}  # per query of a block, the k best so far as (-distance, -id)
        held = None  # the block of queries

        def hand_on() -> Iterator[pa.RecordBatch]:
            rows = [(query, -i, -d) for query, heap in heaps.items() for d, i in heap]
            heaps.clear()
            if rows:
                query, ids, score = zip(*rows)
                yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(ids), pa.array(score)], ["query_id", "vec_id", "score"])

        for batch in batches:
            for tile in range(batch.num_rows):
                dim, qi, qv, bi, bv = (c[tile].as_py() for c in batch.columns)
                if (dim, qi, qv) != held:
                    yield from hand_on()
                    held = (dim, qi, qv)
                    q_ids, q = np.frombuffer(qi, np.int64), np.frombuffer(qv).reshape(-1, dim)
                    q_int, q_norm = quantised(q), np.linalg.norm(q, axis=1)
                ids, v = np.frombuffer(bi, np.int64), np.frombuffer(bv).reshape(-1, dim)
                lower, upper = distance_bounds(q_int, quantised(v), q_norm, np.linalg.norm(v, axis=1))
                own = q_ids[:, None] == ids[None, :]
                upper[own] = lower[own] = np.inf
                kth = np.partition(upper, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
                for r, query in enumerate(q_ids.tolist()):
                    heap = heaps.setdefault(query, [])
                    worst = -heap[0][0] if len(heap) == k else np.inf
                    bound = min(kth[r], worst * worst * (1 + 1e-9))
                    left = np.flatnonzero((lower[r] <= bound) & (lower[r] < np.inf))
                    exact = np.sqrt(((v[left] - q[r]) ** 2).sum(axis=1))
                    for d, i in zip(exact.tolist(), ids[left].tolist()):
                        if len(heap) < k:
                            heapq.heappush(heap, (-d, -i))
                        elif (-d, -i) > heap[0]:
                            heapq.heapreplace(heap, (-d, -i))
        yield from hand_on()

    return work


def usable(vec: Column) -> Column:
    """Not null or empty, not all zero, every component finite and not null."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(vec) > 0) & fine & F.exists(vec, lambda x: x != 0), F.lit(False))


def nearest(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query`` holds
    the ``k`` nearest other rows by Euclidean distance."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")
    ).where(usable(F.col("v")) & F.col("id").isNotNull())
    kind = "dim long, ids binary, vectors binary"
    pick = rows.select("id", "v")
    base = materialize(pick.mapInArrow(_block_batches(BLOCK_BYTES), kind).withColumn("n", F.monotonically_increasing_id()))
    queries = materialize(rows.where("q").select("id", "v").mapInArrow(_block_batches(QUERY_BYTES), kind))
    blocks = base.count()  # a number of blocks, not of rows
    groups = max(1, -(-blocks // GROUP_BLOCKS), min(blocks, vectors.sparkSession.sparkContext.defaultParallelism))
    base = base.withColumn("grp", F.pmod(F.xxhash64("n"), F.lit(groups)))
    copies = queries.select("dim", F.col("ids").alias("qi"), F.col("vectors").alias("qv"),
                            F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<bigint>")).alias("grp"))
    # merge join: the tiles of a block of queries follow each other
    tiles = copies.join(base.hint("merge"), ["grp", "dim"]).select("dim", "qi", "qv", "ids", "vectors")
    found = tiles.mapInArrow(_tile_batches(k), "query_id long, vec_id long, score double")
    turn = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", turn).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
