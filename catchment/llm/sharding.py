"""Uniform shuffle into shards of exact sizes by a communication matrix.

For every input partition the number of its rows that go to each block of each
shard is drawn from the multivariate hypergeometric law, as a uniform shuffle
would give it. A partition deals its rows to these counts in random order, the
rows are exchanged, and every block orders its rows at random again. A row's
slot in its shard is its block's start plus its place there: no count over a
shard is taken and no shard is held by one task.

The matrix is never built whole. A binary tree over the partitions halves the
partition range; a node splits its block capacities between its halves with a
generator seeded by the node. A task walks from the root to its own partition
and so draws only its own row, from the partition sizes alone.

The law is ``rows``: shard sizes differ by at most one. The same stored table,
seed and number of shards give the same result. The input is stored first
unless it is a scan of files (``stored``), so that both passes and any repeated
task see the same rows in the same partitions.

Defined results. Null ids and texts are rows as any others; repeated rows are
placed one by one; with fewer rows than shards, the first shards get one each;
an empty table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .text import mix

# Rows that one task orders after the exchange, and most blocks (a task draws its
# row of the matrix over all of them; from 10 ** 10 rows on, blocks grow).
BLOCK_ROWS = 20_000
MOST_BLOCKS = 1 << 19
_EXACT_LIMIT = 10**9


def even_sizes(total: int, parts: int) -> np.ndarray:
    """``parts`` sizes of sum ``total`` that differ by at most one."""
    return np.full(parts, total // parts, np.int64) + (np.arange(parts) < total % parts)


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` drawn without replacement are good. Beyond numpy's
    limit: inversion over 40 standard deviations around the mean."""
    if n == 0 or good == 0:
        return 0
    if bad == 0:
        return n
    if good + bad < _EXACT_LIMIT:
        return int(rng.hypergeometric(good, bad, n))
    total = good + bad
    mean = n * good / total
    sd = math.sqrt(max(mean * bad / total * (total - n) / (total - 1), 1.0))
    lo, hi = max(0, n - bad, int(mean - 40 * sd)), min(good, n, int(mean + 40 * sd) + 1)
    x = np.arange(lo, hi)
    ratio = (np.log(good - x) + np.log(n - x)) - (np.log(x + 1.0) + np.log(bad - n + x + 1.0))
    weight = np.concatenate([[0.0], np.cumsum(ratio)])
    weight = np.cumsum(np.exp(weight - weight.max()))
    return lo + int(np.searchsorted(weight, rng.random() * weight[-1], "right"))


def _split(rng: np.random.Generator, capacity: np.ndarray, n: int) -> np.ndarray:
    """A multivariate hypergeometric draw of ``n`` from ``capacity``."""
    if capacity.sum() < _EXACT_LIMIT:
        return rng.multivariate_hypergeometric(capacity, n, method="marginals")
    # a tree over the columns, too: each level is drawn at once where numpy's limit allows
    size = 1 << (len(capacity) - 1).bit_length()
    sums = [np.concatenate([capacity, np.zeros(size - len(capacity), np.int64)])]
    while len(sums[-1]) > 1:
        sums.append(sums[-1].reshape(-1, 2).sum(axis=1))
    drawn = np.array([n])
    for level in reversed(sums[:-1]):
        first, second = level[::2], level[1::2]
        left = np.where(second == 0, drawn, 0)
        some = (drawn > 0) & (first > 0) & (second > 0)
        small = np.flatnonzero(some & (first + second < _EXACT_LIMIT))
        left[small] = rng.hypergeometric(first[small], second[small], drawn[small])
        for i in np.flatnonzero(some & (first + second >= _EXACT_LIMIT)).tolist():
            left[i] = _hypergeometric(rng, int(first[i]), int(second[i]), int(drawn[i]))
        drawn = np.stack([left, drawn - left], axis=1).ravel()
    return drawn[: len(capacity)]


def matrix_row(sizes: np.ndarray, capacity: np.ndarray, partition: int, seed: int) -> np.ndarray:
    """Row ``partition`` of the communication matrix. The columns of all rows
    sum to ``capacity``, the rows to ``sizes``."""
    before = np.concatenate([[0], np.cumsum(sizes)])
    lo, hi, cap = 0, len(sizes), np.asarray(capacity, np.int64)
    while hi - lo > 1:
        mid = (lo + hi) // 2
        left = _split(np.random.default_rng([seed, lo, hi]), cap, int(before[mid] - before[lo]))
        lo, hi, cap = (lo, mid, left) if partition < mid else (mid, hi, cap - left)
    return cap


def shard_rows(docs: DataFrame, columns: dict[str, Column], n_shards: int, seed: int = 42, stored: bool = False) -> DataFrame:
    """``columns`` of ``docs`` (name -> expression) with ``shard`` (0 to
    ``n_shards - 1``) and ``slot`` (0 up, without gaps, in each shard)."""
    rows = docs.select(*[c.alias(n) for n, c in columns.items()])
    if not stored:
        rows = materialize(rows)
    # one number per partition comes to the driver
    counts = {r[0]: r[1] for r in rows.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()}
    sizes = np.zeros(max(counts, default=0) + 1, np.int64)
    sizes[list(counts)] = list(counts.values())
    total = int(sizes.sum())
    per_shard = max(1, min(-(-total // (n_shards * BLOCK_ROWS)), MOST_BLOCKS // n_shards))
    names = list(columns)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = TaskContext.get().partitionId()
        if p >= len(sizes) or not sizes[p]:
            if any(batch.num_rows for batch in batches):
                raise RuntimeError("a partition has rows that were not counted: the input is not stored")
            return
        capacity = np.concatenate([even_sizes(s, per_shard) for s in even_sizes(total, n_shards)])
        by_shard = capacity.reshape(n_shards, per_shard)
        starts = (np.cumsum(by_shard, axis=1) - by_shard).ravel()
        labels = np.repeat(np.arange(len(capacity)), matrix_row(sizes, capacity, p, seed))
        np.random.default_rng([seed, p, 1]).shuffle(labels)
        at = 0
        for batch in batches:
            block = labels[at: at + batch.num_rows]
            draw = mix(mix(np.arange(at, at + batch.num_rows, dtype=np.uint64) + np.uint64(p << 40)) ^ np.uint64(seed))
            at += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(block), pa.array(starts[block]), pa.array(draw.view(np.int64))],
                [*names, "_block", "_start", "_draw"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    dealt = rows.mapInArrow(deal, f"{schema}, _block long, _start long, _draw long")
    order = Window.partitionBy("_block").orderBy("_draw")
    return dealt.select(
        *names, F.floor(F.col("_block") / per_shard).cast("int").alias("shard"),
        (F.col("_start") + F.row_number().over(order) - F.lit(1)).cast("long").alias("slot"),
    )


def shard_documents(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 42,
                    stored: bool = False) -> DataFrame:
    """Shard and slot of every document, with its ``size`` (UTF-8 bytes of the
    text, none for null, plus 1) and ``text_crc32`` (0 for null)."""
    text = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")
    return shard_rows(docs, {
        "doc_id": F.col(id_col).cast("long"),
        "size": (F.octet_length(text) + F.lit(1)).cast("long"),
        "text_crc32": F.crc32(text).cast("long"),
    }, n_shards, seed, stored)
