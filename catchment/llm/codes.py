"""Vector codes: product codebooks whose nearest entries are found by slices.

A vector becomes integers, ``floor(4096 * x)``, and is cut into equal parts; each
part position has a codebook of a few entries, and a vector's code names the
nearest entry of each part. For every dimension of a codebook the entries'
coordinates are sorted, and every prefix of that order carries the mask of its
entries (64 entries to a word). A part's initial radius is its distance to one
entry, found by a search in the widest dimension. In each dimension, the entries
within the radius are a range of the sorted coordinates: the difference of two
prefix masks. The AND of all dimensions' masks leaves few candidates, the
nearest entry surely among them, and only these are measured.

Training: a codebook starts as the parts of the first vectors by id. In each round
every task sums its parts by nearest entry, sums of a bounded number of cells
(parts x entries x width) join the tasks, and each entry moves to the floor of
its mean; an entry that no part chose stays. All arithmetic is in integers, so
neither the order of rows nor the number of tasks changes a result.

Defined results. Rows whose vector is null or holds null or non-finite components
are dropped; null ids stay and come after all others. Vectors of each length have
codebooks of their own, and lengths that the parts don't divide are filled up
with zeros (an empty vector has error 0). Rows that repeat an id are vectors as
any others; of equal ids, the smaller components come first. With fewer vectors
than entries, the codebooks are as small. Equal distances go to the lower entry.
Components stop at about +-2 ** 31 / sqrt(length) / 2 (2 ** 27 of 64, which is
|x| = 32,768), where squared distances would leave 64 bits; a sum of errors
beyond 64 bits is null. An empty table gives an empty result. Further columns
are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .shared import attach_groups

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
# Components that are worked on at once.
BLOCK_CELLS = 1 << 20

_U = np.uint64

Books = dict[int, np.ndarray]  # vector length -> parts x entries x width


def finite(vec: Column) -> Column:
    """Not null, and every component finite and not null."""
    fine = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(fine, F.lit(False))


def most(length: int) -> int:
    """Where the components of a vector stop."""
    return min(math.isqrt((1 << 62) // max(length, 1)) // 2, (1 << 31) - 1)


def _integers(parts: int):
    """Batches of (id, label, vector of doubles) to (id, label, length, integers
    filled up to whole parts)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column(2)
            flat = np.asarray(vec.flatten().to_numpy(zero_copy_only=False), np.float64)
            size = vec.value_lengths().to_numpy().astype(np.int64)
            stop = np.array([most(n) for n in np.unique(size)])[np.unique(size, return_inverse=True)[1]] if len(size) else size
            x = np.clip(np.floor(flat * SCALE), -np.repeat(stop, size), np.repeat(stop, size)).astype(np.int32)
            wide = -(-size // parts) * parts
            edge = np.concatenate([[0], np.cumsum(wide)])
            out = np.zeros(edge[-1], np.int32)
            out[np.repeat(edge[:-1] - (np.cumsum(size) - size), size) + np.arange(len(x))] = x
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(size), pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), pa.array(out))],
                ["id", "label", "size", "x"])

    return work


def _blocks(batch: pa.RecordBatch, size_at: int, vec_at: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(length, rows, integers of these rows)``: vectors of one length, few at once."""
    vec = batch.column(vec_at)
    flat = vec.flatten().to_numpy(zero_copy_only=False)
    wide = vec.value_lengths().to_numpy().astype(np.int64)
    first = np.cumsum(wide) - wide
    size = batch.column(size_at).to_numpy()
    for n in np.unique(size).tolist():
        rows = np.flatnonzero(size == n)
        step = max(1, BLOCK_CELLS // max(1, n))
        for a in range(0, len(rows), step):
            at = rows[a: a + step]
            yield n, at, flat[first[at][:, None] + np.arange(wide[at[0]])].astype(np.int64)


class Slices:
    """Nearest entries of one codebook (entries x width integers)."""

    def __init__(self, book: np.ndarray):
        self.book = book
        n, width = book.shape
        order = np.argsort(book, axis=0, kind="stable")
        self.sorted = np.take_along_axis(book, order, axis=0)
        self.masks = np.zeros((width, n + 1, -(-n // 64)), _U)  # of the first i entries of a dimension
        for d in range(width):
            for i, e in enumerate(order[:, d].tolist()):
                self.masks[d, i + 1] = self.masks[d, i]
                self.masks[d, i + 1, e // 64] |= _U(1 << e % 64)
        self.widest = int(np.argmax(self.sorted[-1] - self.sorted[0])) if width else 0
        self.order = order

    def candidates(self, x: np.ndarray) -> np.ndarray:
        """Per row a mask of entries that has all nearest ones."""
        d = self.widest
        near = np.minimum(np.searchsorted(self.sorted[:, d], x[:, d]), len(self.book) - 1)
        first = self.book[self.order[near, d]]
        radius = np.sqrt(((x - first) ** 2).sum(axis=1).astype(np.float64)).astype(np.int64) + 1  # rounding stays below 1
        found = np.full((len(x), self.masks.shape[2]), ~_U(0))
        for d in range(x.shape[1]):
            lo = np.searchsorted(self.sorted[:, d], x[:, d] - radius, "left")
            hi = np.searchsorted(self.sorted[:, d], x[:, d] + radius, "right")
            found &= self.masks[d, hi] & ~self.masks[d, lo]
        return found

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry and squared distance of every row; ties to the lower entry."""
        at, best = np.zeros(len(x), np.int64), np.full(len(x), -1, np.int64)
        if not x.shape[1]:
            return at, np.zeros(len(x), np.int64)
        found = self.candidates(x)
        for e in range(len(self.book)):
            rows = np.flatnonzero(found[:, e // 64] & _U(1 << e % 64))
            if len(rows):
                far = ((x[rows] - self.book[e]) ** 2).sum(axis=1)
                better = (best[rows] < 0) | (far < best[rows])
                at[rows[better]], best[rows[better]] = e, far[better]
        return at, best


def _slices(books: Books) -> dict[int, list[Slices]]:
    return {n: [Slices(b) for b in book] for n, book in books.items()}


def _sum_batches(books: Books):
    """A task's sums of the parts by nearest entry: one row per length, part,
    entry and position, and one of position -1 with their number."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = _slices(books)
        total = {n: np.zeros((*b.shape[:2], b.shape[2] + 1), np.int64) for n, b in books.items()}
        for batch in batches:
            for n, _, x in _blocks(batch, 0, 1):
                parts, entries, width = books[n].shape
                for p in range(parts):
                    part = x[:, p * width: (p + 1) * width]
                    at, _ = slices[n][p].nearest(part)
                    order = np.argsort(at, kind="stable")
                    edge = np.searchsorted(at[order], np.arange(entries))
                    count = np.bincount(at, minlength=entries)
                    run = np.concatenate([np.zeros((1, width), np.int64), np.cumsum(part[order], axis=0)])
                    total[n][p, :, :width] += run[edge + count] - run[edge]
                    total[n][p, :, width] += count
        for n, t in total.items():
            used = np.argwhere(np.repeat(t[:, :, -1:] > 0, t.shape[2], axis=2))
            if len(used):
                p, e, i = used.T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(used), n)), pa.array(p), pa.array(e), pa.array(i), pa.array(t[p, e, i])],
                    ["size", "part", "entry", "place", "total"])

    return work


def _code_batches(books: Books):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = _slices(books)
        for batch in batches:
            error = np.zeros(batch.num_rows, np.int64)
            codes: list = [b""] * batch.num_rows
            for n, rows, x in _blocks(batch, 2, 3):
                parts, entries, width = books[n].shape
                named = np.zeros((len(rows), parts), np.uint8 if entries <= 256 else ">u2")
                for p in range(parts):
                    at, far = slices[n][p].nearest(x[:, p * width: (p + 1) * width])
                    named[:, p] = at
                    error[rows] += far
                for r, code in zip(rows.tolist(), named):
                    codes[r] = code.tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(codes, pa.binary()), pa.array(error)],
                ["id", "label", "size", "code", "error"])

    return work


def integer_vectors(vectors: DataFrame, parts: int = PARTS, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """``id, label, size, x`` of the usable vectors, stored."""
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("v"),
    ).where(finite(F.col("v")))
    kind = rows.schema["label"].dataType.simpleString()
    return materialize(rows.mapInArrow(_integers(parts), f"id long, label {kind}, size long, x array<int>"))


def train_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Books:
    """Codebooks of ``integer_vectors`` rows, by vector length. What comes to the
    driver is as large as the codebooks."""
    books: Books = {}
    for (size,) in rows.select("size").distinct().orderBy("size").collect():  # one number per length
        first = rows.where(F.col("size") == size).orderBy(F.col("id").asc_nulls_last(), "x").select("x").limit(entries).collect()
        x = np.array([r.x for r in first], np.int64).reshape(len(first), parts, -1)
        books[size] = np.ascontiguousarray(x.transpose(1, 0, 2))
    for _ in range(rounds if books else 0):
        sums = rows.select("size", "x").mapInArrow(_sum_batches(books), "size long, part long, entry long, place long, total long")
        whole = sums.groupBy("size", "part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
        total = {tuple(r[:4]): int(r.total) for r in whole}
        books = {n: b.copy() for n, b in books.items()}
        for (n, p, e, i), t in total.items():
            width = books[n].shape[2]
            if i < width:
                books[n][p, e, i] = t // total[n, p, e, width]
    return books


def encode(rows: DataFrame, books: Books) -> DataFrame:
    """``id, label, size, code, error`` of ``integer_vectors`` rows: a byte per
    part (two with more than 256 entries), and the squared distances summed over
    the parts."""
    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(_code_batches(books), f"id long, label {kind}, size long, code binary, error long")


def decode(code: bytes, book: np.ndarray) -> np.ndarray:
    """The integers that a code stands for."""
    at = np.frombuffer(code, np.uint8 if book.shape[1] <= 256 else ">u2")
    return book[np.arange(len(book)), at].ravel()


def book_digest(book: np.ndarray) -> str:
    """SHA-256 of the components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def compress_vectors(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id",
                     vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per usable vector: ``vec_id, code`` (hex), ``error,
    label_error`` (over equal labels, nulls together), ``codebooks_sha256`` (of
    the vector's length)."""
    rows = integer_vectors(vectors, parts, id_col, vector_col, label_col)
    books = train_codebooks(rows, parts, entries, rounds)
    coded = materialize(encode(rows, books))
    met = attach_groups(coded, ["label"], {"sum": F.try_sum("error")})
    digest = F.lit("")
    for n, book in books.items():
        digest = F.when(F.col("size") == n, F.lit(book_digest(book))).otherwise(digest)
    return met.select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error",
        F.when(F.col("_n") == 1, F.col("error")).otherwise(F.col("sum")).alias("label_error"), digest.alias("codebooks_sha256"))
