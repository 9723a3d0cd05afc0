"""Packing documents into windows by non-negative least squares.

Documents are encoded and cut into pieces of at most one window. Lengths are
rounded up to classes of ``QUANTUM`` ids. Every combination of at most three
classes that fills a window exactly is enumerated; the repeat counts that best
reproduce the histogram of classes are solved as non-negative least squares,
rounded, and what the histogram has left is packed greedily, largest class
first. The plan depends on the histogram alone (one row per class), so its size
does not grow with the input. Each piece then finds its window from its number
within its class.

Defined results. A null or empty text is the end id alone. Null ids and
repeated rows are packed one by one. An empty table gives an empty result.
Further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .encode import ENCODE_BYTES, encoder, ship_tokenizer
from .shared import numbered
from .text import chunks

WINDOW = 2048
QUANTUM = 16


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """``x >= 0`` that minimises ``|a x - b|`` (active set method)."""
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], bool)
    tol = 1e-9 * max(1.0, float(np.abs(b).max(initial=0.0)))
    for _ in range(rounds):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        best = int(gain.argmax())
        if gain[best] <= tol:
            break
        active[best] = True
        while True:
            at = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[at] = z
                break
            low = z <= 0
            step = (x[at][low] / np.maximum(x[at][low] - z[low], 1e-300)).min()
            moved = x[at] + step * (z - x[at])
            moved[low & (moved <= tol)] = 0
            x[:] = 0
            x[at] = np.maximum(moved, 0)
            still = x > 0
            if (still == active).all():
                break
            active = still
    return x


def plan(histogram: np.ndarray, depth: int = 3) -> list[tuple[tuple[int, ...], int]]:
    """``(classes, repeats)`` that use up ``histogram`` (count per class
    ``1 .. n``; ``histogram[0]`` is unused). Classes of a window sum to at most ``n``."""
    n = len(histogram) - 1
    left = np.array(histogram, np.int64)
    combos = [(n,)]
    if depth > 1:
        combos += [(a, n - a) for a in range(n - 1, (n - 1) // 2, -1) if n - a <= a]
    if depth > 2:
        combos += [(a, b, n - a - b) for a in range(n - 2, 0, -1) for b in range(min(a, n - a - 1), 0, -1) if n - a - b <= b]
    matrix = np.zeros((n, len(combos)))
    for j, c in enumerate(combos):
        for k in c:
            matrix[k - 1, j] += 1
    x = nnls(matrix, left[1:].astype(float))
    out = []

    def use(combo: tuple[int, ...], most: int | None = None) -> None:
        need = np.bincount(combo, minlength=n + 1)
        repeats = int((left[need > 0] // need[need > 0]).min())
        repeats = repeats if most is None else min(most, repeats)
        if repeats > 0:
            out.append((combo, repeats))
            left[:] -= repeats * need

    for j in np.argsort(-x, kind="stable"):
        use(combos[j], int(round(x[j])))
    while left.any():
        combo, room = [], n
        spare = left.copy()
        while room and spare[1: room + 1].any():
            c = int(np.flatnonzero(spare[: room + 1])[-1])
            combo.append(c)
            spare[c] -= 1
            room -= c
        use(tuple(combo))
    return out


def _piece_batches(path: str, end_id: int, window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(1), ENCODE_BYTES):
                flat, row = enc.encode(data, offsets)
                ids = np.insert(flat, row[1:], end_id).astype("<u4")
                length = np.diff(row) + 1
                first = np.cumsum(length) - length
                pieces = -(-length // window)
                doc = np.repeat(np.arange(hi - lo), pieces)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * window
                size = np.minimum(window, length[doc] - start)
                at = first[doc] + start
                crc = [zlib.crc32(ids[a: a + n]) for a, n in zip(at.tolist(), size.tolist())]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo).take(pa.array(doc)), pa.array(start), pa.array(size),
                    pa.array(crc, pa.int64()), pa.array(length[doc]),
                ], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return work


def token_pieces(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = 1, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Pieces of at most ``window`` ids: ``doc_id, start, length, ids_crc32,
    doc_tokens``, in order and without gaps for every document."""
    ship_tokenizer(docs.sparkSession, tokenizer)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_piece_batches(tokenizer, end_id, window),
                           "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def pack_pieces(pieces: DataFrame, window: int = WINDOW, quantum: int = QUANTUM) -> DataFrame:
    """``pieces`` (columns ``doc_id, start, length, ids_crc32, doc_tokens``; any
    cut) with ``sequence_id`` and ``offset`` (gapless from 0 in each sequence)."""
    n = window // quantum
    pieces = materialize(pieces.withColumn("cls", F.ceil(F.col("length") / F.lit(quantum)).cast("int")))
    histogram = np.zeros(n + 1, np.int64)
    for r in pieces.groupBy("cls").count().collect():  # at most window / quantum rows
        histogram[r[0]] = r[1]
    combos = plan(histogram)
    slots: dict[int, list[list[int]]] = {}
    sequence = 0
    for combo, repeats in combos:
        for c in set(combo):
            rows = slots.setdefault(c, [])
            before = rows[-1][0] + rows[-1][1] * rows[-1][2] if rows else 0
            rows.append([before, combo.count(c), repeats, sequence])
        sequence += repeats
    tables = {c: np.array(rows, np.int64) for c, rows in slots.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, j = batch.column(5).to_numpy(), batch.column(6).to_numpy()
            seq, turn = np.empty(len(j), np.int64), np.empty(len(j), np.int64)
            for c in np.unique(cls).tolist():
                mine, t = cls == c, tables[c]
                k = np.searchsorted(t[:, 0], j[mine], "right") - 1
                within = j[mine] - t[k, 0]
                seq[mine] = t[k, 3] + within // t[k, 1]
                turn[mine] = within % t[k, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(seq), pa.array(-cls.astype(np.int64)), pa.array(turn)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "big", "turn"])

    counted = numbered(pieces, ["cls"], ["doc_id", "start", "ids_crc32"], "j")
    placed = counted.mapInArrow(
        place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, big long, turn long")
    before = Window.partitionBy("sequence_id").orderBy("big", "turn").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("big", "turn")


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, end_id: int = 1, quantum: int = QUANTUM,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their place in the packed sequences."""
    return pack_pieces(token_pieces(docs, tokenizer, window, end_id, id_col, text_col), window, quantum)
