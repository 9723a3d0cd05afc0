"""Near-duplicate documents by one-permutation MinHash.

A document is the set of its distinct k-word shingles (five words unless told
otherwise). One hash of a shingle picks a bin and a value; the smallest value
of each bin is the signature, and an empty bin copies the bin that its own
probe sequence reaches first (optimal densification). Bands of the signature
are bucket keys. Within a bucket only star-shaped
pairs are compared: every member with the centre. Pairs are confirmed on the
full shingle sets.

Stars alone can miss a link between two members of which neither is a centre.
So buckets whose other members still lie in several components are settled
exactly: their members are dealt into blocks of like set size, every two blocks
of a bucket whose sizes allow a link form a tile, and a task computes all
similarities of a tile as a matrix product on the full sets. A tile hands on only
a spanning forest of its links, so no group writes out its pairs.

Defined results. Null or blank text: empty set, linked with nothing. Fewer than
k words: the whole word sequence is the one shingle. Rows with a null id keep a
null component and stay. Rows that repeat an id with the same words are one
document; with other words, their links are joined under that id. An empty
table gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checked_broadcast, materialize
from .shared import attach_groups, by_position
from .text import chunks, mix, word_hashes

# Signature: BANDS x ROWS bins. At similarity 0.8 a pair shares no band with
# probability (1 - 0.8 ** 4) ** 24, about 3e-6.
BANDS = 24
ROWS = 4
# Documents and shingles of a block (about), and shingles of a matrix slice, when
# buckets are settled.
BLOCK_DOCS = 256
BLOCK_SHINGLES = 1 << 19
SLICE = 8192
# Bytes of text that a task cuts into shingles at once: some ten times as much memory.
TEXT_BYTES = 1 << 18
# Stored bytes of the ids up to which they, not the texts, are sent to find the texts.
FEW_IDS = 4 << 20

_U = np.uint64


def shingle_sets(hashes: np.ndarray, before: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of every distinct shingle, sorted by both."""
    count = np.diff(before)
    row = np.repeat(np.arange(len(count)), np.maximum(count - k + 1, (count > 0).astype(count.dtype)))
    first = np.repeat(before[:-1], np.maximum(count - k + 1, (count > 0).astype(count.dtype)))
    within = np.arange(len(row)) - np.searchsorted(row, row)
    at = first + within
    length = np.minimum(k, count[row]) if len(row) else np.empty(0, np.int64)
    out = mix(length.astype(_U) + _U(0x51ED2701))
    for j in range(k):
        inside = j < length
        out[inside] = mix(out[inside] * _U(0xD6E8FEB86659FD93) + hashes[at[inside] + j])
    order = np.lexsort((out, row))
    row, out = row[order], out[order]
    if len(row):
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (out[1:] != out[:-1])
        row, out = row[new], out[new]
    return row, out


def signatures(row: np.ndarray, shingles: np.ndarray, n_rows: int, bins: int) -> np.ndarray:
    """``n_rows x bins`` smallest hash of each bin, densified; rows without
    shingles stay 0. Sorted shingles make the first of a bin its smallest."""
    out = np.zeros((n_rows, bins), _U)
    have = np.zeros((n_rows, bins), bool)
    if not len(row):
        return out
    b = (((shingles >> _U(32)) * _U(bins)) >> _U(32)).astype(np.int64)
    cell = row * bins + b
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    out.ravel()[cell[first]] = shingles[first]
    have.ravel()[cell[first]] = True
    r, c = np.nonzero(~have & have.any(axis=1)[:, None])
    attempt = 0
    while len(r):
        attempt += 1
        probe = (mix(np.arange(bins, dtype=_U) * _U(0x9E3779B1) + _U(attempt << 32)) % _U(bins)).astype(np.int64)[c]
        hit = have[r, probe]
        out[r[hit], c[hit]] = out[r[hit], probe[hit]]
        r, c = r[~hit], c[~hit]
    return out


def _signature_batches(k: int, bands: int, rows: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, hi, data, offsets in chunks(texts, TEXT_BYTES):
                row, sh = shingle_sets(*word_hashes(data, offsets), k)
                n = np.bincount(row, minlength=hi - lo)
                edges = np.concatenate([[0], np.cumsum(n)])
                sums = [np.concatenate([[_U(0)], np.cumsum(mix(sh + _U(s)), dtype=_U)]) for s in (1, 2)]
                digest = [(c[edges[1:]] - c[edges[:-1]]).view(np.int64) for c in sums]
                sig = signatures(row, sh, hi - lo, bands * rows).reshape(hi - lo, bands, rows)
                key = np.broadcast_to(mix(np.arange(bands, dtype=_U)), sig.shape[:2]).copy()
                for j in range(rows):
                    key = mix(key * _U(0xD6E8FEB86659FD93) + sig[:, :, j])
                flat = pa.array(key.view(np.int64).ravel())
                bands_col = pa.ListArray.from_arrays(pa.array(np.arange(hi - lo + 1, dtype=np.int32) * bands), flat)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(lo, hi - lo), pa.array(n.astype(np.int64)), *map(pa.array, digest), bands_col],
                    ["id", "n", "d1", "d2", "bands"],
                )

    return work


def _set_batches(k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for lo, hi, data, offsets in chunks(texts, TEXT_BYTES):
                row, sh = shingle_sets(*word_hashes(data, offsets), k)
                edges = np.searchsorted(row, np.arange(hi - lo + 1)) * 8
                sets = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), hi - lo, [None, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(sh)]
                )
                yield pa.RecordBatch.from_arrays([ids.slice(lo, hi - lo), sets.cast(pa.binary())], ["id", "shingles"])

    return work


def _confirm_batches(percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                a, b = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                if len(a) > len(b):
                    a, b = b, a
                at = np.searchsorted(b, a)
                both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return work


def shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sorted sets, as matrix products over
    slices of the shingles that both sides have."""
    out = np.zeros((len(a), len(b)), np.float32)
    flat_a, flat_b = np.concatenate(a), np.concatenate(b)
    row_a, row_b = (np.repeat(np.arange(len(x)), [len(s) for s in x]) for x in (a, b))
    both = np.intersect1d(flat_a, flat_b)
    in_a, in_b = np.isin(flat_a, both), np.isin(flat_b, both)
    row_a, row_b = row_a[in_a], row_b[in_b]
    col_a, col_b = np.searchsorted(both, flat_a[in_a]), np.searchsorted(both, flat_b[in_b])
    for lo in range(0, len(both), SLICE):
        width = min(SLICE, len(both) - lo)
        dense = []
        for n, row, col in ((len(a), row_a, col_a), (len(b), row_b, col_b)):
            m = np.zeros((n, width), np.float32)
            mine = (col >= lo) & (col < lo + width)
            m[row[mine], col[mine] - lo] = 1
            dense.append(m)
        out += dense[0] @ dense[1].T
    return out


def _forest(linked: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Smallest node index reached from each node, starting from labels ``first``."""
    label = first
    while True:
        low = np.minimum(label, np.where(linked, label[None, :], len(label)).min(axis=1, initial=len(label)))
        low = np.minimum(low, low[low])
        if (low == label).all():
            return label
        label = low


def _tile_batches(percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile in batch.to_pylist():
                ids = np.array(tile["ids_a"] + ([] if tile["same"] else tile["ids_b"]))
                comp = np.array(tile["comps_a"] + ([] if tile["same"] else tile["comps_b"]))
                if comp.min() == comp.max():
                    continue
                a = [np.frombuffer(s, _U) for s in tile["sets_a"]]
                b = a if tile["same"] else [np.frombuffer(s, _U) for s in tile["sets_b"]]
                both = shared_counts(a, b)
                na, nb = (np.array([len(s) for s in x]) for x in (a, b))
                close = 100 * both >= percent * (na[:, None] + nb[None, :] - both)
                n = len(ids)
                linked = np.zeros((n, n), bool)
                if tile["same"]:
                    linked[:] = close
                else:
                    linked[: len(a), len(a):] = close
                    linked[len(a):, : len(a)] = close.T
                linked &= comp[:, None] != comp[None, :]
                first = np.unique(comp, return_index=True)[1][np.unique(comp, return_inverse=True)[1]]
                linked[np.arange(n), first] = linked[first, np.arange(n)] = True  # known components
                label = _forest(linked, np.arange(n))
                new = np.flatnonzero(comp[label] != comp)
                if len(new):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[label[new]]), pa.array(ids[new])], ["a", "b"])

    return work


def components(links: DataFrame) -> DataFrame:
    """``id, component``: for every end of a link (columns ``a, b``) the
    smallest id it is connected with. Alternates the two star contractions;
    each half step is written to the shared folder, which also cuts the plan."""
    edges = materialize(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(),
        few=True,
    )
    while True:
        before = _fingerprint(edges)
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), few=True)
        large = both.alias("e").join(low.alias("l"), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(large.where("u <> v").distinct(), few=True)
        low = materialize(edges.groupBy("u").agg(F.min("v").alias("m")), few=True)
        small = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v")))
        edges = materialize(small.where("u <> v").distinct(), few=True)
        if _fingerprint(edges) == before:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))


def _fingerprint(edges: DataFrame) -> tuple:
    h = F.xxhash64("u", "v")
    r = edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(h, 24)), F.sum(h.bitwiseAND(F.lit(0xFFFFFF)))).first()
    return tuple(r)


def _shingle_table(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """Stored shingle sets of the documents named in ``ids`` (a stored table).
    While these are few they are broadcast, and no text is shuffled or sorted."""
    few = checked_broadcast(ids, FEW_IDS)
    wanted = docs.join(few if few is not ids else ids.hint("merge"), "id", "left_semi")
    return materialize(wanted.mapInArrow(_set_batches(k), "id long, shingles binary").dropDuplicates(["id", "shingles"]))


def _compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (columns ``a, b``) whose full sets are similar enough."""
    half = pairs.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    full = half.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a").select("a", "b", "sa", "sb")
    return materialize(full.mapInArrow(_confirm_batches(percent), "a long, b long"))


def _settle(open_members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a spanning forest per tile) between components that meet in a
    bucket. ``open_members``: stored ``band, key, id, comp, n`` (set size).
    Set sizes fall into classes, each a factor of 100 / ``percent`` wide (and a
    hair, for rounding), so that only equal and adjacent classes can hold links."""
    width = math.log(100.0 / percent * (1 + 1e-7))
    classed = open_members.withColumn("cls", F.floor(F.log(F.col("n").cast("double")) / F.lit(width)))
    dealt = materialize(classed.groupBy("band", "key", "cls").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_DOCS)), F.ceil(F.sum("n") / F.lit(BLOCK_SHINGLES))).alias("blocks")), few=True)
    blocks = materialize(
        classed.join(dealt, ["band", "key", "cls"]).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
        .join(sets, "id").groupBy("band", "key", "cls", "block")
        .agg(F.collect_list("id").alias("ids"), F.collect_list("comp").alias("comps"), F.collect_list("shingles").alias("sets"),
             F.min("comp").alias("lo"), F.max("comp").alias("hi")),
        few=True,
    )

    def side(name: str) -> DataFrame:
        return blocks.select("band", "key", *[F.col(c).alias(f"{c}_{name}") for c in ("cls", "block", "ids", "comps", "sets", "lo", "hi")])

    same_class = F.col("cls_a") == F.col("cls")
    several = (F.least("lo_a", "lo_b") < F.greatest("hi_a", "hi_b")) & (~same_class | (F.col("block_a") <= F.col("block_b")))
    left = side("a").withColumn("cls", F.explode(F.array(F.col("cls_a"), F.col("cls_a") + 1)))
    tiles = left.join(side("b").withColumnRenamed("cls_b", "cls"), ["band", "key", "cls"]).where(several).select(
        (same_class & (F.col("block_a") == F.col("block_b"))).alias("same"), "ids_a", "comps_a", "sets_a", "ids_b", "comps_b", "sets_b")
    return materialize(tiles.mapInArrow(_tile_batches(percent), "a long, b long"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80,
    bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.
    Documents are linked when ``100 * |A & B| >= percent * |A | B|``; a
    component is what links reach, named by its smallest id, which is kept."""
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    sig = materialize(docs.mapInArrow(
        _signature_batches(k, bands, rows), "id long, n long, d1 long, d2 long, bands array<long>"))
    # equal sets first: one representative (the smallest id) of each goes on
    own = materialize(attach_groups(
        sig.select("id", "n", "d1", "d2"), ["n", "d1", "d2"], {"rep": F.min("id")}
    ).select("id", "n", F.when((F.col("n") > 0) & F.col("rep").isNotNull(), F.col("rep")).otherwise(F.col("id")).alias("rep")), few=True)
    reps = own.where((F.col("n") > 0) & (F.col("id") == F.col("rep"))).select("id").distinct()
    members = materialize(sig.where("n > 0").join(reps, "id", "left_semi").select("id", "n", "bands"), few=True).select(
        "id", "n", F.posexplode("bands").alias("band", "key"))
    crowded = materialize(
        members.groupBy("band", "key").agg(F.min("id").alias("centre"), F.max("id").alias("last"))
        .where("centre < last").select("band", "key", "centre"),
        few=True,
    )
    members = materialize(members.join(crowded, ["band", "key"]), few=True)
    sets = _shingle_table(docs, materialize(members.select("id").distinct(), few=True), k)
    centres = members.where("id = centre").select("band", "key", "centre", F.col("n").alias("cn"))
    near = F.least("n", "cn") * 100 >= F.greatest("n", "cn") * percent  # else the sizes alone forbid it
    pairs = materialize(
        members.where("id <> centre").join(centres, ["band", "key", "centre"]).where(near)
        .select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct(),
        few=True,
    )
    links = _compare(pairs, sets, percent)
    found = materialize(components(links), few=True)
    others = materialize(
        members.where("id <> centre").alias("m").join(found.alias("f"), "id", "left")
        .select("m.band", "m.key", "m.id", "m.n", F.coalesce("f.component", "m.id").alias("comp")),
        few=True,
    )
    mixed = materialize(
        others.groupBy("band", "key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
        .where("lo < hi").select("band", "key"),
        few=True,
    )
    open_members = materialize(others.join(mixed, ["band", "key"]), few=True)
    more = _settle(open_members, sets, percent)
    if not more.isEmpty():
        found = materialize(components(links.union(more)), few=True)
    return own.join(found.withColumnRenamed("id", "rep"), "rep", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.coalesce("component", "rep").alias("component_id"),
        F.coalesce(F.coalesce("component", "rep") == F.col("id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` (same columns) without near duplicates: of each
    component the document with the smallest id stays. Further columns may have
    any name."""
    found = near_duplicates(docs, id_col, text_col, **options)
    gone = found.where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    own, names = by_position(docs)
    id_at = names[docs.columns.index(id_col)]
    return own.join(gone, F.col(id_at) == F.col("_gone"), "left_anti").toDF(*docs.columns)
