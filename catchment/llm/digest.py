"""Document fingerprints: digests of improbable features in chained Bloom filters.

Every window of ``WINDOW`` bytes of a text is a possible feature. Its entropy
falls into one of ``BINS`` bins, and the corpus tells how often each bin occurs:
the rarer the bin, the lower its rank (windows that are nearly uniform rank last,
as runs and rules say little). Every run of ``RUN`` windows votes for its leftmost
window of lowest rank; windows with ``POPULAR`` votes or more are the features, so
that the choice depends on nearby bytes only and survives edits elsewhere. Each
distinct feature sets ``BITS`` bits of a Bloom filter; a filter takes
``PER_FILTER`` features, then the next one of the chain begins. Two digests are
alike to the mean, over the filters of the shorter chain (weighed by features),
of the best normalised overlap with a filter of the other: 0 for the bits that
chance would share, 1 for all that could be shared.

``neighbour_digests`` works along the documents in order of their ids: each
document meets the next one, in tasks that hold a range of ids. Ranges begin at
documents of a sample weighed by bytes (which sets only where ranges begin, so
that no task gets far more than others, whatever ids repeat); the document that
begins a range also goes to the end of the range before it, and the first of all
to the last range. Text moves once, and one pair of documents is held at a time.

Defined results. Null text counts as empty; the fingerprint of an empty text is
``0:``. A text shorter than a window is one feature as a whole; one shorter than
a run of windows gives the window that the whole run votes for. If no window has
votes enough, the first with most votes is taken. Two empty texts are alike to 1,
an empty one and another to 0. Null ids come first; rows that repeat an id are
ordered by a hash of their text, and rows alike in both by their place. A single
document is its own next one. An empty table gives an empty result. Further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .text import chunks, mix

# Bytes of a window (a multiple of 8), windows of a run, votes of a feature.
WINDOW = 16
RUN = 32
POPULAR = 8
BINS = 1000
# Windows below this share of the greatest entropy rank last.
LOW = 0.2
# Bits of a filter, bits of a feature, features of a filter.
FILTER = 2048
BITS = 5
PER_FILTER = 128
# Bytes of text of a range of ids (about), documents of the sample per range, and
# most ranges (a larger corpus has larger ones; their keys go to every task).
RANGE_BYTES = 64 << 20
SAMPLED = 16
MOST_RANGES = 1 << 16

_U = np.uint64
# c * log2(c) in fixed point, what it gains when a byte occurs for the c-th time
_COUNTED = np.zeros(WINDOW + 1, np.int32)
_COUNTED[2:] = np.rint(np.arange(2, WINDOW + 1) * np.log2(np.arange(2, WINDOW + 1)) * (1 << 20))
_GAIN = np.diff(_COUNTED, prepend=0).astype(np.int32)
_FULL = int(_COUNTED[WINDOW])
# Windows that are worked on at once, so that they stay in a core's cache.
_BLOCK = 1 << 16


def _bins(part: np.ndarray) -> np.ndarray:
    """The entropy bin of every window of ``part``, from how often its bytes
    occur in it: one comparison of the whole array per lag counts, for every
    byte, its equals in the window that it enters and in the one that it leaves."""
    before, after = np.ones(len(part), np.uint8), np.ones(len(part), np.uint8)
    for lag in range(1, WINDOW):
        same = (part[lag:] == part[:-lag]).view(np.uint8)
        before[lag:] += same
        after[:-lag] += same
    held = np.empty(len(part) - WINDOW + 1, np.int32)  # sum of c * log2(c) over the bytes of a window
    held[0] = _GAIN[before[:WINDOW]].sum()
    np.subtract(_GAIN[before[WINDOW:]], _GAIN[after[:-WINDOW]], out=held[1:])
    np.cumsum(held, out=held)
    return np.minimum((_FULL - held) // (_FULL // BINS), BINS - 1)


def entropy_bins(data: np.ndarray) -> np.ndarray:
    """The entropy bin of every window of ``data`` (``len - WINDOW + 1``)."""
    n = max(len(data) - WINDOW + 1, 0)
    out = np.empty(n, np.int32)
    for a in range(0, n, _BLOCK):
        b = min(a + _BLOCK, n)
        out[a:b] = _bins(data[a: b + WINDOW - 1])
    return out


def _inside(offsets: np.ndarray, n: int, width: int) -> np.ndarray:
    """Whether each of the first ``n`` spans of ``width`` bytes lies within one row."""
    edge = np.clip(offsets[1:-1], 0, n)
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, np.clip(offsets[1:-1] - width + 1, 0, n), 1)
    np.add.at(step, edge, -1)
    return np.cumsum(step[:n]) == 0


def votes(data: np.ndarray, offsets: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For every window the runs of ``RUN`` windows of its row in which it is the
    leftmost of lowest rank."""
    bins = entropy_bins(data)
    n = len(bins)
    out = np.zeros(n, np.int64)
    good = _inside(offsets, max(n - RUN + 1, 0), WINDOW + RUN - 1)
    for a in range(0, len(good), _BLOCK):
        b = min(a + _BLOCK, len(good))
        least = rank[bins[a: b + RUN - 1]] << 17 | np.arange(b + RUN - 1 - a, dtype=np.int32)
        width = 1
        while width < RUN:  # the least of runs of twice the width
            more = min(width, RUN - width)
            least = np.minimum(least[:-more], least[more:])
            width += more
        out[a: b + RUN - 1] += np.bincount((least & ((1 << 17) - 1))[good[a:b]], minlength=b + RUN - 1 - a)
    return out


def _histogram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BINS, np.int64)
    for batch in batches:
        for _, _, data, offsets in chunks(batch.column(0)):
            bins = entropy_bins(data)
            total += np.bincount(bins[_inside(offsets, len(bins), WINDOW)], minlength=BINS)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(BINS)), pa.array(total)], ["bin", "n"])


def ranks(histogram: np.ndarray) -> np.ndarray:
    """The rank of every bin: rarer bins first, nearly uniform ones last."""
    low = np.arange(BINS) < LOW * BINS
    out = np.empty(BINS, np.int32)
    out[np.lexsort((np.arange(BINS), histogram, low))] = np.arange(BINS)
    return out


def corpus_ranks(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """``ranks`` from all windows of all texts."""
    counted = docs.select(F.col(text_col).alias("text")).mapInArrow(_histogram_batches, "bin long, n long")
    histogram = np.zeros(BINS, np.int64)
    for b, n in counted.groupBy("bin").agg(F.sum("n")).collect():  # BINS rows
        histogram[b] = n
    return ranks(histogram)


def features(data: np.ndarray, offsets: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct features of every row, in order."""
    size = np.diff(offsets)
    windows = np.maximum(size - WINDOW + 1, 0)
    vote = votes(data, offsets, rank)
    start = np.flatnonzero(vote >= POPULAR)
    row = np.searchsorted(offsets, start, "right") - 1
    chosen = np.bincount(row, minlength=len(size)) > 0
    few = []  # rows without a popular window
    for r in np.flatnonzero(~chosen & (size > 0)).tolist():
        a, n = int(offsets[r]), int(windows[r])
        if n >= RUN:
            few.append(a + int(np.argmax(vote[a: a + n])))
        elif n:
            few.append(a + int(np.argmin(rank[entropy_bins(data[a: a + int(size[r])])])))
        else:
            few.append(a)
    start = np.sort(np.concatenate([start, np.array(few, np.int64)]))
    row = np.searchsorted(offsets, start, "right") - 1
    length = np.minimum(size[row], WINDOW)
    padded = np.concatenate([data, np.zeros(WINDOW, np.uint8)])
    raw = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[start]
    raw[np.arange(WINDOW) >= length[:, None]] = 0
    h = mix(length.astype(_U))
    for word in raw.view("<u8").reshape(len(raw), WINDOW // 8).T:
        h = mix(h * _U(0xD6E8FEB86659FD93) + word)
    _, first = np.unique(mix(h + mix(row.astype(_U))), return_index=True)  # a repeated feature counts once
    first.sort()
    return row[first], h[first]


def filters(row: np.ndarray, hashes: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All Bloom filters of the rows (64-bit words), the filters before each row
    (and the end), and the number of features of each row."""
    count = np.bincount(row, minlength=n_rows)
    chain = -(-count // PER_FILTER)
    before = np.concatenate([[0], np.cumsum(chain)])
    own = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    at = (before[row] + own // PER_FILTER) * FILTER
    bits = np.zeros(int(before[-1]) * FILTER, bool)
    for i in range(BITS):
        bits[at + ((hashes >> _U(11 * i)) & _U(FILTER - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").view("<u8").reshape(-1, FILTER // 64), before, count


def text_of(words: np.ndarray, count: int) -> str:
    """A fingerprint as text: number of features and the filters in hex."""
    return f"{count:x}:{words.tobytes().hex()}"


def from_text(fingerprint: str) -> tuple[np.ndarray, int]:
    count, _, raw = fingerprint.partition(":")
    return np.frombuffer(bytes.fromhex(raw), "<u8").reshape(-1, FILTER // 64), int(count, 16)


def likeness(a: tuple[np.ndarray, int], b: tuple[np.ndarray, int]) -> float:
    """Normalised overlap of two digests (filters, features), 0 to 1."""
    if not a[1] or not b[1]:
        return float(a[1] == b[1])
    if (len(b[0]), b[1]) < (len(a[0]), a[1]):
        a, b = b, a
    set_a, set_b = (np.bitwise_count(x[0]).sum(axis=1, dtype=np.int64) for x in (a, b))
    best = np.zeros(len(a[0]))
    step = max(1, (1 << 20) // b[0].size)
    for lo in range(0, len(a[0]), step):
        hi = min(lo + step, len(a[0]))
        shared = np.bitwise_count(a[0][lo:hi, None] & b[0][None]).sum(axis=2, dtype=np.int64)
        chance = set_a[lo:hi, None] * set_b[None] / FILTER
        most = np.minimum(set_a[lo:hi, None], set_b[None])
        best[lo:hi] = ((shared - chance) / (most - chance)).max(axis=1)
    weight = np.full(len(best), PER_FILTER)
    weight[-1] = a[1] - PER_FILTER * (len(best) - 1)
    return float(np.clip(best, 0, 1) @ weight / weight.sum())


class Digests:
    """Digests of texts by one ranking of the bins."""

    def __init__(self, rank: np.ndarray):
        self.rank = rank

    def of(self, texts: list[bytes]) -> list[tuple[np.ndarray, int]]:
        out: list[tuple[np.ndarray, int]] = []
        for lo, hi, data, offsets in chunks(pa.array(texts, pa.large_binary()).view(pa.large_string())):
            row, h = features(data, offsets, self.rank)
            words, before, count = filters(row, h, hi - lo)
            out += [(words[before[i]: before[i + 1]], n) for i, n in enumerate(count.tolist())]
        return out


def edited(text: str, following: str) -> str:
    """The last half of the code points (rounded down) replaced by the first as
    many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _pair_batches(rank: np.ndarray, whole: int):
    """Rows (range, ends the range, id, text) in order to one row per document;
    ``whole`` is the number of ranges."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digests = Digests(rank)
        last = None  # the document that waits for its next one: range, id, text, digest

        def rows(docs: list[tuple]) -> pa.RecordBatch:
            """``docs``: (id, text, digest, next text, next digest)."""
            changed = [edited(t, nt).encode() for _, t, _, nt, _ in docs]
            new = digests.of(changed)
            return pa.RecordBatch.from_arrays([
                pa.array([d[0] for d in docs], pa.int64()), pa.array([len(d[1]) for d in docs], pa.int64()),
                pa.array([hashlib.sha256(c).hexdigest() for c in changed]),
                pa.array([text_of(*d[2]) for d in docs]), pa.array([text_of(*x) for x in new]),
                pa.array([likeness(d[2], x) for d, x in zip(docs, new)]), pa.array([likeness(d[2], d[4]) for d in docs]),
            ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        for batch in batches:
            for lo, hi, _, _ in chunks(batch.column(3)):
                part = batch.slice(lo, hi - lo)
                texts = part.column(3).to_pylist()
                found, ready = digests.of([t.encode() for t in texts]), []
                for at, ends, i, text, digest in zip(*(part.column(c).to_pylist() for c in (0, 1, 2)), texts, found):
                    if last is not None:
                        if last[0] != at:
                            raise RuntimeError("a range of documents does not end with the beginning of the next one")
                        ready.append((*last[1:], text, digest))
                    last = None if ends else (at, i, text, digest)
                if ready:
                    yield rows(ready)
        if last is not None:
            raise RuntimeError("a range of documents does not end with the beginning of the next one")

    return work


def ranges(rows: DataFrame, sampled: int = SAMPLED) -> list[tuple]:
    """Where ranges of ids begin: keys ``(id, tie, row)`` of documents, the first
    of all among them, that cut the rows into parts of about as many bytes."""
    size = F.octet_length("text") + F.lit(64)
    first = F.min(F.struct("id", "tie", "row"))
    total, least = rows.agg(F.sum(size), first).first()
    if total is None:
        return []
    spark = rows.sparkSession
    want = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES)), MOST_RANGES)
    unit = max(1, total // (want * sampled))  # a document stands for this many bytes, or for its own
    turn = F.pmod(F.xxhash64("id", "tie", "row"), F.lit(unit))
    chosen = rows.where(turn < size).select("id", "tie", "row", F.greatest(size, F.lit(unit)).alias("weight")).collect()
    keys = sorted((_key(r) for r in chosen))
    weight = {_key(r): r.weight for r in chosen}
    out, held = [_key(least)], 0
    goal = sum(weight.values()) / want
    for k in keys:
        if held >= goal and k > out[-1]:
            out.append(k)
            held = 0
        held += weight[k]
    return out


def _key(r) -> tuple:
    return (r["id"] is not None, r["id"] or 0, r["tie"], r["row"])


def neighbour_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stored: bool = False) -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next`` of every document. ``docs`` is stored first unless
    it is a scan of files (``stored``), so that every pass sees the same rows."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    if not stored:
        rows = materialize(rows)
    rank = corpus_ranks(rows, "text")
    rows = rows.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    begins = ranges(rows)
    n = max(1, len(begins))
    ids = np.array([k[1] for k in begins], np.int64)  # of the ranges that begin with an id
    shift = sum(not k[0] for k in begins)

    @F.arrow_udf("long")
    def place(i: pa.Array, tie: pa.Array, row: pa.Array) -> pa.Array:
        """Twice the range, plus 1 for the document that begins it."""
        known = np.asarray(i.is_valid())
        value = i.fill_null(0).to_numpy(zero_copy_only=False)
        lo = np.where(known, shift + np.searchsorted(ids[shift:], value, "left"), 0)
        hi = np.where(known, shift + np.searchsorted(ids[shift:], value, "right"), shift)
        out = (hi - 1) * 2
        for r in np.flatnonzero(lo < hi).tolist():  # ids that a range begins with
            k = (bool(known[r]), int(value[r]), tie[r].as_py(), row[r].as_py())
            at = bisect_right(begins, k) - 1
            out[r] = 2 * at + (begins[at] == k)
        return pa.array(out)

    placed = rows.withColumn("place", place("id", "tie", "row"))
    at = F.floor(F.col("place") / 2).cast("int")
    here = F.struct(at.alias("at"), F.lit(False).alias("ends"))
    there = F.struct(F.pmod(at - 1, F.lit(n)).cast("int").alias("at"), F.lit(True).alias("ends"))
    dealt = placed.select(F.explode(F.when(F.col("place") % 2 == 1, F.array(here, there)).otherwise(F.array(here))).alias("to"), "id", "tie", "row", "text")
    sorted_ = dealt.select("to.at", "to.ends", "id", "tie", "row", "text").repartitionById(n, F.col("at")).sortWithinPartitions(
        "at", "ends", "id", "tie", "row")
    return sorted_.select("at", "ends", "id", "text").mapInArrow(
        _pair_batches(rank, n), "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")
