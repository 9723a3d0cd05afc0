"""Fixed-width bit packing of ids, and the file format built on it.

64 ids of ``bits`` bits fill ``bits`` 64-bit words (little-endian, the first id
in the lowest bits), so any run of ids is found by arithmetic and unpacked with
one numpy step per id of such a group. A file holds documents in order::

    magic "IDPACK01", bits u32, ids per block u32, documents u64, ids u64
    doc ids i64[documents], null marks u8[documents] padded to 8 bytes
    first id of each document u64[documents + 1]
    first byte of each block, from the data's start, u64[blocks + 1]
    data
"""

from __future__ import annotations

import numpy as np

MAGIC = b"IDPACK01"
BLOCK_IDS = 4096
_U = np.uint64


def width(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> np.ndarray:
    """Packed words of ``ids``, padded with 0 to a full group of 64."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    groups = -(-len(ids) // 64)
    padded = np.zeros(groups * 64, _U)
    padded[: len(ids)] = ids
    padded = padded.reshape(groups, 64)
    out = np.zeros((groups, bits), _U)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        out[:, word] |= padded[:, j] << _U(shift)
        if shift + bits > 64:
            out[:, word + 1] |= padded[:, j] >> _U(64 - shift)
    return out.ravel()


def unpack(words: np.ndarray, bits: int, start: int, end: int) -> np.ndarray:
    """Ids ``start`` to ``end`` of packed words."""
    if end <= start:
        return np.empty(0, np.uint32)
    first, last = start // 64, -(-end // 64)
    part = np.asarray(words[first * bits: last * bits]).reshape(last - first, bits)
    out = np.empty((last - first, 64), np.uint32)
    mask = _U((1 << bits) - 1)
    for j in range(64):
        word, shift = divmod(j * bits, 64)
        v = part[:, word] >> _U(shift)
        if shift + bits > 64:
            v = v | (part[:, word + 1] << _U(64 - shift))
        out[:, j] = v & mask
    return out.ravel()[start - first * 64: end - first * 64]


def file_parts(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, bits: int) -> list[bytes]:
    """The bytes of a file, in pieces."""
    n, total = len(doc_ids), len(ids)
    data = pack(ids, bits)
    null = np.array([d is None for d in doc_ids], np.uint8)
    blocks = -(-total // BLOCK_IDS)
    at = np.minimum(np.arange(blocks + 1, dtype=_U) * _U(BLOCK_IDS * bits // 8), _U(len(data) * 8))
    return [
        MAGIC, np.array([bits, BLOCK_IDS], np.uint32).tobytes(), np.array([n, total], _U).tobytes(),
        np.array([0 if d is None else d for d in doc_ids], np.int64).tobytes(),
        np.pad(null, (0, -n % 8)).tobytes(),
        np.concatenate([[0], np.cumsum(lengths)]).astype(_U).tobytes(), at.tobytes(), data.tobytes(),
    ]


class PackedFile:
    """Reads a file's bytes (an array or a memory map) in place."""

    def __init__(self, raw: np.ndarray):
        if bytes(raw[:8]) != MAGIC:
            raise ValueError("not a packed id file")
        self.bits, self.block = (int(x) for x in raw[8:16].view(np.uint32))
        self.documents, self.ids = (int(x) for x in raw[16:32].view(_U))
        at = 32

        def take(count: int, kind, size: int) -> np.ndarray:
            nonlocal at
            part = raw[at: at + count * size].view(kind)
            at += count * size
            return part

        self.doc_ids = take(self.documents, np.int64, 8)
        self.null = take(self.documents + -self.documents % 8, np.uint8, 1)[: self.documents]
        self.first = take(self.documents + 1, _U, 8)
        self.block_at = take(-(-self.ids // self.block) + 1, _U, 8)
        self.data = raw[at:]

    def read(self, start: int, end: int) -> np.ndarray:
        """Ids ``start`` to ``end``, from the blocks that hold them."""
        if end <= start:
            return np.empty(0, np.uint32)
        b0, b1 = start // self.block, -(-end // self.block)
        part = self.data[int(self.block_at[b0]): int(self.block_at[b1])].view(_U)
        return unpack(part, self.bits, start - b0 * self.block, end - b0 * self.block)

    def document(self, i: int) -> np.ndarray:
        """The ids of the ``i``-th document."""
        return self.read(int(self.first[i]), int(self.first[i + 1]))
