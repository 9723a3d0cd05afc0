"""Token ids of whole texts by a tokenizer file, fast enough for a large
corpus: a text is cut before every run of ASCII white space that follows
something else and between an ASCII letter and ASCII punctuation after it, and
each distinct piece is encoded once and kept with its bytes. A piece is found by
its hash and then compared byte by byte; a text with a piece that differs is
encoded whole. Neither a
byte-level BPE with its usual pre-tokeniser nor a BPE that drops white space
forms a token across such a cut, so the ids are those of the whole text (the
tests compare). Texts with other white space or control separators are encoded
whole, and so are texts that hold the string of an added token in any case of
its ASCII letters: the tokenizer's defaults decide what such a string becomes."""

from __future__ import annotations

import os
import re

import numpy as np
from pyspark import SparkFiles
from pyspark.sql import SparkSession

from .text import hash_spans, segments

# Pieces kept per task (some 150 bytes each); beyond that the store starts anew with the
# chunk at hand.
CACHE_PIECES = 1 << 18
# Bytes of text that are encoded at once (a worker holds some 60 bytes more for each):
# new pieces are merged into the store once for each.
ENCODE_BYTES = 1 << 20
# Bytes of pieces that are compared with the kept ones at once.
COMPARE_BYTES = 1 << 17
# New pieces that are encoded in one call, each on its own.
GROUP = 64
_ODD = re.compile(
    rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")

_LEAD = np.zeros(256, bool)  # bytes that such a separator begins with
_LEAD[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True


class Encoder:
    """Encodes chunks of texts (``text.chunks``) with one tokenizer file."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        added = sorted(t.content.encode().lower() for t in self.tok.get_added_tokens_decoder().values() if t.content)
        self.added = re.compile(b"|".join(map(re.escape, added))) if added else None
        self.keys, self.start, self.length = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.pool = np.empty(0, np.uint32)
        self.spelt, self.spelt_at, self.spelt_len = np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows as one array, and the offsets of the rows in it."""
        raw = data.tobytes()
        hits = [m.start() for m in _ODD.finditer(raw)] if _LEAD[data].any() else []
        if self.added:
            hits += [i for m in self.added.finditer(raw.lower()) for i in range(*m.span())]  # a match may reach over rows
        odd = np.unique(np.searchsorted(offsets, hits, "right") - 1)
        start, end, before = segments(data, offsets)
        plain = ~np.isin(np.searchsorted(offsets, start, "right") - 1, odd) if len(odd) else slice(None)
        h = hash_spans(data, start, end)
        uniq, first, inverse = np.unique(h[plain], return_index=True, return_inverse=True)
        at = self._find(uniq)
        if (at < 0).any():
            new = first[at < 0]
            self._learn(uniq[at < 0], raw, start[plain][new], end[plain][new], uniq)
            at = self._find(uniq)
        differing = self._differing(data, start[plain], end[plain], at[inverse])
        if len(differing):
            odd = np.union1d(odd, np.searchsorted(offsets, start[plain][differing], "right") - 1)
        n = np.zeros(len(start), np.int64)
        begin = np.zeros(len(start), np.int64)
        n[plain], begin[plain] = self.length[at][inverse], self.start[at][inverse]
        ends = np.cumsum(n)
        step = np.ones(int(ends[-1]) if len(ends) else 0, np.int64)  # from one id to the next in the pool
        some = np.flatnonzero(n)
        if len(some):
            last = begin[some] + n[some] - 1
            step[ends[some] - n[some]] = begin[some] - np.concatenate([[0], last[:-1]])
        ids = self.pool[np.cumsum(step)]
        row = np.concatenate([[0], ends])[before]
        if len(odd):
            whole = dict(zip(odd.tolist(), self._ids([raw[offsets[r]: offsets[r + 1]].decode("utf-8", "replace") for r in odd])))
            parts = [np.array(whole[r], np.uint32) if r in whole else ids[row[r]: row[r + 1]] for r in range(len(offsets) - 1)]
            ids = np.concatenate(parts)
            row = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return ids, row

    def _find(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def _differing(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The pieces whose bytes are not those kept under their hash."""
        length = end - start
        alike = length == self.spelt_len[at]
        before = np.cumsum(length) - length
        edge = [*np.searchsorted(before, np.arange(0, int(length.sum()) + 1, COMPARE_BYTES)).tolist(), len(start)]
        for i, j in zip(edge[:-1], edge[1:]):
            n = np.where(alike[i:j], length[i:j], 0)
            ends = np.cumsum(n)
            # both sides at once: where a byte of a piece lies, and where that of the kept one
            step = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start[i:j] - (ends - n), n)
            other = step + np.repeat(self.spelt_at[at[i:j]] - start[i:j], n)
            where = np.flatnonzero(data[step] != self.spelt[other])
            alike[i:j][np.searchsorted(ends, where, "right")] = False
        return np.flatnonzero(~alike)

    def _learn(self, keys: np.ndarray, raw: bytes, start: np.ndarray, end: np.ndarray, needed: np.ndarray) -> None:
        pieces = [raw[a:b].decode() for a, b in zip(start.tolist(), end.tolist())]
        groups = [pieces[i: i + GROUP] for i in range(0, len(pieces), GROUP)]
        done = self.tok.encode_batch(groups, is_pretokenized=True, add_special_tokens=False)
        ids = [np.array(e.ids, np.uint32) for e in done]
        length = np.concatenate([np.bincount(np.array(e.word_ids, np.int64), minlength=len(g)) for e, g in zip(done, groups)])
        if len(self.keys) + len(keys) > CACHE_PIECES:
            keep = np.isin(self.keys, needed)
            old = [self.pool[s: s + n] for s, n in zip(self.start[keep].tolist(), self.length[keep].tolist())]
            self.keys, self.length = self.keys[keep], self.length[keep]
            self.pool = np.concatenate(old) if old else np.empty(0, np.uint32)
            self.start = np.cumsum(self.length) - self.length
            old = [self.spelt[s: s + n] for s, n in zip(self.spelt_at[keep].tolist(), self.spelt_len[keep].tolist())]
            self.spelt_len = self.spelt_len[keep]
            self.spelt = np.concatenate(old) if old else np.empty(0, np.uint8)
            self.spelt_at = np.cumsum(self.spelt_len) - self.spelt_len
        all_keys = np.concatenate([self.keys, keys])
        all_start = np.concatenate([self.start, len(self.pool) + np.cumsum(length) - length])
        order = np.argsort(all_keys, kind="stable")
        self.keys, self.start = all_keys[order], all_start[order]
        self.length = np.concatenate([self.length, length])[order]
        self.pool = np.concatenate([self.pool, *ids])
        spelt_len = end - start
        self.spelt_at = np.concatenate([self.spelt_at, len(self.spelt) + np.cumsum(spelt_len) - spelt_len])[order]
        self.spelt_len = np.concatenate([self.spelt_len, spelt_len])[order]
        self.spelt = np.concatenate([self.spelt, np.frombuffer(b"".join(p.encode() for p in pieces), np.uint8)])


_encoders: dict[str, Encoder] = {}


def ship_tokenizer(spark: SparkSession, path: str) -> None:
    """Hand the driver's tokenizer file to every executor, once per application."""
    sc = spark.sparkContext
    sent = getattr(sc, "_catchment_sent", set())
    if path not in sent:
        sc.addFile(path)
        sc._catchment_sent = sent | {path}


def encoder(path: str) -> Encoder:
    """The encoder of a tokenizer file that :func:`ship_tokenizer` has handed
    over, in a task; a worker that runs several tasks keeps it."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(SparkFiles.get(os.path.basename(path)))
    return _encoders[path]
