"""Token ids of documents in bit-packed files, and their reader.

Documents are sorted by id over the cluster, each task encodes its range and
writes files of at most about ``FILE_IDS`` ids into the shared folder, and a
manifest table lists the files of the tasks that counted. Where a file's ids
begin in the whole sequence follows from the manifest alone.

Defined results. A null text is empty and has the end id only; null ids come
first; rows that repeat an id are written one by one, ordered by text hash; a
text longer than ``FILE_IDS`` is a file of its own. An empty table writes no
file and gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .bitpack import PackedFile, file_parts, width
from .encode import ENCODE_BYTES, encoder, ship_tokenizer
from .shared import map_file, new_folder, write_file
from .text import chunks

FILE_IDS = 1 << 24
_READ_IDS = 1 << 20


def _write_batches(path: str, end_id: int, bits: int, folder: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        docs: list = []
        ids: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal docs, ids, lengths, held, seq
            url = write_file(folder, f"{part:06d}-{seq:04d}", file_parts(docs, np.concatenate(lengths), np.concatenate(ids), bits))
            row = [part, seq, url, len(docs), held]
            docs, ids, lengths, held, seq = [], [], [], 0, seq + 1
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], ["part", "seq", "url", "documents", "ids"])

        enc = encoder(path)
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(1), ENCODE_BYTES):
                flat, row = enc.encode(data, offsets)
                if docs and held + len(flat) + hi - lo > FILE_IDS:
                    yield flush()
                docs += batch.column(0).slice(lo, hi - lo).to_pylist()
                ids.append(np.insert(flat, row[1:], end_id).astype(np.uint16 if bits <= 16 else np.uint32))
                lengths.append(np.diff(row) + 1)
                held += len(ids[-1])
        if docs:
            yield flush()

    return work


def write_token_files(
    docs: DataFrame, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", folder: str | None = None
) -> DataFrame:
    """Write the files and return the manifest: ``part, seq, url, documents,
    ids, first_id`` with one row per file, in document order by ``part, seq``."""
    from tokenizers import Tokenizer

    ship_tokenizer(docs.sparkSession, tokenizer)
    folder = folder or new_folder(docs.sparkSession, "tokens")
    bits = width(Tokenizer.from_file(tokenizer).get_vocab_size())
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = ["id", F.xxhash64("text")]
    files = materialize(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .mapInArrow(_write_batches(tokenizer, end_id, bits, folder), "part long, seq long, url string, documents long, ids long")
    )
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return materialize(files.withColumn("first_id", F.coalesce(F.sum("ids").over(before), F.lit(0))))


def _read_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for url, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            f = PackedFile(map_file(url))
            edge = f.first.astype(np.int64)
            lo = 0
            while lo < f.documents:
                hi = max(lo + 1, int(np.searchsorted(edge, edge[lo] + _READ_IDS, "right")) - 1)
                ids = f.read(int(edge[lo]), int(edge[hi])).astype("<u4")
                cut = edge[lo: hi + 1] - edge[lo]
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(f.doc_ids[lo:hi], mask=f.null[lo:hi].astype(bool)), pa.array(edge[lo:hi] + first),
                    pa.array(np.diff(cut)), pa.array(crc, pa.int64()),
                ], ["doc_id", "start", "n_tokens", "ids_crc32"])
                lo = hi


def read_token_files(manifest: DataFrame) -> DataFrame:
    """What the files hold, one row per document: ``doc_id, start`` (ids of all
    documents before it), ``n_tokens, ids_crc32``."""
    files = manifest.select("url", "first_id")
    return files.repartition(max(1, manifest.count())).mapInArrow(
        _read_batches, "doc_id long, start long, n_tokens long, ids_crc32 long")
