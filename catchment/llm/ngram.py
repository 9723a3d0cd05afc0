"""Language-model scores from an Elias-Fano n-gram trie.

Tokens are lower-cased words and one end per document; the end is also the
context of a first word. The model is a bigram model smoothed by the unigrams:
``p(w | v) = (c(vw) + mu * p(w)) / (c(v) + mu)``, with
``p(w) = (c(w) + 0.1) / (N + 0.1 * (V + 1))``. ``mu`` is the value of a fixed
grid that fits the training pairs best when each occurrence is left out of its
own counts. All counts cover all training documents.

The trie lies in the shared folder in two levels of files.

* Words: sorted 64-bit hashes, cut into files by hash range, as Elias-Fano
  sequences with their counts.
* Pairs: a word file owns the pairs that end in its words, and deals them over
  pair files by the hash of the context, as many as its words' counts ask for, so
  that no frequent word or context ends up in one task or file. A pair file holds
  its contexts, monotone pointers to where each context's successors begin, and
  the successors relative to their context (``rank of context * words of the word
  file + place of the word``), all Elias-Fano, and in 16-bit steps what the pair
  adds to the log probability. A lookup finds the context, reads two pointers and
  searches the successor between them.

The logarithm splits into ``log p(w) + log(mu / (c(v) + mu)) + log(1 + c(vw) /
(mu * p(w)))``. Contexts of a document are its tokens in another order, so the
first two terms are sums over tokens, and all three need only the word file and
the pair file of a pair's last word. So tokens go to the files, never files to the
tokens: a task cuts its texts into chunks, sends each owner the pairs of a chunk
once with the rows they stand in, the owner returns one sum for each row, and the
sums of a chunk are added up. A task opens one word file and one pair file at a
time, and words are never numbered over the whole corpus. A chunk is named after
its place and its content. So a table whose rows come in the same order when a lost
task runs again (a stored one) is scored through any loss; of other input, sums of
two different attempts that do not belong together are an error, never a result.

Counts are summed per chunk before any shuffle; pairs travel as compressed
sorted runs. The number of files grows with the corpus, so that no task holds
more than a bounded part; the driver holds one number for each word file. Runs that
many chunks send to one owner are split by the adaptive skew join.

Defined results. A null text is empty: one end token. A null id is never held
out. Repeated rows are counted and scored one by one. Without training
documents every token has probability 1 (score 0). An empty table gives an
empty result. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .eliasfano import EliasFano
from .shared import map_file, new_folder, write_file
from .text import chunks, mix, word_hashes

WORDS_PER_FILE = 1 << 20
TOKENS_PER_FILE = 1 << 22
_CHUNK = 8 << 20
_HELD = 1 << 21
MU_GRID = (0.5, 2.0, 8.0, 32.0, 128.0, 512.0, 2048.0, 8192.0, 32768.0)
ADDED = 0.1
_SUB_BITS = 24  # of an owner's number: the pair file within its word file
_U = np.uint64
END = mix(np.array([0xE0D], _U))[0]


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of rows, each row closed by the end, and the row edges."""
    h, before = word_hashes(data, offsets)
    return np.insert(h, before[1:], END), before + np.arange(len(before))


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and their summed counts."""
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    if not len(k):
        return k, c
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return k[first], np.add.reduceat(c, first)


def _packed(*columns: np.ndarray) -> bytes:
    """Arrays of 64-bit values, small: byte planes, compressed."""
    head = np.array([len(columns), *map(len, columns)], _U).tobytes()
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join([head, *planes]))


def _unpacked(raw: bytes, kinds: str) -> list[np.ndarray]:
    """The arrays of ``_packed``; ``kinds``: a numpy type character for each."""
    plane = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8)
    sizes = plane[8: 8 * (len(kinds) + 1)].view(np.int64)
    at, out = 8 * (len(kinds) + 1), []
    for n, kind in zip(sizes.tolist(), kinds, strict=True):
        out.append(np.ascontiguousarray(plane[at: at + 8 * n].reshape(8, n).T).view(_U).ravel().view(kind))
        at += 8 * n
    return out


class Chunk:
    """The tokens of some rows: distinct ``words`` (hashes, ascending), for each
    distinct pair of neighbours its words' places there (last word, context), for
    each token its ``pair``, and the row ``edge``s."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        h, self.edge = _tokens(data, offsets)
        self.words, number = np.unique(h, return_inverse=True)
        before = np.empty_like(number)
        before[1:] = number[:-1]
        before[self.edge[:-1]] = np.searchsorted(self.words, END)
        key, self.pair, self.count = np.unique(
            number * len(self.words) + before, return_inverse=True, return_counts=True)
        self.last, self.context = key // len(self.words), key % len(self.words)

    def owners(self, splits: np.ndarray) -> np.ndarray:
        """Number of the pair file that owns each pair."""
        file = _file_of(self.words, len(splits))[self.last]
        sub = mix(self.words)[self.context] % splits[file].astype(_U)
        return (file << _SUB_BITS) | sub.astype(np.int64)

    def spelled(self, pairs: np.ndarray) -> list[np.ndarray]:
        """Some ascending pairs: the gaps of the hashes and of the places of their
        last words, then the gaps of the hashes and the places of their contexts."""
        out = []
        for part in (self.last[pairs], self.context[pairs]):
            used = np.zeros(len(self.words), bool)
            used[part] = True
            out += [np.diff(self.words[used], prepend=_U(0)), (np.cumsum(used) - 1)[part]]
        out[1] = np.diff(out[1], prepend=0)
        return out


def _groups(owner: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each owner and the places where it stands."""
    order = np.argsort(owner, kind="stable")
    cut = np.flatnonzero(np.diff(owner[order], prepend=-1))
    for a, b in zip(cut, np.append(cut[1:], len(order)), strict=True):
        yield int(owner[order[a]]), order[a:b]


def _file_of(hashes: np.ndarray, files: int) -> np.ndarray:
    """Number of the word file of each hash."""
    return (((hashes >> _U(44)) * _U(files)) >> _U(20)).astype(np.int64)


def _floor(file: int, files: int) -> int:
    """The smallest hash of a word file."""
    return (-(-(file << 20) // files)) << 44


class Words:
    """One word file."""

    def __init__(self, url: str, file: int, files: int, n: int):
        raw = map_file(url).view(_U)
        self.keys = EliasFano(raw)
        self.n, self.low = n, _U(_floor(file, files))
        self.count = raw[self.keys.words: self.keys.words + n].view(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word of this file's range, -1 if unseen."""
        return self.keys.find(hashes - self.low)


class Base:
    """The numbers behind every probability: training tokens and distinct words."""

    def __init__(self, tokens: int, words: int):
        self.tokens, self.floor = tokens, tokens + ADDED * (words + 1)

    def chance(self, counts: np.ndarray) -> np.ndarray:
        return (counts + ADDED) / self.floor


_open: dict = {}


def _opened(kind: str, key: tuple, make):
    """An opened file; a worker keeps the last of each kind."""
    if _open.get(kind, (None,))[0] != key:
        _open[kind] = (key, make())
    return _open[kind][1]


def _word_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, counts, held = [], [], 0

    def out() -> pa.RecordBatch:
        k, c = _summed(keys, counts)
        return pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], ["h", "c"])

    for batch in batches:
        for _, _, data, offsets in chunks(batch.column(0), _CHUNK):
            k, c = np.unique(_tokens(data, offsets)[0], return_counts=True)
            keys.append(k)
            counts.append(c)
            held += len(k)
            if held > _HELD:
                yield out()
                keys, counts, held = [], [], 0
    if keys:
        yield out()


def count_words(training: DataFrame, text_col: str) -> tuple[DataFrame, np.ndarray, Base, list[float]]:
    """Writes the first level. Returns the owners (``s``, number of a pair file,
    and its word file's ``file, url, n``), the pair files of each word file, the
    base numbers and, for each ``mu`` of the grid, the contexts' part of the log
    likelihood."""
    folder = new_folder(training.sparkSession, "words")
    counts = materialize(
        training.select(text_col).mapInArrow(_word_batches, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")))
    c = F.col("c").cast("double")
    n, tokens, *contexts = counts.agg(
        F.count(F.lit(1)), F.coalesce(F.sum("c"), F.lit(0)),
        *[F.coalesce(F.sum(c * F.log10(c + F.lit(mu - 1))), F.lit(0.0)) for mu in MU_GRID]).first()
    files = max(1, -(-n // WORDS_PER_FILE))

    def write(table: pa.Table) -> pa.Table:
        h = table["h"].to_numpy().view(_U)
        order = np.argsort(h)
        f = int(table["file"][0].as_py())
        floor = _floor(f, files)
        count = table["c"].to_numpy()[order]
        url = write_file(folder, f"{f:06d}", [EliasFano.build(h[order] - _U(floor), _floor(f + 1, files) - floor), count.tobytes()])
        return pa.table({"file": [f], "url": [url], "n": [len(h)], "k": [max(1, -(-int(count.sum()) // TOKENS_PER_FILE))]})

    file = F.shiftright(F.shiftrightunsigned("h", 44) * F.lit(files), 20)
    written = materialize(
        counts.withColumn("file", file).groupBy("file").applyInArrow(write, "file long, url string, n long, k long"))
    splits = np.ones(files, np.int64)
    for r in written.select("file", "k").collect():  # one row per word file
        splits[r.file] = r.k
    first = F.shiftleft("file", _SUB_BITS)
    owners = written.select(F.explode(F.sequence(first, first + F.col("k") - 1)).alias("s"), "file", "url", "n")
    return owners, splits, Base(tokens, n), contexts


def _pair_batches(splits: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0), _CHUNK):
                chunk = Chunk(data, offsets)
                found = [(s, _packed(*chunk.spelled(at), chunk.count[at])) for s, at in _groups(chunk.owners(splits))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _ in found]), pa.array([r for _, r in found], pa.binary())], ["s", "run"])

    return work


def _spelled_out(raw: bytes, kinds: str) -> list[np.ndarray]:
    """A run's last words and contexts as hashes, and its other arrays."""
    lasts, last, contexts, context, *others = _unpacked(raw, "QqQq" + kinds)
    return [np.cumsum(lasts, dtype=_U)[np.cumsum(last)], np.cumsum(contexts, dtype=_U)[context], *others]


def count_pairs(training: DataFrame, text_col: str, owners: DataFrame, splits: np.ndarray, base: Base) -> DataFrame:
    """Stored pair counts by owner: ``s, pairs`` (a file of contexts, words' places
    and counts), the word file's columns and, for each ``mu`` of the grid, the pairs'
    part of the log likelihood, each left out of its own counts."""
    folder = new_folder(training.sparkSession, "pairs")
    files = len(splits)
    runs = training.select(text_col).mapInArrow(_pair_batches(splits), "s long, run binary")
    fields = [pa.field("s", pa.int64()), pa.field("pairs", pa.string()), pa.field("file", pa.int64()), pa.field("url", pa.string()),
              pa.field("n", pa.int64()), *[pa.field(f"m{i}", pa.float64()) for i in range(len(MU_GRID))]]

    def merge(sent: pa.Table, owner: pa.Table) -> pa.Table:
        if not sent.num_rows:
            return pa.schema(fields).empty_table()
        file, url, n = (owner[c][0].as_py() for c in ("file", "url", "n"))
        words = _opened("words", (url,), lambda: Words(url, file, files, n))
        w, v, c = (np.concatenate(x) for x in zip(*[_spelled_out(r, "q") for r in sent["run"].to_pylist()], strict=True))
        each, at = np.unique(w, return_inverse=True)
        w = words.find(each)[at]
        order = np.lexsort((w, v))
        v, w, c = v[order], w[order], c[order]
        first = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (w[1:] != w[:-1])]))
        v, w, c = v[first], w[first], np.add.reduceat(c, first)
        p = base.chance(words.count[w])
        fit = [float((c * np.log10(c - 1 + mu * p)).sum()) for mu in MU_GRID]
        s = owner["s"][0].as_py()
        pairs = write_file(folder, f"{s:012d}", [_packed(np.diff(v, prepend=_U(0)), w, c)])
        return pa.Table.from_arrays([pa.array([x], f.type) for x, f in zip([s, pairs, file, url, n, *fit], fields, strict=True)], schema=pa.schema(fields))

    schema = "s long, pairs string, file long, url string, n long" + "".join(f", m{i} double" for i in range(len(MU_GRID)))
    return materialize(runs.groupBy("s").cogroup(owners.groupBy("s")).applyInArrow(merge, schema))


def _trie_batches(files: int, base: Base, mu: float, folder: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s, pairs, file, url, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = _opened("words", (url,), lambda: Words(url, file, files, n))
                v, w, c = _unpacked(map_file(pairs).tobytes(), "Qqq")
                v = np.cumsum(v, dtype=_U)
                contexts, first = np.unique(v, return_index=True)
                rank = np.repeat(np.arange(len(contexts), dtype=_U), np.diff(np.append(first, len(v))))
                adds = np.log10(1 + c / (mu * base.chance(words.count[w])))
                step = max(float(adds.max()), 1e-9) / 65535
                codes = np.rint(adds / step).astype(np.uint16)
                path = write_file(folder, f"{s:012d}", [
                    EliasFano.build(contexts, 1 << 64), EliasFano.build(np.append(first, len(v)), len(v) + 1),
                    EliasFano.build(rank * _U(n) + w.astype(_U), len(contexts) * n),
                    np.array([step]).tobytes(), np.pad(codes, (0, -len(codes) % 4)).tobytes()])
                yield pa.RecordBatch.from_arrays([pa.array([s]), pa.array([path])], ["s", "trie"])

    return work


class Pairs:
    """One file of the second level; ``words``: the number of words of its word file."""

    def __init__(self, url: str, words: int):
        raw = map_file(url).view(_U)
        self.words = words
        self.contexts = EliasFano(raw)
        self.pointers = EliasFano(raw[self.contexts.words:])
        at = self.contexts.words + self.pointers.words
        self.successors = EliasFano(raw[at:])
        at += self.successors.words
        self.step = float(raw[at: at + 1].view(np.float64)[0])
        self.codes = raw[at + 1:].view(np.uint16)

    def find(self, contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
        """What pairs (context hash, place of the word or -1) add; 0 if unseen."""
        out = np.zeros(len(words))
        each, run = np.unique(contexts, return_inverse=True)
        rank = self.contexts.find(each)
        seen = np.flatnonzero(rank >= 0)
        lo, hi = np.zeros(len(each), np.int64), np.zeros(len(each), np.int64)
        lo[seen] = self.pointers.access(rank[seen]).astype(np.int64)
        hi[seen] = self.pointers.access(rank[seen] + 1).astype(np.int64)
        at = np.flatnonzero((rank[run] >= 0) & (words >= 0))
        r = run[at]
        i = self.successors.find(rank[r].astype(_U) * _U(self.words) + words[at].astype(_U), lo[r], hi[r])
        hit = np.flatnonzero(i >= 0)
        out[at[hit]] = self.step * self.codes[i[hit]]
        return out


_SENT = "chunk long, s long, run binary, ids array<long>, held array<boolean>"


def _send_batches(splits: np.ndarray):
    """For each chunk a row with its ids and lengths (``s`` is negative), and one for
    each owner: the pairs, and for each of their tokens the pair and the row."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(2), _CHUNK):
                chunk = Chunk(data, offsets)
                content = hashlib.blake2b(np.array([TaskContext.get().partitionId(), done]).tobytes(), digest_size=8)
                for part in (data, offsets, np.array(batch.column(0).slice(lo, hi - lo).fill_null(0))):
                    content.update(np.ascontiguousarray(part))
                name = int.from_bytes(content.digest()) >> 1
                done += 1
                length = np.diff(chunk.edge)
                owner = chunk.owners(splits)
                order = np.argsort(chunk.pair, kind="stable")  # tokens by pair, then by row
                row = np.repeat(np.arange(hi - lo), length)[order]
                start = np.concatenate([[0], np.cumsum(chunk.count)])
                out = [(-1 - name % (1 << 20), _packed(length))]
                for s, at in _groups(owner):
                    n = chunk.count[at]
                    tokens = np.repeat(start[at] - np.cumsum(n) + n, n) + np.arange(n.sum())
                    out.append((s, _packed(*chunk.spelled(at), n, row[tokens])))
                lists = [pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), batch.column(i).slice(lo, hi - lo)) for i in (0, 1)]
                lists = [pa.concat_arrays([x, pa.nulls(len(out) - 1, x.type)]) for x in lists]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(out)), pa.array([s for s, _ in out]), pa.array([r for _, r in out], pa.binary()), *lists],
                    ["chunk", "s", "run", "ids", "held"])

    return work


def _owner_batches(files: int, base: Base, mu: float):
    """For each run the sums of its rows: row, tokens, known ones, base and model
    scores. A chunk's first row passes."""
    def sums(run: bytes, file: int | None, url: str | None, n: int | None, trie: str | None) -> bytes:
        w, v, times, row = _spelled_out(run, "qq")
        place, count, model = np.full(len(w), -1, np.int64), np.zeros(len(w), np.int64), np.zeros(len(w))
        if url is not None:
            words = _opened("words", (url,), lambda: Words(url, file, files, n))
            each, at = np.unique(w, return_inverse=True)
            place = words.find(each)[at]
            seen = np.flatnonzero(place >= 0)
            count[seen] = words.count[place[seen]]
        if trie is not None:
            model = _opened("pairs", (trie,), lambda: Pairs(trie, n)).find(v, place)
        own = np.log10(base.chance(count))
        model += own + np.log10(mu / (count + mu))
        each, at = np.unique(row, return_inverse=True)
        pair = np.repeat(np.arange(len(w)), times)
        known = np.bincount(at, count[pair] > 0).astype(np.int64)
        return _packed(np.diff(each, prepend=0), np.bincount(at), known, np.bincount(at, own[pair]), np.bincount(at, model[pair]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [run.as_py() if ids.is_valid else sums(run.as_py(), *(x.as_py() for x in more))
                   for run, ids, _, *more in zip(*batch.columns[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(out, pa.binary()), batch.column(2), batch.column(3)], ["chunk", "sums", "ids", "held"])

    return work


def _add_up(total: int):
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])

    def work(parts: pa.Table) -> pa.Table:
        heads = parts.filter(parts["ids"].is_valid())
        length = _unpacked(heads["sums"][0].as_py(), "q")[0] if heads.num_rows == 1 else np.empty(0, np.int64)
        tokens, known = np.zeros((2, len(length)), np.int64)
        own, model = np.zeros((2, len(length)))
        if heads.num_rows == 1:
            for raw in sorted(parts.filter(parts["ids"].is_null())["sums"].to_pylist()):  # one order: reruns agree in the last bit
                gaps, t, k, b, m = _unpacked(raw, "qqqdd")
                row = np.cumsum(gaps)
                for sum_, x in ((tokens, t), (known, k), (own, b), (model, m)):
                    sum_[row] += x
        if heads.num_rows != 1 or (tokens != length).any():
            raise RuntimeError("a lost task read the documents in another order: store them as a table first")
        columns = [*(heads[c].combine_chunks().flatten() for c in ("ids", "held")),
                   *map(pa.array, (length, known, np.full(len(length), total), own, model))]
        return pa.Table.from_arrays(columns, schema=schema)

    return work


def held_out(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text is a multiple of 10; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def lm_scores(docs: DataFrame, is_held_out: Column | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the documents that are not held out and score all:
    ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), (held_out(id_col) if is_held_out is None else is_held_out).alias("out"),
                       F.col(text_col).alias("text"))
    training = rows.where("not out")
    owners, splits, base, contexts = count_words(training, "text")
    counted = count_pairs(training, "text", owners, splits, base)
    fit = counted.agg(*[F.coalesce(F.sum(f"m{i}"), F.lit(0.0)) for i in range(len(MU_GRID))]).first()
    mu = MU_GRID[int(np.argmax(np.array(fit) - np.array(contexts)))]
    trie = materialize(counted.select("s", "pairs", "file", "url", "n").mapInArrow(
        _trie_batches(len(splits), base, mu, new_folder(spark, "trie")), "s long, trie string"))
    files = owners.join(trie, "s", "left")
    # a merge join: its partitions come sorted by owner, and a hot owner's runs are split
    at_owner = rows.mapInArrow(_send_batches(splits), _SENT).join(files.hint("merge"), "s", "left")
    sums = at_owner.select("chunk", "run", "ids", "held", "file", "url", "n", "trie").mapInArrow(
        _owner_batches(len(splits), base, mu), "chunk long, sums binary, ids array<long>, held array<boolean>")
    return sums.groupBy("chunk").applyInArrow(
        _add_up(base.tokens),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
