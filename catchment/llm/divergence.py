"""How the word use of each source differs, by in-mapper stripes.

A task folds whole documents into stripes: for every (language, term) the number
of documents and, by source, the number of occurrences. Only stripes leave a
task (a full store is handed on early and starts anew), so a frequent term costs
one row per task, however many rows hold it. One shuffle by (language, term)
merges them; terms of too few documents go. The merged stripes of a task are
laid out as blocks of terms by sources, and their divergences are summed there
(a task holds one sum for each two sources of a language):
each two sources of a language over all its terms, and the strongest terms of
every source against the language. A last sum by key joins the tasks.

All arithmetic is exact, in integers: a share is ``1 + floor(SCALE * (count + 2)
/ (N + 2 * V))`` of ``V`` kept terms with ``N`` occurrences, the divergence of
two shares ``floor((p - q) ** 2 / (p + q))``.

Defined results. Null text, language or source counts as empty. Every
(language, source) that occurs is a group, also without any term. A language
without kept terms gives the value 0 for its pairs and no term rows. Rows that
repeat are documents as any others; ids are not looked at. Equal values rank by
the bytes of the item. An empty table gives an empty result. Further columns are
ignored. Terms are compared by their bytes. Counts up to 9e15 are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .text import chunks, lower

# Documents of a language that a kept term is in at least; terms reported.
LEAST_DOCUMENTS = 10
TOP_TERMS = 10
# A share of one, in the integers of the report.
SCALE = 10**9
# Stripes and (stripe, source) counts that a task holds before it hands them on.
HELD_STRIPES = 1 << 18
HELD_COUNTS = 1 << 21
# Cells of a block of terms by sources, and of a task's sums over two sources.
BLOCK_CELLS = 1 << 18
HELD_SUMS = 1 << 21

_TERM = np.zeros(256, bool)
_TERM[0x41:0x5B] = _TERM[0x61:0x7B] = True
_TERM[0x80:] = True

_STRIPE = "lang string, term string, docs long, sources array<string>, counts array<long>"


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The terms of A-Z lower-cased rows, in order, and the terms before each
    row (and the end). A row's end ends a term."""
    data = lower(data)
    solid = _TERM[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    edge = offsets[1:-1]
    edge = edge[edge < len(data)]
    begins[edge] = solid[edge]
    start = np.flatnonzero(begins)
    inside = np.concatenate([[0], np.cumsum(solid)])  # letters before a byte
    bounds = np.append(inside[start], inside[-1])
    found = pa.Array.from_buffers(pa.large_binary(), len(start), [
        None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data[solid]))])
    return found.dictionary_encode(), np.searchsorted(start, offsets)


class Stripes:
    """Stripes of one task: a hash table of (language, term) with the number of
    documents, and the occurrences of each by source."""

    def __init__(self) -> None:
        self.slots: dict[tuple[str, bytes], int] = {}
        self.sources: dict[str, int] = {}
        self.groups: set[tuple[str, str]] = set()
        self.docs = np.zeros(1 << 10, np.int64)
        self.cells: list[np.ndarray] = []  # slot << 32 | source
        self.counts: list[np.ndarray] = []
        self.held = 0

    def fold(self, langs: list[str], sources: list[str], data: np.ndarray, offsets: np.ndarray) -> None:
        """Take in a chunk of whole documents."""
        self.groups.update(zip(langs, sources))
        found, before = terms(data, offsets)
        if not len(found):
            return
        words, code = found.dictionary.to_pylist(), found.indices.to_numpy().astype(np.int64)
        names = sorted(set(langs))
        lang = np.searchsorted(np.array(names, object), np.array(langs, object))
        source = np.array([self.sources.setdefault(s, len(self.sources)) for s in sources], np.int64)
        row = np.repeat(np.arange(len(langs)), np.diff(before))
        in_doc, times = np.unique(row * len(words) + code, return_counts=True)
        row, code = np.divmod(in_doc, len(words))
        stripe, at, docs = np.unique(lang[row] * len(words) + code, return_inverse=True, return_counts=True)
        slot = np.array([self.slots.setdefault((names[k // len(words)], words[k % len(words)]), len(self.slots))
                         for k in stripe.tolist()], np.int64)
        if len(self.slots) > len(self.docs):
            self.docs = np.concatenate([self.docs, np.zeros(len(self.slots) * 2 - len(self.docs), np.int64)])
        self.docs[slot] += docs
        cell, at = np.unique(slot[at] << 32 | source[row], return_inverse=True)
        self.cells.append(cell)
        self.counts.append(_sums(at, times, len(cell)))
        self.held += len(cell)
        if self.held > HELD_COUNTS:
            self._merge()

    def _merge(self) -> None:
        cell, at = np.unique(np.concatenate(self.cells), return_inverse=True)
        self.cells, self.counts = [cell], [_sums(at, np.concatenate(self.counts), len(cell))]
        self.held = len(cell)

    def full(self) -> bool:
        return len(self.slots) > HELD_STRIPES or self.held > HELD_COUNTS

    def hand_on(self) -> Iterator[pa.RecordBatch]:
        """The stripes as rows, and a row without a term per language with the
        groups met; the store is empty afterwards."""
        if self.slots:
            self._merge()
            slot, source = self.cells[0] >> 32, self.cells[0] & 0xFFFFFFFF
            names = np.array(list(self.sources), object)
            keys = list(self.slots)
            edge = np.searchsorted(slot, np.arange(len(keys) + 1))
            step = 1 << 14
            for a in range(0, len(keys), step):
                b = min(a + step, len(keys))
                lo, hi = edge[a], edge[b]
                offsets = pa.array((edge[a: b + 1] - lo).astype(np.int32))
                yield pa.RecordBatch.from_arrays([
                    pa.array([k[0] for k in keys[a:b]], pa.string()),
                    pa.array([k[1] for k in keys[a:b]], pa.binary()).cast(pa.string()),
                    pa.array(self.docs[a:b]),
                    pa.ListArray.from_arrays(offsets, pa.array(names[source[lo:hi]].tolist(), pa.string())),
                    pa.ListArray.from_arrays(offsets, pa.array(self.counts[0][lo:hi])),
                ], ["lang", "term", "docs", "sources", "counts"])
        met: dict[str, list[str]] = {}
        for lang, source in sorted(self.groups):
            met.setdefault(lang, []).append(source)
        if met:
            yield pa.RecordBatch.from_arrays([
                pa.array(list(met), pa.string()), pa.nulls(len(met), pa.string()), pa.array([0] * len(met), pa.int64()),
                pa.array(list(met.values()), pa.list_(pa.string())),
                pa.array([[0] * len(s) for s in met.values()], pa.list_(pa.int64())),
            ], ["lang", "term", "docs", "sources", "counts"])
        self.__init__()


def _sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Integer sums of ``values`` by their place ``at``."""
    out = np.zeros(n, np.int64)
    np.add.at(out, at, values)
    return out


def _fold_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = Stripes()
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lo, hi, data, offsets in chunks(batch.column(2)):
            held.fold(langs[lo:hi], sources[lo:hi], data, offsets)
            if held.full():
                yield from held.hand_on()
    yield from held.hand_on()


def term_stripes(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``lang, term, docs, counts``: one row per term of a language (all terms),
    ``counts`` the occurrences by source (``source, n``), and one row per language
    with a null term and all its sources."""
    def filled(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    rows = docs.select(filled(lang_col).alias("lang"), filled(source_col).alias("source"), F.col(text_col).cast("string").alias("text"))
    met = rows.mapInArrow(_fold_batches, _STRIPE).repartition("lang", "term")
    # a null source carries the number of documents
    cells = F.concat(F.arrays_zip(F.col("sources").alias("source"), F.col("counts").alias("n")),
                     F.array(F.struct(F.lit(None).cast("string").alias("source"), F.col("docs").alias("n"))))
    summed = met.select("lang", "term", F.explode(cells).alias("c")).groupBy("lang", "term", "c.source").agg(F.sum("c.n").alias("n"))
    return summed.groupBy("lang", "term").agg(
        F.max(F.when(F.col("source").isNull(), F.col("n"))).alias("docs"),
        F.array_sort(F.collect_list(F.when(F.col("source").isNotNull(), F.struct("source", "n")))).alias("counts"))


def shares(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """``1 + floor(SCALE * (counts + 2) / whole)``, three digits at a time, so
    that no product leaves 64 bits."""
    rest, out = counts + 2, np.zeros_like(counts)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, whole)
        out = out * 1000 + digit
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def _emit_batches(groups: dict[str, list[tuple[str, int]]], kept: dict[str, int], top: int):
    """From merged stripes of kept terms to rows ``lang, source, part, item,
    value``: sums over the task's terms for pairs, the task's best terms."""
    whole = {lang: np.array([n for _, n in g], np.int64) + 2 * kept.get(lang, 0) for lang, g in groups.items()}
    all_of = {lang: sum(n for _, n in g) + 2 * kept.get(lang, 0) for lang, g in groups.items()}
    place = {lang: {s: i for i, (s, _) in enumerate(g)} for lang, g in groups.items()}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        best: dict[tuple[str, int], list[tuple[int, bytes]]] = {}

        def rows(lang: list, source: list, part: str, item: list, value: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array([part] * len(lang), pa.string()),
                 pa.array(item, pa.string()), pa.array(value, pa.int64())], ["lang", "source", "part", "item", "value"])

        def pair_rows() -> Iterator[pa.RecordBatch]:
            for lang, total in sums.items():
                names = [s for s, _ in groups[lang]]
                for i, s in enumerate(names):
                    others = [j for j in range(len(names)) if j != i]
                    if others:
                        yield rows([lang] * len(others), [s] * len(others), "pair", [names[j] for j in others], total[i][others].tolist())
            sums.clear()

        def block(lang: str, stripes: pa.RecordBatch) -> None:
            n = len(groups[lang])
            cells = stripes.column(2)
            source = cells.flatten().field("source").dictionary_encode()
            at = np.array([place[lang][x] for x in source.dictionary.to_pylist()], np.int64)
            c = np.zeros((stripes.num_rows, n), np.int64)
            term = np.repeat(np.arange(stripes.num_rows), cells.value_lengths().to_numpy())
            c[term, at[source.indices.to_numpy()]] = cells.flatten().field("n").to_numpy()
            p = shares(c, whole[lang][None, :])
            total = sums.setdefault(lang, np.zeros((n, n), np.int64))
            for i in range(n - 1):
                d = divergence(p[:, i: i + 1], p[:, i + 1:]).sum(axis=0)
                total[i, i + 1:] += d
                total[i + 1:, i] += d
            q = shares(c.sum(axis=1), np.int64(all_of[lang]))[:, None]
            value = np.where((c > 0) & (p > q), divergence(p, q), -1)
            words = stripes.column(1).cast(pa.binary()).to_pylist()
            for s in range(n):
                here = np.flatnonzero(value[:, s] >= 0)
                if len(here) > top:
                    least = np.partition(value[here, s], len(here) - top)[len(here) - top]
                    here = here[value[here, s] >= least]
                if len(here):
                    have = best.setdefault((lang, s), [])
                    have += [(-int(value[t, s]), words[t]) for t in here.tolist()]
                    have.sort()
                    del have[top:]

        for batch in batches:
            code = batch.column(0).dictionary_encode()
            for k, lang in enumerate(code.dictionary.to_pylist()):
                own = np.flatnonzero(code.indices.to_numpy() == k)
                most = max(1, BLOCK_CELLS // len(groups[lang]))
                for a in range(0, len(own), most):
                    block(lang, batch.take(pa.array(own[a: a + most])))
                if sum(x.size for x in sums.values()) > HELD_SUMS:
                    yield from pair_rows()
        yield from pair_rows()
        for (name, s), have in best.items():
            yield rows([name] * len(have), [groups[name][s][0]] * len(have), "term", [w.decode() for _, w in have], [-v for v, _ in have])

    return work


def source_divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                      least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: part ``pair`` has every other
    source of the language with the divergence over all kept terms, part
    ``term`` the ``top`` terms that the source uses more than its language."""
    merged = materialize(term_stripes(docs, lang_col, source_col, text_col).where((F.col("docs") >= least) | F.col("term").isNull()))
    cell = merged.select("lang", "term", F.explode("counts").alias("c"))
    totals = materialize(cell.groupBy("lang", "c.source").agg(F.sum("c.n").alias("n")))
    kept = dict(merged.where("term is not null").groupBy("lang").agg(F.count(F.lit(1))).collect())
    # one row per group: the pairs of the result are as many for every language as these squared
    groups: dict[str, list[tuple[str, int]]] = {}
    for lang, source, n in totals.orderBy("lang", "source").collect():
        groups.setdefault(lang, []).append((source, n))
    schema = "lang string, source string, part string, item string, value long"
    found = merged.where("term is not null").select("lang", "term", "counts").mapInArrow(_emit_batches(groups, kept, top), schema)
    bare = totals.select("lang", "source").alias("a").join(totals.select("lang", F.col("source").alias("item")).alias("b"), "lang").where(
        "source <> item").select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    each = materialize(found.union(bare).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")))
    turn = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = [each.where(F.col("part") == part).withColumn("rank", F.row_number().over(turn)) for part in ("pair", "term")]
    return ranked[0].union(ranked[1].where(F.col("rank") <= top))  # of the terms, a task hands on that many
