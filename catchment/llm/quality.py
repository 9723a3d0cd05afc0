"""Quality by co-training: two classifiers see different views of a document.

The content view is the text: hashed byte pairs and measures of style (letter,
capital, digit and symbol shares, word lengths, repetition). The metadata view
is the other columns: language, source and length. Both are logistic models
fitted on labelled documents. In each round, each view is calibrated on
held-out labels, names the unlabelled documents it is surest of, at least
``SURE`` sure, and hands them to the other as pseudo-labels. At the end both
views' calibrated log odds are combined by weights fitted on the held-out
labels, and every document is scored from its whole text.

Fitting uses at most ``FIT_LABELLED`` labelled documents, taken by hash of the
id, half of them of each class where there are as many (the rest from the other
class; calibration weighs them back to the shares of all labels), and the pseudo-labelled ones, at most ``PER_ROUND`` per view and round. In
each round every unlabelled row is scored by both views in one pass, and the
surest are a distributed top-k over all of them, ties by hash. Scoring covers
every row in one pass without a shuffle, and the model's size is fixed.

Defined results. Rows without a given label, also those with a null id, are
unlabelled; unlabelled rows alike in id, text and metadata are named once. Labels whose quality is null are ignored, and ids with
contradicting labels count as bad. Without labels of both kinds, every document
scores 1 and stays. A null text is empty. Null metadata is a value of its own;
a missing metadata column counts as null. Repeated rows score alike; an empty
table gives an empty result. Columns of the input that have a result column's
name are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .shared import by_position
from .text import _SPACE, chunks, hash_spans, mix, words

# Labelled documents that the fit uses at most, and the share of labels held out.
FIT_LABELLED = 6_000
HELD_OUT = 5
ROUNDS = 3
PER_ROUND = 400
SURE = 0.95
# Documents below this combined probability of being good are rejected.
THRESHOLD = 0.35

PAIRS = 1024
STYLE = 14
CONTENT = PAIRS + STYLE
META = 96

_KIND = np.zeros(256, np.int64)  # 0 space, 1 lower, 2 upper, 3 digit, 4 symbol, 5 beyond ASCII
_KIND[:] = 4
_KIND[_SPACE] = 0
_KIND[0x61:0x7B] = 1
_KIND[0x41:0x5B] = 2
_KIND[0x30:0x3A] = 3
_KIND[0x80:] = 5
_PAIR_CELL = (mix(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(PAIRS)).astype(np.int64)
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[ord(c) for c in ".,;:'\"-()"]] = True


def content_features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of content features per text."""
    n = len(offsets) - 1
    out = np.zeros((n, CONTENT), np.float32)
    if not len(data):
        return out
    row = np.repeat(np.arange(n), np.diff(offsets))
    size = np.maximum(np.diff(offsets), 1)
    cell = row[:-1] * PAIRS + _PAIR_CELL[data[:-1].astype(np.uint16) << 8 | data[1:]]
    counts = np.bincount(cell, minlength=n * PAIRS)
    np.subtract.at(counts, cell[np.flatnonzero(row[:-1] != row[1:])], 1)  # pairs over the edge of two texts
    counts = counts.reshape(n, PAIRS)
    out[:, :PAIRS] = np.sqrt(counts / size[:, None]) * 4  # Hellinger scaling
    byte = np.bincount(row * 256 + data, minlength=n * 256).reshape(n, 256)
    kinds = byte @ (_KIND[:, None] == np.arange(6)) / size[:, None]
    plain = byte @ _PUNCTUATION / size
    lines = byte[:, 10] / size
    start, end, before = words(data, offsets)
    count = np.diff(before)
    safe = np.maximum(count, 1)
    owner = np.repeat(np.arange(n), count)
    length = (end - start).astype(np.float64)
    mean = np.bincount(owner, weights=length, minlength=n) / safe
    spread = np.sqrt(np.maximum(np.bincount(owner, weights=length ** 2, minlength=n) / safe - mean ** 2, 0))
    h = hash_spans(data, start, end)
    repeat = np.zeros(len(h))
    if len(h) > 1:
        repeat[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    _, first = np.unique(h + mix(owner.astype(np.uint64)), return_index=True)
    distinct = np.bincount(owner[first], minlength=n) / safe
    symbol_words = np.bincount(owner, weights=_KIND[data[start]] == 4, minlength=n) / safe if len(start) else np.zeros(n)
    style = [*kinds.T, plain, lines * 10, mean / 10, spread / 10, np.bincount(owner, weights=repeat, minlength=n) / safe,
             distinct, symbol_words, np.log1p(count) / 10]
    out[:, PAIRS:] = np.stack(style, axis=1)
    return out


def meta_features(lang: list, source: list, n_chars: list) -> np.ndarray:
    """One row of metadata features per document."""
    out = np.zeros((len(lang), META), np.float32)
    for i, (a, b, c) in enumerate(zip(lang, source, n_chars)):
        out[i, _bucket("lang", a, 16)] = 1
        out[i, 16 + _bucket("source", b, 64)] = 1
        size = 0 if c is None else max(float(c), 0.0)
        out[i, 80] = c is None
        out[i, 81 + min(14, int(np.log2(size + 1)))] = 1
    return out


@lru_cache(maxsize=1 << 16)
def _bucket(kind: str, value, size: int) -> int:
    raw = np.frombuffer(f"{kind}:{value!r}".encode(), np.uint8)
    return int(hash_spans(raw, np.array([0]), np.array([len(raw)]))[0] % np.uint64(size))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-3, steps: int = 300) -> np.ndarray:
    """Weights (the last is the intercept) by accelerated gradient descent."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)])
    weight = (weight / weight.sum()).astype(x.dtype)
    v = np.ones(x.shape[1], x.dtype)
    for _ in range(20):  # largest curvature by power iteration
        v = x.T @ (weight * (x @ (v / np.linalg.norm(v))))
    top = 1.1 * float(np.linalg.norm(v)) / 4 + l2
    w = v = np.zeros(x.shape[1], x.dtype)
    for t in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        new = v - (x.T @ (weight * (p - y)).astype(x.dtype) + x.dtype.type(l2) * v) / x.dtype.type(top)
        v, w = new + x.dtype.type(t / (t + 3)) * (new - w), new
    return w


def _logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return x @ w[:-1] + w[-1]


def _chance(x: np.ndarray, w: np.ndarray, calibration: np.ndarray) -> np.ndarray:
    """A view's calibrated probabilities of being good."""
    return 1 / (1 + np.exp(-np.clip(_logit(_logit(x, w)[:, None], calibration), -30, 30)))


# Given both views' weights and calibrations: for each view, the features (in
# that view) and labels of the documents that the other view newly names.
Naming = Callable[[list, list], list[tuple[np.ndarray, np.ndarray]]]


def name_rows(views: list[np.ndarray], per_round: int, sure: float) -> Naming:
    """Names the surest of unlabelled documents that are at hand as arrays."""
    given = [np.zeros(len(x), bool) for x in views]

    def name(fitted: list, calibrated: list) -> list[tuple[np.ndarray, np.ndarray]]:
        out = []
        for i in (0, 1):
            p = _chance(views[1 - i], fitted[1 - i], calibrated[1 - i])
            free, at, labels = ~given[i], [], []
            for label, chance in ((1.0, p), (0.0, 1 - p)):
                able = np.flatnonzero(free & (chance >= sure))
                at.append(able[np.argsort(-chance[able], kind="stable")[: per_round // 2]])
                labels.append(np.full(len(at[-1]), label))
            at = np.concatenate(at)
            given[i][at] = True
            out.append((views[i][at], np.concatenate(labels)))
        return out

    return name


def co_train(content: np.ndarray, meta: np.ndarray, y: np.ndarray, held: np.ndarray, rounds: int = ROUNDS,
             per_round: int = PER_ROUND, sure: float = SURE, name: Naming | None = None,
             stands: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Content weights, metadata weights and the weights that combine their
    logits. ``y`` is 1, 0 or NaN (unlabelled); ``held`` marks held-out labels.
    ``name`` names unlabelled documents that are elsewhere; without it they are
    the rows whose ``y`` is NaN. ``stands``: of how many labels each is a sample."""
    pool = np.isnan(y)
    name = name or name_rows([content[pool], meta[pool]], per_round, sure)
    own, known = ~pool & ~held, ~pool & held
    stands = (np.ones(len(y)) if stands is None else stands)[known]
    given = [[(x[own], y[own])] for x in (content, meta)]
    for r in range(rounds + 1):
        fitted, calibrated = [], []
        for x, rows in zip((content, meta), given):
            at, labels = (np.concatenate(part) for part in zip(*rows))
            share = labels.mean()
            weight = np.where(labels == 1, 0.5 / max(share, 1e-6), 0.5 / max(1 - share, 1e-6))
            fitted.append(fit_logistic(at, labels, weight))
            z = _logit(x[known], fitted[-1])
            calibrated.append(fit_logistic(z[:, None], y[known], stands, l2=1e-4))
        if r == rounds:
            break
        for rows, named in zip(given, name(fitted, calibrated)):
            rows.append(named)
    logits = np.stack([_logit(x[known], w) for x, w in zip((content, meta), fitted)], axis=1)
    combine = fit_logistic(logits, y[known], stands, l2=1e-4)
    return fitted[0], fitted[1], combine


def _columns(docs: DataFrame, id_col: str, text_col: str, at: dict[str, str] | None = None) -> list:
    """What the views read; ``at`` names the columns of ``docs`` that hold the
    given ones (by themselves unless told otherwise)."""
    at = at or {c: f"`{c}`" for c in docs.columns}

    def meta(name: str, kind: str):
        return F.col(at[name]).cast(kind) if name in at else F.lit(None).cast(kind)

    return [F.col(at[id_col]).cast("long").alias("_id"), F.col(at[text_col]).alias("_text"), meta("lang", "string").alias("_lang"),
            meta("source", "string").alias("_source"), meta("n_chars", "double").alias("_chars")]


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both views' features of rows of ``_columns``, and the columns after them."""
    for batch in batches:
        for lo, hi, data, offsets in chunks(batch.column(1)):
            part = batch.slice(lo, hi - lo)
            x = content_features(data, offsets)
            m = meta_features(*(part.column(i).to_pylist() for i in (2, 3, 4)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *part.columns[5:], pa.array([r.tobytes() for r in x], pa.binary()),
                 pa.array([r.tobytes() for r in m], pa.binary())], ["id", *batch.schema.names[5:], "content", "meta"])


def _name_documents(rows: DataFrame, truth: DataFrame, per_round: int, sure: float, seed: int) -> Naming:
    """Names the surest of all ``rows`` (``_columns``) whose id ``truth`` lacks."""
    rows = rows.withColumn("_mark", F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in ("_text", "_lang", "_source", "_chars")]))
    named: list[DataFrame] = []  # what each round named, at most 2 * per_round rows

    def name(fitted: list, calibrated: list) -> list[tuple[np.ndarray, np.ndarray]]:
        w, c = [v.astype(np.float64) for v in fitted], [v.astype(np.float64) for v in calibrated]

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi, data, offsets in chunks(batch.column(1)):
                    part = batch.slice(lo, hi - lo)
                    x = content_features(data, offsets).astype(np.float64)
                    m = meta_features(*(part.column(i).to_pylist() for i in (2, 3, 4))).astype(np.float64)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(5), pa.array(_chance(x, w[0], c[0])), pa.array(_chance(m, w[1], c[1]))],
                        ["_id", "_mark", "p0", "p1"])

        scored = rows.mapInArrow(score, "_id long, _mark long, p0 double, p1 double")
        able = scored.where(" or ".join(f"p{i} >= {sure!r} or 1 - p{i} >= {sure!r}" for i in (0, 1)))
        able = materialize(able.join(truth, "_id", "left_anti").groupBy("_id", "_mark").agg(F.min("p0").alias("p0"), F.min("p1").alias("p1")), few=True)
        turn, picks = F.xxhash64("_id", "_mark", F.lit(seed)), []
        for i in (0, 1):
            free = able
            for before in named:
                b = before.where(F.col("to") == i).select(F.col("_id").alias("i"), F.col("_mark").alias("k"))
                free = free.join(F.broadcast(b), F.col("_id").eqNullSafe(F.col("i")) & (F.col("_mark") == F.col("k")), "left_anti")
            for label, chance in ((1.0, F.col(f"p{1 - i}")), (0.0, 1 - F.col(f"p{1 - i}"))):
                picks.append(free.where(chance >= sure).orderBy(chance.desc(), turn, "_id", "_mark").limit(per_round // 2).select(
                    "_id", "_mark", F.lit(i).alias("to"), F.lit(label).alias("y")))
        named.append(materialize(picks[0].union(picks[1]).union(picks[2]).union(picks[3])))
        p = named[-1].select(F.col("_id").alias("i"), F.col("_mark").alias("k"), "to", "y")
        found = rows.join(F.broadcast(p), F.col("_id").eqNullSafe(F.col("i")) & (F.col("_mark") == F.col("k"))).drop("i", "k")
        got = found.mapInArrow(_features, "id long, _mark long, to int, y double, content binary, meta binary").collect()
        got = sorted({(r.to, r.id is None, r.id or 0, r._mark): r for r in got}.items())
        out = []
        for i, (view, size) in enumerate((("content", CONTENT), ("meta", META))):
            mine = [r for key, r in got if key[0] == i]
            x = np.frombuffer(b"".join(r[view] for r in mine), np.float32).reshape(len(mine), size)
            out.append((x, np.array([r.y for r in mine], np.float64)))
        return out

    return name


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          seed: int = 42, fit_labelled: int = FIT_LABELLED, per_round: int = PER_ROUND, sure: float = SURE) -> dict | None:
    """The model, or None without labels of both kinds. At most ``fit_labelled``
    labelled documents are fitted, and in each round the ``per_round`` surest
    unlabelled documents for either view, of those surer than ``sure``."""
    turn = F.xxhash64("_id", F.lit(seed))
    truth = labels.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).alias("y")).where(
        "_id is not null and y is not null").groupBy("_id").agg((F.min(F.col("y").cast("double")) > 0).cast("double").alias("y"))
    truth = materialize(truth, few=True)
    ids = docs.select(F.col(id_col).cast("long").alias("_id")).where("_id is not null")
    present = materialize(truth.join(ids, "_id", "left_semi"), few=True)
    count = {label: n for label, n in present.groupBy("y").count().collect()}  # two rows at most
    bad, good = count.get(0.0, 0), count.get(1.0, 0)
    if min(bad, good) < 2:
        return None
    half = fit_labelled // 2
    take = {0.0: min(bad, max(half, fit_labelled - good)), 1.0: min(good, max(half, fit_labelled - bad))}
    of_bad, of_good = (present.where(F.col("y") == label).orderBy(turn, "_id").limit(n) for label, n in take.items())
    chosen = of_bad.union(of_good)
    rows = docs.select(*_columns(docs, id_col, text_col))
    got = rows.join(F.broadcast(chosen), "_id").mapInArrow(
        _features, "id long, y double, content binary, meta binary").toPandas()
    got = got.sort_values(["id", "content"]).drop_duplicates("id")
    y = got["y"].to_numpy(np.float64, na_value=np.nan)
    content = np.stack([np.frombuffer(b, np.float32) for b in got["content"]])
    meta = np.stack([np.frombuffer(b, np.float32) for b in got["meta"]])
    held = np.zeros(len(y), bool)
    for label in (0.0, 1.0):  # every HELD_OUT-th label of each kind, in hashed order
        at = np.flatnonzero(y == label)
        at = at[np.argsort(mix(got["id"].to_numpy(np.int64)[at].view(np.uint64)))]
        held[at[::HELD_OUT]] = True
    c, m, combine = co_train(content, meta, y, held, name=_name_documents(rows, truth, per_round, sure, seed),
                            stands=np.where(y == 1, good / take[1.0], bad / take[0.0]))
    return {"content": c, "meta": m, "combine": combine}


_RESULT = {"content_score": "double", "meta_score": "double", "quality_score": "double", "kept": "boolean"}


def score_documents(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``content_score``, ``meta_score`` (log odds of the views),
    ``quality_score`` (combined probability) and ``kept``, which replace columns
    of these names."""
    base = docs.drop(*_RESULT)
    return _scored(base, model, id_col, text_col, threshold).toDF(*base.columns, *_RESULT)


def _scored(base: DataFrame, model: dict | None, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """The columns of ``base`` by position, and those of ``_RESULT``."""
    own, names = by_position(base)
    if model is None:
        return own.withColumns({
            "content_score": F.lit(0.0), "meta_score": F.lit(0.0), "quality_score": F.lit(1.0), "kept": F.lit(True)})

    at = dict(zip(base.columns, names))
    k, text = len(names), names.index(at[text_col])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(text)):
                part = batch.slice(lo, hi - lo)
                a = _logit(content_features(data, offsets).astype(np.float64), model["content"])
                b = _logit(meta_features(*(part.column(k + i).to_pylist() for i in (0, 1, 2))).astype(np.float64), model["meta"])
                p = 1 / (1 + np.exp(-np.clip(_logit(np.stack([a, b], axis=1), model["combine"]), -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:k], pa.array(a), pa.array(b), pa.array(p), pa.array(p >= threshold)],
                    [*names, *_RESULT])

    fed = own.select(*names, *_columns(own, id_col, text_col, at)[2:])  # the text is sent once, among the documents' own columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in own.schema.fields)
    return fed.mapInArrow(score, schema + "".join(f", {n} {t}" for n, t in _RESULT.items()))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (same columns) that the co-trained model keeps.
    Further columns may have any name."""
    model = train(docs, labels, id_col, text_col)
    return _scored(docs, model, id_col, text_col, THRESHOLD).where("kept").drop(*_RESULT).toDF(*docs.columns)
