"""Vector codes, document fingerprints and source divergence against brute force."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catchment.llm import codes, digest, divergence
from catchment.llm.text import mix


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


# ------------------------------------------------------------ vector codes
def brute_codes(rows, parts=8, entries=16, rounds=6):
    """(id, code, error, label error, digest) of (id, vector, label) rows."""
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for size in {len(v) for _, v, _ in kept}:
        wide = -(-size // parts)
        own = [(i, [(v + [0] * (wide * parts - size))[p * wide: (p + 1) * wide] for p in range(parts)], label) for i, v, label in kept if len(v) == size]
        own.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        books = [[r[1][p] for r in own[:entries]] for p in range(parts)]

        def nearest(x, book):
            return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

        for _ in range(rounds):
            for p in range(parts):
                near = defaultdict(list)
                for _, v, _ in own:
                    near[nearest(v[p], books[p])[1]].append(v[p])
                books[p] = [[sum(c) // len(near[e]) for c in zip(*near[e])] if near[e] else books[p][e] for e in range(len(books[p]))]
        sha = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
        for i, v, label in own:
            found = [nearest(v[p], books[p]) for p in range(parts)]
            out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label, sha))
    total = Counter()
    for _, _, error, label, _ in out:
        total[label] += error
    return [(i, code, error, total[label], sha) for i, code, error, label, sha in out]


def check_codes(df, rows, **options):
    key = lambda t: tuple(str(x) for x in t)
    got = codes.compress_vectors(df, **options).collect()
    assert sorted(map(tuple, got), key=key) == sorted(brute_codes(rows, **options), key=key)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y") for i, v, label in rows],
                                 "vec_id long, embedding array<double>, label int, code string, size string").repartition(3)


def test_vector_codes(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=24)], int(rng.integers(0, 4))) for i in range(300)]
    rows += [(400 + i, rows[5][1], None) for i in range(150)]  # one common vector, labels null
    rows += [(5, rows[9][1], 1), (5, rows[8][1], 2), (None, rows[3][1], 7), (900, None, 1), (901, [None] * 24, 1),
             (902, [math.nan] * 24, 1), (903, [math.inf] * 24, 1), (904, [0.0] * 24, 3), (-5, [-1e-9] * 24, 3), (905, [1000.5] * 24, 9)]
    rows += [(1000 + i, [float(i), -float(i)], 5) for i in range(5)] + [(1100, [], 5), (1101, [0.25] * 9, None)]
    check_codes(vectors(spark, rows), rows)


def test_vector_codes_with_many_entries_and_few_vectors(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=6)], 0) for i in range(400)]
    check_codes(vectors(spark, rows), rows, parts=3, entries=150, rounds=2)  # masks of several words
    check_codes(vectors(spark, rows[:7]), rows[:7])
    check_codes(vectors(spark, rows[:1] * 4), rows[:1] * 4)
    assert codes.compress_vectors(vectors(spark, rows).limit(0)).collect() == []


def test_vector_codes_of_the_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    check_codes(df, [(r.vec_id, list(r.embedding), r.label) for r in df.collect()])


def test_components_stop(spark):
    rows = [(1, [1e30, -1e30], 1), (2, [1.0, 2.0], 1)]
    got = {r.vec_id: r for r in codes.compress_vectors(vectors(spark, rows)).collect()}
    assert got[1].error == got[2].error == 0 and got[1].code != got[2].code


def test_slices_keep_every_nearest_entry():
    rng = np.random.default_rng(1)
    for n, width in ((1, 1), (16, 8), (70, 3), (200, 5)):
        book = rng.integers(-50, 50, (n, width))
        book[n // 2] = book[0]  # equal entries
        x = np.concatenate([rng.integers(-60, 60, (500, width)), book])
        s = codes.Slices(book)
        far = ((x[:, None] - book[None]) ** 2).sum(axis=2)
        at, best = s.nearest(x)
        assert (at == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()
        found = s.candidates(x)
        bits = (found[:, np.arange(n) // 64] >> (np.arange(n) % 64).astype(np.uint64)) & np.uint64(1)
        assert (bits[far == far.min(axis=1, keepdims=True)] == 1).all()
        if n > 16:
            assert bits.mean() < 0.8  # few are measured


def test_codes_decode(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=16)], 0) for i in range(40)]
    ints = codes.integer_vectors(vectors(spark, rows))
    books = codes.train_codebooks(ints)
    x = {r.id: np.array(r.x) for r in ints.collect()}
    for r in codes.encode(ints, books).collect():
        assert ((codes.decode(r.code, books[16]) - x[r.id]) ** 2).sum() == r.error


# ------------------------------------------------------------ fingerprints
def entropy_bin(window):
    s = sum(int(digest._COUNTED[c]) for c in Counter(window).values())
    return min((digest._FULL - s) // (digest._FULL // digest.BINS), digest.BINS - 1)


def brute_features(raw, rank):
    w, run = digest.WINDOW, digest.RUN
    if not raw:
        return []
    bins = [entropy_bin(raw[i:i + w]) for i in range(len(raw) - w + 1)]
    if len(bins) < run:
        at = [min(range(len(bins)), key=lambda i: (rank[bins[i]], i))] if bins else [0]
    else:
        vote = Counter(min(range(a, a + run), key=lambda i: (rank[bins[i]], i)) for a in range(len(bins) - run + 1))
        at = sorted(i for i, n in vote.items() if n >= digest.POPULAR) or [min(vote, key=lambda i: (-vote[i], i))]
    return list(dict.fromkeys(raw[i:i + w] for i in at))


def feature_hash(f):
    h = mix(np.array([len(f)], np.uint64))
    for word in np.frombuffer(f.ljust(digest.WINDOW, b"\0"), "<u8"):
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + word)
    return int(h[0])


def brute_digest(raw, rank):
    found = brute_features(raw, rank)
    out = []
    for a in range(0, len(found), digest.PER_FILTER):
        bits = 0
        for f in found[a:a + digest.PER_FILTER]:
            for i in range(digest.BITS):
                bits |= 1 << (feature_hash(f) >> (11 * i)) % digest.FILTER
        out.append(bits)
    return out, len(found)


def as_text(d):
    return f"{d[1]:x}:" + b"".join(x.to_bytes(digest.FILTER // 8, "little") for x in d[0]).hex()


def brute_likeness(a, b):
    if not a[1] or not b[1]:
        return float(a[1] == b[1])
    a, b = sorted((a, b), key=lambda x: (len(x[0]), x[1]))
    total = 0
    for k, x in enumerate(a[0]):
        best = 0
        for y in b[0]:
            chance = x.bit_count() * y.bit_count() / digest.FILTER
            best = max(best, ((x & y).bit_count() - chance) / (min(x.bit_count(), y.bit_count()) - chance))
        total += best * (digest.PER_FILTER if k < len(a[0]) - 1 else a[1] - digest.PER_FILTER * k)
    return total / a[1]


def brute_pairs(rows):
    """(id, text) rows with distinct keys (id, text) up to order among equals."""
    counts = Counter(entropy_bin(raw[i:i + digest.WINDOW]) for _, t in rows for raw in [(t or "").encode()] for i in range(len(raw) - digest.WINDOW + 1))
    rank = digest.ranks(np.array([counts[b] for b in range(digest.BINS)]))
    made = {}

    def digest_of(text):
        if text not in made:
            made[text] = brute_digest(text.encode(), rank)
        return made[text]

    out = []
    for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        new = t[:len(t) - half] + nxt[:half]
        d, e = digest_of(t), digest_of(new)
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), as_text(d), as_text(e), brute_likeness(d, e), brute_likeness(d, digest_of(nxt))))
    return out


def check_pairs(got, rows):
    want = brute_pairs(rows)
    key = lambda t: (t[0] is not None, t[0] or 0, t[2], t[3])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [x for g in got for x in g[5:]] == pytest.approx([x for w in want for x in w[5:]], abs=1e-9)
    return got


def test_fingerprints_of_the_corpus(docs, corpus):
    got = check_pairs(digest.neighbour_digests(docs, stored=True).collect(), sorted((r.doc_id, r.text or "") for r in corpus))
    assert np.mean([g[5] > g[6] for g in got if g[1] > 200]) > 0.95
    assert np.median([g[5] for g in got]) > 0.4 and np.median([g[6] for g in got]) < 0.1


def spark_hash_order(spark, rows):
    df = spark.createDataFrame([(k, i, t) for k, (i, t) in enumerate(rows)], "k long, id long, text string")
    order = {r.k: r.h for r in df.select("k", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect()}
    keyed = [((i is not None, i or 0, order[k]), (i, t or "")) for k, (i, t) in enumerate(rows)]
    return [r for _, r in sorted(keyed, key=lambda x: x[0])]


def test_fingerprints_of_awkward_texts(spark, awkward, no_docs, monkeypatch):
    monkeypatch.setattr(digest, "RANGE_BYTES", 300)
    rows = [(r.doc_id, r.text[:3000] if r.text else r.text) for r in awkward.collect()]
    rows += [(50, "same id, text " + "abc" * k) for k in range(40)] + [(51, "the same row " * 9)] * 30 + [(52, "x" * n) for n in range(1, 60, 7)]
    df = spark.createDataFrame([(i, t, "a", "b") for i, t in rows], "doc_id long, text string, at string, row string").repartition(5)
    check_pairs(digest.neighbour_digests(df).collect(), spark_hash_order(spark, rows))
    assert digest.neighbour_digests(no_docs).collect() == []
    alone = digest.neighbour_digests(spark.createDataFrame([(3, "only one of its kind here")], "doc_id long, text string")).collect()
    check_pairs(alone, [(3, "only one of its kind here")])
    assert alone[0].near_next == 1.0
    empty = digest.neighbour_digests(spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")).collect()
    assert [(r.fingerprint, r.near_edited, r.near_next) for r in empty] == [("0:", 1.0, 1.0)] * 2


def test_blocks_and_long_texts_give_the_same_features(monkeypatch):
    rng = np.random.default_rng(2)
    texts = ["".join(rng.choice(list("abcdefgh  .é"), n)).encode() for n in (5000, 3, 0, 40, 9000, 16, 47, 48)]
    rank = digest.ranks(rng.integers(0, 50, digest.BINS))
    whole = [digest.text_of(*d) for d in digest.Digests(rank).of(texts)]
    assert whole == [as_text(brute_digest(t, rank)) for t in texts]
    monkeypatch.setattr(digest, "_BLOCK", 100)
    assert whole == [digest.text_of(*d) for d in digest.Digests(rank).of(texts)]
    assert all(digest.text_of(*digest.from_text(x)) == x for x in whole)


def test_ranges_cut_by_bytes(spark):
    rows = [(i, "word " * 20) for i in range(200)] + [(500, f"text {k} " * 10) for k in range(300)]
    df = spark.createDataFrame(rows, "id long, text string").repartition(4)
    df = df.withColumns({"tie": F.xxhash64("text"), "row": F.monotonically_increasing_id()})
    begins = digest.ranges(df, 200)
    assert begins[0][:2] == (True, 0) and begins == sorted(set(begins))
    assert sum(k[1] == 500 for k in begins) >= 1  # the repeated id is cut as well


# ------------------------------------------------------------ divergence
def brute_divergence(rows, least=10, top=10):
    docs, counts, groups = defaultdict(set), Counter(), defaultdict(set)
    for k, (text, lang, source) in enumerate(rows):
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower_ascii(text or "")):
            docs[lang, t].add(k)
            counts[lang, source, t] += 1
    out = []
    for lang, sources in groups.items():
        kept = [t for (g, t), d in docs.items() if g == lang and len(d) >= least]

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        own = {s: {t: counts[lang, s, t] for t in kept} for s in sources}
        p = {s: shares(c) for s, c in own.items()}
        q = shares({t: sum(own[s][t] for s in sources) for t in kept})

        def f(x, y):
            return (x - y) * (x - y) // (x + y)

        for s in sources:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode()) for o in sources if o != s)
            out += [(lang, s, "pair", o.decode(), -v, i + 1) for i, (v, o) in enumerate(pairs)]
            strong = sorted((-f(p[s][t], q[t]), t.encode()) for t in kept if own[s][t] and p[s][t] > q[t])
            out += [(lang, s, "term", t.decode(), -v, i + 1) for i, (v, t) in enumerate(strong[:top])]
    return sorted(out)


def check_divergence(df, **options):
    want = brute_divergence([(r.text, r.lang, r.source) for r in df.collect()], **options)
    assert sorted(map(tuple, divergence.source_divergence(df, **options).collect())) == want
    return want


def test_divergence(docs, awkward, no_docs):
    assert len(check_divergence(docs)) > 100
    check_divergence(awkward, least=2, top=3)
    assert {r.value for r in divergence.source_divergence(awkward).collect()} == {0}  # no term is kept
    assert divergence.source_divergence(no_docs).collect() == []


@pytest.mark.parametrize("small", [False, True])
def test_divergence_of_small_stores_and_one_hot_source(spark, monkeypatch, small):
    if small:
        for name, value in (("HELD_STRIPES", 5), ("HELD_COUNTS", 7), ("BLOCK_CELLS", 6), ("HELD_SUMS", 3)):
            monkeypatch.setattr(divergence, name, value)
    rng = np.random.default_rng(8)
    words = ["Ab", "ab", "é", "É", "x1y", "a\x00b", "日本", "a-b", "Ä_ö", "zz", "q" * 300, "\u0085", "", "\U0001f600"]
    rows = [(" ".join(rng.choice(words, 6)), "l1" if i % 3 else None, "hot" if i % 2 else f"s{i % 7}") for i in range(400)]
    rows += [(None, "l1", "silent"), ("", "l2", "x"), ("", "l2", None), ("once", "l3", "y"), ("ab " * 2000, "l1", "hot")]
    check_divergence(spark.createDataFrame(rows, "text string, lang string, source string").repartition(3))


def test_shares_are_exact_for_large_counts():
    counts = np.array([0, 1, 10**6, 9 * 10**15 - 2, 123456789012345], np.int64)
    whole = np.int64(9 * 10**15 + 12345)
    assert divergence.shares(counts, whole).tolist() == [1 + 10**9 * (int(c) + 2) // int(whole) for c in counts]


def test_terms_are_cut_by_rows_and_bytes():
    rows = ["Ab1ab", "", "ab", "é_É", "x"]
    raw = [r.encode() for r in rows]
    found, before = divergence.terms(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert found.cast(pa.large_binary()).to_pylist() == [w.encode() for w in ("ab", "ab", "ab", "é", "É", "x")]
    assert before.tolist() == [0, 2, 2, 3, 5, 6]
