"""Exact and near duplicates against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from catchment.llm import exact, neardup

SF = "/root/testdata/sf0.001"


def lower_ascii(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, k):
    w = re.findall("[^\x20\x09-\x0d]+", lower_ascii(text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(sets, percent=80):
    ids = sorted(sets)
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                n = len(sets[a] & sets[b])
                if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def check_near(rows, texts, k):
    sets = {i: shingles(t, k) for i, t in texts.items()}
    want = brute_components(sets)
    assert len(rows) == len(texts)
    for r in rows:
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


def test_near_duplicates_of_the_corpus(docs, corpus):
    check_near(neardup.near_duplicates(docs, k=2).collect(), {r.doc_id: r.text for r in corpus}, 2)


@pytest.mark.parametrize("few_bands", [False, True])
def test_near_duplicates_in_chains(spark, few_bands):
    """Neighbours in a chain are similar, its ends are not: stars alone would
    lose links. One wide bucket (a band of one row) makes further centres."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    texts, base = {}, [rng.choice(words) for _ in range(60)]
    for i in range(40):
        texts[i] = " ".join(base)
        base = list(base)
        base[rng.randrange(60)] = rng.choice(words)
    for i in range(40, 60):
        other = [w if rng.random() < 0.93 else rng.choice(words) for w in texts[0].split()]
        texts[i] = " ".join(other)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    options = {"bands": 40, "rows": 1} if few_bands else {}
    check_near(neardup.near_duplicates(df, k=2, **options).collect(), texts, 2)


def test_near_duplicates_of_growing_texts_in_small_blocks(spark, monkeypatch):
    """Sets that contain each other: similarity is the ratio of their sizes, 0.8
    and just below, across size classes and blocks."""
    monkeypatch.setattr(neardup, "BLOCK_DOCS", 3)
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 400)
    words = [f"w{i}" for i in range(700)]
    texts = {}
    for i, n in enumerate([20, 24, 25, 26, 31, 32, 40, 49, 50, 51, 64, 65, 80, 100, 125, 126, 157, 196, 197, 250, 400, 500, 501, 626]):
        texts[i] = " ".join(words[: n + 1])               # n shingles of two words
        texts[100 + i] = " ".join(words[: n + 1]) + " tail"
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    check_near(neardup.near_duplicates(df, k=2, bands=24, rows=1).collect(), texts, 2)


def test_near_duplicates_awkward(awkward, no_docs):
    rows = neardup.near_duplicates(awkward, k=2).collect()
    assert len(rows) == awkward.count()
    got = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [got[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 9, 10)] == [1, 1, 3, 4, 5, 6, 7, 9, 9]
    assert got[11].component_id == 11 and got[4].n_shingles == 0 and got[7].n_shingles == 1
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    assert neardup.near_duplicates(no_docs).collect() == []
    kept = neardup.keep_one(awkward, k=2)
    assert kept.columns == awkward.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == sorted(
        (i is None, i or 0) for i in (1, 3, 4, 5, 6, 7, 7, 8, 9, 11, None, None))


def test_densified_signatures_agree_with_similarity():
    rng = np.random.default_rng(3)
    hits, pairs = 0, 400
    for _ in range(pairs):
        pool = rng.integers(1, 1 << 63, 12).astype(np.uint64)
        a, b = np.sort(pool[:11]), np.sort(np.concatenate([pool[:10], pool[11:]]))  # similarity 10 / 12
        row = np.repeat([0, 1], 11)
        sig = neardup.signatures(row, np.concatenate([a, b]), 2, 96)
        assert (sig != 0).all()
        hits += (sig[0] == sig[1]).mean()
    assert abs(hits / pairs - 10 / 12) < 0.03


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100)], "a long, b long")
    got = {r.id: r.component for r in neardup.components(links).collect()}
    assert got == {**{i: 1 for i in range(2, 41)}, 101: 100}


def brute_exact(rows):
    groups = {}
    for r in rows:
        groups.setdefault(lower_ascii(r.text), []).append(r.doc_id)
    out = []
    for r in rows:
        ids = groups[lower_ascii(r.text)]
        keep = max((i for i in ids if i is not None), default=None)
        out.append((r.doc_id, keep, len(ids), r.doc_id is not None and r.doc_id == keep,
                    hashlib.sha256(lower_ascii(r.text).encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_duplicates(spark, docs, corpus, awkward, no_docs):
    assert sorted(map(tuple, exact.exact_duplicates(docs).collect()), key=str) == brute_exact(corpus)
    assert sorted(map(tuple, exact.exact_duplicates(awkward).collect()), key=str) == brute_exact(awkward.collect())
    assert exact.exact_duplicates(no_docs).collect() == []


def test_exact_duplicates_of_a_hot_text_and_late_differences(spark):
    texts = [(i, "same " * 700) for i in range(300)]
    texts += [(1000 + i, "a" * 40000 + str(i % 7)) for i in range(30)]
    texts += [(2000 + i, "b" * (31 + i % 3)) for i in range(12)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    got = sorted(map(tuple, exact.exact_duplicates(df).collect()), key=str)
    assert got == brute_exact(df.collect())
    kept = exact.keep_one(df).collect()
    assert len(kept) == 1 + 7 + 3 and {r.doc_id for r in kept} == {t[0] for t in got if t[3]}


def test_keep_one_of_rows_without_ids(spark, awkward, no_docs):
    kept = exact.keep_one(awkward)
    assert kept.columns == awkward.columns
    got = sorted(kept.collect(), key=str)
    assert {lower_ascii(r.text) for r in got} == {lower_ascii(r.text) for r in awkward.collect()}
    assert {r.doc_id for r in got} == {None, 2, 3, 5, 6, 7, 8, 10, 11}
    assert [r.text for r in got if r.doc_id is None] == ["no id here"]
    rows = [(None, "Same", "a"), (None, "same", "b"), (None, "SAME", "a"), (None, "with id", "a"), (4, "With id", "a"), (None, "alone", None)]
    df = spark.createDataFrame(rows * 2 + [(5, "end", "x")], "doc_id long, text string, source string").repartition(3)
    left = exact.keep_one(df.where("text <> 'alone' and doc_id is null or doc_id = 5")).collect()
    assert sorted(lower_ascii(r.text) for r in left) == ["end", "same", "with id"]
    texts = [lower_ascii(r.text) for r in exact.keep_one(df).collect() if r.doc_id is None]
    assert sorted(texts) == ["alone", "same"]
    assert exact.keep_one(no_docs).collect() == []


def test_keep_one_of_rows_alike_in_id_and_text(spark):
    rows = [(1, "Twice in full", "a")] * 2 + [(2, "one text, two sources", "a"), (2, "ONE text, two sources", "b"), (1, "other", "a")]
    rows += [(9, "hot " * 20, "a")] * 400 + [(8, "hot " * 20, "a")] * 3 + [(3, "once", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    got = sorted((r.doc_id, lower_ascii(r.text)) for r in exact.keep_one(df).collect())
    assert got == [(1, "other"), (1, "twice in full"), (2, "one text, two sources"), (3, "once"), (9, "hot " * 20)]
    assert sorted(map(tuple, exact.exact_duplicates(df).collect()), key=str) == brute_exact(df.collect())


def test_exact_duplicates_of_groups_with_one_largest_id(spark):
    """Texts of one length that differ in the first run only, with the same
    largest id or without ids."""
    texts = [head * 31 + "-" + "same tail " * 10 for head in "abcd"]
    rows = [(i, t) for t in texts[:2] for i in (1, 5)] + [(None, t) for t in texts[2:] for _ in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = exact.exact_duplicates(df).collect()
    assert {r.group_size for r in got} == {2}
    assert sorted(map(tuple, got), key=str) == brute_exact(df.collect())
