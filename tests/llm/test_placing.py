"""Sharding, mixing and packing: exact counts and brute-force versions."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from catchment.llm import mixing, packing, sharding
from catchment.llm.queries import tokenizer_path
from catchment.session import materialize


def count_words(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


# ------------------------------------------------------------ sharding
def test_matrix_has_exact_margins():
    sizes, capacity = np.array([5, 0, 17, 30, 1, 47]), np.array([33, 33, 34])
    m = np.array([sharding.matrix_row(sizes, capacity, i, 7) for i in range(6)])
    assert (m.sum(axis=1) == sizes).all() and (m.sum(axis=0) == capacity).all()


def test_matrix_of_very_many_rows():
    sizes = np.array([10**9, 5 * 10**8, 2 * 10**9, 7])
    capacity = sharding.even_sizes(int(sizes.sum()), 37)
    m = np.array([sharding.matrix_row(sizes, capacity, i, 3) for i in range(4)])
    assert (m.sum(axis=1) == sizes).all() and (m.sum(axis=0) == capacity).all() and (m >= 0).all()
    rows, blocks = 10**11, sharding.MOST_BLOCKS
    one = sharding.matrix_row(sharding.even_sizes(rows, 4096), sharding.even_sizes(rows, blocks), 777, 42)
    mean = rows / 4096 / blocks
    assert one.sum() == sharding.even_sizes(rows, 4096)[777] and abs(one.mean() - mean) < 0.1
    assert abs(one.var() / mean - 1) < 0.02  # nearly Poisson: a task has few of a block's rows


def test_split_over_a_tree_is_hypergeometric(monkeypatch):
    monkeypatch.setattr(sharding, "_EXACT_LIMIT", 30)  # scalar draws near the root, numpy's below
    draws = np.array([sharding._split(np.random.default_rng(s), np.array([20, 5, 0, 15, 10]), 25) for s in range(4000)])
    assert (draws.sum(axis=1) == 25).all() and (draws <= [20, 5, 0, 15, 10]).all() and (draws[:, 2] == 0).all()
    assert np.abs(draws.mean(axis=0) - np.array([10, 2.5, 0, 7.5, 5])).max() < 0.15
    assert abs(draws[:, 0].var() - 25 * 0.4 * 0.6 * 25 / 49) < 0.2


def test_uncounted_rows_are_an_error(spark, monkeypatch):
    df = spark.range(40, numPartitions=4).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    grown = df.select("doc_id", "text", F.spark_partition_id().alias("p"))
    real = type(df).collect

    def fewer(self):
        rows = real(self)
        return rows[:-1] if "count" in self.columns else rows

    monkeypatch.setattr(type(df), "collect", fewer)
    with pytest.raises(Exception, match="not counted"):
        sharding.shard_documents(grown, 3, stored=True).toPandas()


def test_matrix_is_hypergeometric():
    draws = np.array([sharding.matrix_row(np.array([10, 30]), np.array([20, 20]), 0, s)[0] for s in range(3000)])
    assert abs(draws.mean() - 5) < 0.12  # mean 5, variance 10 * .25 * 30 / 39
    assert abs(draws.var() - 10 * 0.25 * 30 / 39) < 0.2


def test_large_hypergeometric_has_the_right_moments():
    rng = np.random.default_rng(1)
    good, bad, n = 3 * 10**9, 10**9, 10**6
    draws = np.array([sharding._hypergeometric(rng, good, bad, n) for _ in range(300)])
    assert abs(draws.mean() - 750_000) < 150 and 330 < draws.std() < 540


def check_shards(rows, n, shards):
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert len(rows) == n
    assert sorted(len(by[s]) for s in range(shards)) == sorted(n // shards + (s < n % shards) for s in range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_shards(spark, docs, corpus, awkward, no_docs, monkeypatch):
    monkeypatch.setattr(sharding, "BLOCK_ROWS", 7)
    for df, source in ((docs, corpus), (awkward, awkward.collect())):
        rows = sharding.shard_documents(df, 8).collect()
        check_shards(rows, len(source), 8)
        want = sorted((r.doc_id or -1, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in source)
        assert sorted((r.doc_id or -1, r.size, r.text_crc32) for r in rows) == want
    assert sharding.shard_documents(no_docs, 8).collect() == []


def test_shards_repeat_and_mix(spark):
    df = materialize(spark.range(4000, numPartitions=5).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")))
    a, b = (sharding.shard_documents(df, 4, seed=3, stored=True).collect() for _ in range(2))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))
    where = np.zeros(4000)
    for r in a:
        where[r.doc_id] = r.shard * 1000 + r.slot
    assert abs(np.corrcoef(np.arange(4000), where)[0, 1]) < 0.06
    part = Counter(r.shard for r in a if r.doc_id < 800)  # rows of one partition
    assert all(150 < part[s] < 250 for s in range(4))


# ------------------------------------------------------------ mixing
def brute_targets(sizes, weights=(5, 2, 1), share=1.5, limit=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, out, open_ = share * sum(sizes.values()), {}, set(order)
    while open_:
        rest = total - sum(out.values())
        level = rest / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > limit * sizes[s]}
        if not over:
            out.update({s: level * w[s] for s in open_})
            break
        out.update({s: limit * sizes[s] for s in over})
        open_ -= over
    return out


def check_mix(rows, source):
    sizes = Counter()
    for r in source:
        sizes[r.source] += count_words(r.text)
    target = brute_targets(dict(sizes))
    of = defaultdict(list)
    for r in source:
        of[(r.doc_id, count_words(r.text))].append(r.source)
    assert len(rows) == len(source)
    taken, longest = Counter(), Counter()
    for r in rows:
        s = of[(r.doc_id, r.size)][0]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 2 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] += r.taken
        longest[s] = max(longest[s], r.size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= longest[s] + 1e-6


def test_mix(docs, corpus, awkward, no_docs):
    first, second = mixing.mix_sources(docs).collect(), mixing.mix_sources(docs.repartition(3)).collect()
    check_mix(first, corpus)
    assert sorted(map(tuple, first)) == sorted(map(tuple, second))
    check_mix(mixing.mix_sources(awkward).collect(), awkward.collect())
    assert mixing.mix_sources(no_docs).collect() == []


def test_mixed_documents_of_repeated_ids_meet_the_targets(spark, awkward, no_docs):
    rows = [(7, f"a b {'cd'[i % 2]}", "hot") for i in range(101)] + [(8, "x y", "b")] * 50 + [(i, "w " * (i % 5), "b") for i in range(20)]
    rows += [(None, "n o", "hot")] * 30 + [(9, "once here", "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    sizes, taken = Counter(), Counter()
    for r in df.collect():
        sizes[r.source] += count_words(r.text)
    got = mixing.mixed_documents(df)
    assert got.columns == df.columns
    got = got.collect()
    for r in got:
        taken[r.source] += count_words(r.text)
    for s, t in brute_targets(dict(sizes)).items():
        assert abs(taken[s] - t) <= 4 + 1e-6
    words = Counter()
    for r in mixing.mix_sources(df).collect():
        words[r.doc_id] += r.taken
    assert words == Counter(r.doc_id for r in got for _ in range(count_words(r.text)))
    again = mixing.mixed_documents(df.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert mixing.mixed_documents(awkward).columns == awkward.columns and mixing.mixed_documents(no_docs).collect() == []


def test_mix_of_many_levels_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    rows = [(i, "w " * (i % 17), "hot" if i % 3 else f"s{i % 5}") for i in range(500)] + [(7, "a b c", "hot")] * 101
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check_mix(mixing.mix_sources(df).collect(), df.collect())


def test_targets_of_sources_that_fill_together(spark):
    for weights in ((1, 1), (5, 2, 1), (3,)):
        sizes = {"a": 150, "b": 150, "c": 60, "d": 24, "e": 0, None: 30}
        df = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r.source: r.target for r in mixing.source_targets(df, weights=weights).collect()}
        assert got == {s: pytest.approx(t) for s, t in brute_targets(sizes, weights).items()}


def test_mix_is_fair(spark):
    """A document of any size is taken about as often as its source asks."""
    rows = [(i, "w " * (1 + 3 * (i % 2)), "a" if i < 60 else "b") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1)
    times = np.zeros(120)
    for seed in range(12):
        for r in mixing.mix_sources(df, seed=seed, weights=(1, 1)).collect():
            times[r.doc_id] += r.taken / r.size / 12
    for part in (slice(0, 120, 2), slice(1, 120, 2)):  # both sources share 1.5 times their sizes evenly
        assert abs(times[part].mean() - 1.5) < 0.08


def test_mixed_documents(awkward, docs, no_docs):
    want = Counter({r.doc_id: r.taken // r.size for r in mixing.mix_sources(docs).collect() if r.size})
    got = Counter(r.doc_id for r in mixing.mixed_documents(docs).collect() if count_words(r.text))
    assert +got == +want
    assert mixing.mixed_documents(awkward).columns == awkward.columns
    assert mixing.mixed_documents(awkward).count() >= 1 and mixing.mixed_documents(no_docs).count() == 0


# ------------------------------------------------------------ packing
def check_packing(rows, source, tok):
    want = Counter()
    for r in source:
        ids = tok.encode(r.text or "", add_special_tokens=False).ids + [1]
        want[(r.doc_id, len(ids))] += 1
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[(r.doc_id, r.doc_tokens)].append((r.start, r.length))
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == want.keys()
    for (_, n), spans in by_doc.items():
        copies = want[(_, n)]
        assert sum(x for _, x in spans) == copies * n
        distinct = sorted(set(spans))
        assert [a for a, _ in distinct] == [0, *np.cumsum([x for _, x in distinct])[:-1]]
    for spans in by_seq.values():
        spans.sort()
        assert [a for a, _ in spans] == [0, *np.cumsum([x for _, x in spans])[:-1].tolist()]
        assert sum(x for _, x in spans) <= 2048
    return sum(r.length for r in rows) / (2048 * len(by_seq))


def test_packing(docs, corpus, awkward, no_docs):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    rows = packing.pack_documents(docs, path).collect()
    assert check_packing(rows, corpus, tok) > 0.95
    texts = {r.doc_id: r.text for r in corpus}
    for r in rows:
        ids = np.array(tok.encode(texts[r.doc_id] or "", add_special_tokens=False).ids + [1], "<u4")
        assert zlib.crc32(ids[r.start: r.start + r.length]) == r.ids_crc32
    check_packing(packing.pack_documents(awkward, path).collect(), awkward.collect(), tok)
    assert packing.pack_documents(no_docs, path).collect() == []


def test_plan_uses_every_piece_once():
    rng = np.random.default_rng(2)
    for histogram in (rng.integers(0, 50, 129), np.eye(129, dtype=int)[100] * 1000, np.eye(129, dtype=int)[1] * 1000,
                      np.zeros(129, int), rng.integers(0, 2, 129) * 10**6):
        histogram[0] = 0
        left = histogram.copy()
        for combo, repeats in packing.plan(histogram):
            assert sum(combo) <= 128 and repeats > 0
            for c in combo:
                left[c] -= repeats
        assert (left == 0).all()


def test_nnls_against_optimality_conditions():
    rng = np.random.default_rng(4)
    for _ in range(20):
        a, b = rng.normal(size=(12, 30)), rng.normal(size=12)
        x = packing.nnls(a, b)
        gain = a.T @ (b - a @ x)
        assert (x >= 0).all() and (gain <= 1e-6).all() and np.abs(gain[x > 0]).max(initial=0) < 1e-6
