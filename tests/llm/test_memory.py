"""What a Python worker holds of the texts of one batch, and how many files small tables become."""

import glob
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import thue_morse

from catchment.llm import exact, neardup, packing, quality
from catchment.llm.encode import Encoder
from catchment.llm.queries import tokenizer_path
from catchment.llm.shared import BATCH_BYTES, ship_package
from catchment.session import materialize, stored_dir


def test_scoring_gets_the_text_once(spark, docs):
    model = {"content": np.zeros(quality.CONTENT + 1), "meta": np.zeros(quality.META + 1), "combine": np.zeros(3)}
    scored = quality.score_documents(docs, model)
    node = scored._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "MapInArrow":
        node = node.children().head()
    fed = node.children().head()
    assert fed.nodeName() == "Project"
    assert fed.simpleString(1000).count("text#") == 1
    assert scored.count() == docs.count()


def test_encoding_works_on_a_batch_in_small_runs(monkeypatch):
    words = [thue_morse(5)[i: i + 4] + str(i) for i in range(28)]
    texts = [" ".join(words[(i + j) % 28] for j in range(2000)) for i in range(500)]  # some 6 MB
    enc = Encoder(tokenizer_path("byte_bpe_50k.json"))
    monkeypatch.setattr(packing, "encoder", lambda path: enc)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    tracemalloc.start()
    got = list(packing._piece_batches("", 1, packing.WINDOW)(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 10 * batch.column(1).nbytes
    n = sum(len(enc.tok.encode(t, add_special_tokens=False).ids) + 1 for t in texts[::100])
    rows = pa.Table.from_batches(got).to_pylist()
    assert sum(r["length"] for r in rows if r["doc_id"] % 100 == 0) == n


def test_the_encoder_keeps_a_bounded_number_of_pieces(monkeypatch):
    enc = Encoder(tokenizer_path("byte_bpe_50k.json"))
    monkeypatch.setattr(packing, "encoder", lambda path: enc)
    texts = [" ".join(f"{i:x}" for i in range(lo, lo + 1000)) for lo in range(0, 400_000, 1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    got = pa.Table.from_batches(packing._piece_batches("", 1, 1 << 20)(iter([batch]))).to_pylist()
    assert [r["length"] for r in got[::80]] == [len(enc.tok.encode(t, add_special_tokens=False).ids) + 1 for t in texts[::80]]
    assert len(enc.keys) <= 1 << 18


def test_batches_to_python_are_bounded(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        for allowed, bounded in (("64m", BATCH_BYTES), ("1m", 1 << 20)):
            spark.conf.set(name, allowed)
            ship_package(spark)
            assert spark._jsparkSession.sessionState().conf().arrowMaxBytesPerBatch() == bounded
        spark.conf.set(name, "64m")
        ship_package(spark)
        texts = spark.range(0, 20_000, 1, 1).selectExpr("id", "repeat('some words ', 100) text")
        sizes = texts.mapInArrow(
            lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"]) for b in batches), "n long").collect()
        assert len(sizes) > 4 and max(r.n for r in sizes) < BATCH_BYTES + (64 << 10)
    finally:
        spark.conf.set(name, before)


def test_shingles_are_cut_in_small_runs():
    words = [thue_morse(5)[i: i + 4] + str(i) for i in range(28)]
    texts = [" ".join(words[(i + j) % 28] for j in range(300)) for i in range(1000)]  # some 2 MB
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    for work in (neardup._signature_batches(5, 24, 4), neardup._set_batches(5)):
        rows, peak = 0, 0
        tracemalloc.start()
        for out in work(iter([batch])):
            rows += out.num_rows
            peak = max(peak, tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert rows == len(texts) and peak < 8 << 20


def test_few_ids_are_sent_to_the_texts(spark, docs, monkeypatch):
    own = docs.selectExpr("cast(doc_id as long) id", "text")
    ids = neardup.materialize(own.select("id").distinct().orderBy("id").limit(20))
    stored, plans = neardup.materialize, []
    monkeypatch.setattr(neardup, "materialize", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or stored(df))
    few = neardup._shingle_table(own, ids, 2)
    monkeypatch.setattr(neardup, "FEW_IDS", 0)
    many = neardup._shingle_table(own, ids, 2)
    assert "strategy=broadcast" in plans[0] and "strategy=merge" in plans[1]
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect())) and few.count() > 0


@pytest.fixture
def many_partitions(spark):
    """A session that leaves 64 shuffle partitions as they are, and the number
    of files written since."""
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    there = set(glob.glob(f"{stored_dir(spark).removeprefix('file:')}/*/part-*"))
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield lambda: len(set(glob.glob(f"{stored_dir(spark).removeprefix('file:')}/*/part-*")) - there)
    for k, v in before.items():
        spark.conf.set(k, v)


def test_components_of_a_few_links_are_few_files(spark, many_partitions):
    links = spark.createDataFrame([(i, i + 1) for i in range(300) if i % 10], "a long, b long")
    got = {r.id: r.component for r in neardup.components(materialize(links)).collect()}
    assert got == {i: i - i % 10 + 1 if i % 10 else i - 9 for i in range(2, 301) if i % 10 != 1}
    assert 0 < many_partitions() < 2 * 64  # each of some twenty tables had up to 64 files


def test_groups_and_copies_of_a_small_table_are_few_files(spark, many_partitions):
    docs = spark.createDataFrame([(i, f"text {i // 2}", "en") for i in range(600)], "doc_id long, text string, lang string")
    kept = sorted(r.doc_id for r in exact.keep_one(materialize(docs)).collect())
    assert kept == list(range(1, 600, 2))
    assert 0 < many_partitions() < 64


def test_a_table_of_unknown_size_keeps_its_partitions(spark):
    rows = spark.createDataFrame(spark.sparkContext.parallelize([(i,) for i in range(40)], 20), "a long")
    stored = materialize(rows, few=True)
    assert sorted(r.a for r in stored.collect()) == list(range(40))
    assert len(stored.inputFiles()) == 20
