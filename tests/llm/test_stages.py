"""The pipeline, stage by stage, against brute force on the rows that each stage was given."""

from collections import Counter

from test_dedup import brute_components, lower_ascii, shingles
from test_models import SF, plain_scores
from test_placing import brute_targets, check_packing, count_words

from catchment.llm import quality
from catchment.llm.queries import tokenizer_path


def good(spark, rows):
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    scores, _ = plain_scores(rows, labels, quality.PER_ROUND, quality.SURE, quality.THRESHOLD)
    assert all(abs(s[3] - quality.THRESHOLD) > 1e-2 for s in scores)  # no close call in these rows
    return {s[0] for s in scores if s[4]}


def one_of_equal(spark, rows):
    last = {}
    for r in rows:
        key = lower_ascii(r.text)
        last[key] = max(last.get(key, r.doc_id), r.doc_id)
    return set(last.values())


def one_of_near(spark, rows):
    found = brute_components({r.doc_id: shingles(r.text, 5) for r in rows})
    return {i for i, smallest in found.items() if i == smallest}


def test_every_stage_against_brute_force(spark):
    from tokenizers import Tokenizer

    import corpus_pipeline as P
    from catchment.session import materialize

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, rows = docs.columns, docs.collect()
    for (name, stage), brute in zip(P.STAGES, (good, one_of_equal, one_of_near)):
        docs = materialize(stage(spark, docs, SF))
        now = docs.collect()
        assert docs.columns == columns
        whole = {tuple(r) for r in rows}
        assert len(now) == len({r.doc_id for r in now}) and all(tuple(r) in whole for r in now), name
        assert {r.doc_id for r in now} == brute(spark, rows), name
        assert len(now) < len(rows), name  # every stage has something to do here
        rows = now

    docs = materialize(P.mixing_stage(spark, docs, SF))
    mixed = docs.collect()
    sizes, taken, longest = Counter(), Counter(), Counter()
    for r in rows:
        sizes[r.source] += count_words(r.text)
        longest[r.source] = max(longest[r.source], count_words(r.text))
    for r in mixed:
        taken[r.source] += count_words(r.text)
    assert {tuple(r) for r in mixed} <= {tuple(r) for r in rows} and max(Counter(r.doc_id for r in mixed).values()) <= 2
    for source, target in brute_targets(dict(sizes)).items():
        assert abs(taken[source] - target) <= longest[source] + 1e-6

    packed = P.packing_stage(spark, docs, SF).collect()
    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    assert check_packing(packed, mixed, tok) > 0.9
    again = P.run(spark, SF).collect()
    assert sorted((r.doc_id, r.start, r.length) for r in again) == sorted((r.doc_id, r.start, r.length) for r in packed)


def test_an_empty_corpus(spark):
    import corpus_pipeline as P
    from catchment.session import materialize

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in P.STAGES:
        docs = materialize(stage(spark, docs, SF))
    assert docs.collect() == []
