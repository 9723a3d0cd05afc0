"""Words that a weak hash would confuse, through every operator that hashes words."""

import numpy as np
import pytest
from llm_helpers import thue_morse, twin_texts
from test_dedup import check_near
from test_models import check_files, check_scores
from test_placing import check_packing

from catchment.llm import encode, neardup, ngram, packing, tokenfiles
from catchment.llm.encode import Encoder
from catchment.llm.queries import tokenizer_path
from catchment.llm.text import hash_spans


@pytest.fixture(scope="module")
def twins(spark):
    texts = twin_texts()
    return texts, spark.createDataFrame([(i, t, "en", "a") for i, t in texts.items()], "doc_id long, text string, lang string, source string")


def test_twin_words_have_hashes_of_their_own():
    words = [thue_morse(n, o) for n in (10, 11, 12) for o in (False, True)] + ["a" * 64, "a" * 65, "b" + "a" * 64, "a" * 64 + "b"]
    data = np.frombuffer("".join(words).encode(), np.uint8)
    end = np.cumsum([len(w) for w in words])
    h = hash_spans(data, end - [len(w) for w in words], end)
    assert len(set(h.tolist())) == len(words)
    again = [hash_spans(np.frombuffer(w.encode(), np.uint8), np.array([0]), np.array([len(w)]))[0] for w in words]
    assert h.tolist() == [int(x) for x in again]  # a word's place in the buffer does not matter


def test_twin_words_in_near_duplicates(twins):
    check_near(neardup.near_duplicates(twins[1], k=2).collect(), twins[0], 2)


def test_twin_words_in_scores(twins):
    check_scores(ngram.lm_scores(twins[1]).collect(), twins[1].collect())


def test_twin_words_in_token_files_and_packing(twins):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    check_files(tokenfiles.read_token_files(tokenfiles.write_token_files(twins[1], path)).collect(), twins[1].collect(), Tokenizer.from_file(path))
    path = tokenizer_path("byte_bpe_50k.json")
    check_packing(packing.pack_documents(twins[1], path).collect(), twins[1].collect(), Tokenizer.from_file(path))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("pieces", [10, 1 << 21])
def test_pieces_are_compared_by_their_bytes(corpus, monkeypatch, name, pieces):
    """Seven hashes for all pieces: only the bytes tell them apart."""
    monkeypatch.setattr(encode, "hash_spans", lambda *a: hash_spans(*a) % np.uint64(7))
    monkeypatch.setattr(encode, "CACHE_PIECES", pieces)
    enc = Encoder(tokenizer_path(name))
    for part in range(3):
        texts = [r.text or "" for r in corpus[part * 9: part * 9 + 9]]
        raw = [t.encode() for t in texts]
        ids, row = enc.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
        for i, t in enumerate(texts):
            assert ids[row[i]: row[i + 1]].tolist() == enc.tok.encode(t, add_special_tokens=False).ids
