import random

import pyarrow as pa
import pytest
from sentencepiece import SentencePieceProcessor

from tallyline.llm import tokencounts

PIECES = [
    " ", "  ", "   ", " " * 20, "▁", "\n", "\x00", "\x1f", "\t", "\r", "a", "b", "the", "ing", ".", ",", "é", "①", "<s>", "</s>",
    "<unk>", "<0x0A>", "\U0001f600", "\u3000", "\u0301", "梦", "ß", "Ⅳ", "1999", "\u00a0",
]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=tokencounts.default_model())


def texts(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice(PIECES) for _ in range(r.randrange(40))) for _ in range(n)]


def test_counts_equal_the_library(library):
    some = [*texts(1, 5000), "a" * 5000, " " * 3000, "▁" * 777, "\n" * 50, "abcdefg" * 4000, "word. " * 3000, "", " ", "\n", " \n ", "x\n y"]
    found = tokencounts.PairMerger(tokencounts.default_model()).counts(pa.array(some))
    assert found.tolist() == [len(x) for x in library.encode(some)]


def test_forgetting_words_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(tokencounts, "CACHED_WORDS", 5)
    some = texts(2, 500)
    merger = tokencounts.PairMerger(tokencounts.default_model())
    for _ in range(2):
        assert merger.counts(pa.array(some)).tolist() == [len(x) for x in library.encode(some)]
    assert len(merger.recent) <= 5 and len(merger.older) <= 5


def test_every_row_is_counted(spark, documents, messy, library, monkeypatch):
    monkeypatch.setattr(tokencounts, "SLICE_BYTES", 500)
    rows = [*messy, (70, "x y " * 3000, "en", "a")]
    found = tokencounts.token_counts(documents(rows))
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = []
    for doc_id, text, *_ in rows:
        n = len(library.encode(text or ""))
        expected.append((doc_id, len((text or "").encode()), n, n > 4096))
    assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, expected))
    assert any(x[3] for x in expected)


def test_an_empty_table_and_another_limit(spark, documents):
    assert tokencounts.token_counts(documents([(1, "a", "en", "a")]).where("false")).count() == 0
    assert [r.over_limit for r in tokencounts.token_counts(documents([(1, "one two three", "en", "a")]), limit=1).collect()] == [True]


def test_a_model_that_rewrites_texts_is_refused(monkeypatch):
    monkeypatch.setattr(SentencePieceProcessor, "normalize", lambda self, text: text.strip())
    with pytest.raises(ValueError):
        tokencounts.PairMerger(tokencounts.default_model())
