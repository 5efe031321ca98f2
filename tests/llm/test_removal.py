"""Word and byte form of repeat removal against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from tallyline.llm import substrings, suffixes
from tallyline.llm.common import split_words
from tests.llm.conftest import words

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"


def split(text):
    for c in SPACES:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(rows, units, window):
    """Per row the flags of removed units: covered by a window that a smaller doc_id also has."""
    first = {}
    for doc_id, *_ in rows:
        pass
    for r in rows:
        if r[0] is not None and r[1] is not None:
            u = units(r[1])
            for k in range(len(u) - window + 1):
                w = tuple(u[k : k + window])
                first[w] = min(first.get(w, r[0]), r[0])
    out = []
    for r in rows:
        u = units(r[1]) if r[1] is not None else units("")
        gone = [False] * len(u)
        if r[0] is not None:
            for k in range(len(u) - window + 1):
                if first[tuple(u[k : k + window])] < r[0]:
                    gone[k : k + window] = [True] * window
        out.append((u, gone))
    return out


def spans(gone):
    edges = np.flatnonzero(np.diff(np.concatenate([[0], np.array(gone, int), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def corpus():
    """Random texts over few words with shared passages, runs and copies."""
    r = random.Random(5)
    rows = []
    passage = words(50, 40, 6)
    for i in range(60):
        text = words(100 + i, r.randrange(0, 80), 3 if i % 3 else 40)
        if i % 4 == 0:
            at = r.randrange(len(text) + 1)
            text[at:at] = passage[r.randrange(10) : 20 + r.randrange(20)]
        if i % 7 == 0:
            text += ["run"] * r.randrange(30)
        if i % 11 == 0:
            text += ["p", "q"] * r.randrange(20)
        rows.append((r.randrange(70), (" " if i % 2 else "  \n").join(text)))
    return rows


@pytest.mark.parametrize("which", ["messy", "random"])
def test_words_equal_brute_force(documents, messy, which):
    rows = messy if which == "messy" else corpus()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, [tuple(s) for s in r.spans], r.kept) for r in substrings.remove_repeated_words(documents(rows)).collect())
    want = []
    for r, (u, gone) in zip(rows, brute(rows, split, 13), strict=True):
        kept = " ".join(w for w, g in zip(u, gone, strict=True) if not g)
        want.append((r[0] is None, r[0] or 0, len(u), spans(gone), kept))
    assert got == sorted(want)


@pytest.mark.parametrize("which", ["messy", "random"])
def test_bytes_equal_brute_force(documents, messy, which):
    rows = [(r[0], None if r[1] is None else r[1][:3000]) for r in messy] if which == "messy" else corpus()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in suffixes.remove_repeated_bytes(documents(rows)).collect())
    want = []
    for r, (u, gone) in zip(rows, brute(rows, lambda t: list(t.encode()), 50), strict=True):
        want.append((r[0] is None, r[0] or 0, len(u), spans(gone), bytes(b for b, g in zip(u, gone, strict=True) if not g)))
    assert got == sorted(want)


def test_deduplicated_keeps_the_columns_and_whole_characters(documents, messy):
    docs = documents(messy)
    out = suffixes.deduplicated(docs)
    assert out.columns == docs.columns
    rows = {r.doc_id: r for r in out.collect() if r.doc_id is not None}
    assert 2 not in rows and rows[1].text == messy[0][1]  # a copy loses everything and goes
    assert rows[4].text is None and rows[5].text == ""  # nothing was taken from these
    rows[15].text.encode()  # decodes
    assert rows[15].n_chars == len(rows[15].text) < len(messy[17][1])


@pytest.mark.parametrize("name", ["_row", "_ROW"])
def test_columns_named_like_inner_ones(spark, messy, name):
    rows = [(r[0], r[1], f"own {i}", i) for i, r in enumerate(messy)]
    docs = spark.createDataFrame(rows, f"doc_id long, text string, `{name}` string, _row0 long")
    plain = suffixes.deduplicated(docs.select("doc_id", "text"))
    found = suffixes.deduplicated(docs)
    assert found.columns == ["doc_id", "text", name, "_row0"]
    assert sorted(map(str, found.select("doc_id", "text").collect())) == sorted(map(str, plain.collect()))
    assert all(r[2] == f"own {r[3]}" for r in found.collect())


def test_empty_tables(documents):
    none = documents([])
    assert substrings.remove_repeated_words(none).count() == 0
    assert suffixes.remove_repeated_bytes(none).count() == 0
    assert suffixes.deduplicated(none).count() == 0


def test_intervals_are_the_classes_of_equal_strings():
    rng = np.random.default_rng(1)
    for length in (1, 2, 7, 8, 50):
        text = rng.integers(1, 3, 500).astype(np.int16)
        text[rng.integers(0, 500, 12)] = 0
        text[100:170], text[-1] = text[200:270], 0
        got, seen = suffixes.common_intervals(text, length), {}
        for i in range(500 - length):
            w = tuple(text[i : i + length])
            if 0 not in w:
                assert seen.setdefault(w, got[i]) == got[i]
        assert len(set(seen.values())) == len(seen)


def test_window_keys_depend_on_the_window_alone():
    form = substrings.Recompression()
    keys = {}
    for seed in range(40):
        text = words(seed, 200, 2 + seed % 5) + ["z"] * 30 + words(seed, 50, 2)
        x = substrings.word_hashes(pa.array(text, pa.large_string()))
        key, whole = form.window_keys(x, np.array([len(x)]))
        for i in np.flatnonzero(whole):
            w = tuple(text[i : i + 13])
            assert keys.setdefault(w, key[i]) == key[i]


def test_split_words_follows_the_word_definition():
    texts = ["a\x0bb\x0cc\x1cd\x85e f", " x ", "", None, "\n"]
    flat, counts = split_words(pa.array(texts))
    assert counts.tolist() == [3, 1, 0, 0, 0] and flat.to_pylist() == ["a", "b", "c\x1cd\x85e f", "x"]


def test_query_columns(spark, documents, tmp_path):
    documents(corpus()).write.parquet(f"{tmp_path}/documents.parquet")
    two = substrings.op2_substring_dedup(spark, str(tmp_path))
    assert two.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    row = suffixes.op7_suffix_dedup(spark, str(tmp_path)).where("n_bytes = 0").first()
    assert row is None or row.kept_sha256 == hashlib.sha256(b"").hexdigest()
