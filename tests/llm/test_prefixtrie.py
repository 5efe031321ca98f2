import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyline.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string, key string, words long, depth long, t string, opener long, own long, kind int, edge long, ids string, n long"


def table(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, 1, "t", 1, 1, 1, 1, "i", 1) for r in rows], SCHEMA)


def place(row):
    _, turn, role, text = row
    role, text = role or "", text or ""
    return turn is not None, turn or 0, role, hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute_sequences(rows):
    found = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=place):
        found[row[0]].append((row[2] or "", row[3] or ""))
    return dict(found)


def brute_openings(sequences):
    out = {}
    for c, own in sequences.items():
        h = zlib.crc32(str(c).encode()) % 4
        opener = int(c - np.fmod(c, 20))
        out[c] = sequences.get(opener, [])[:h] + own[h:]
    return out


def brute_trie(sequences):
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
        ends[tuple(seq)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p in members:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += (len(members[p]) - 1) * words
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*prefixtrie.NODE).collect())


def some(seed, n, copies=0):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(-50, 6 * n), n):
        for t in range(r.choice([0, 1, 2, 3, 5, 9])):
            rows.append((c, t, r.choice(["user", "assistant"]), r.choice(["a", "a b", "b c d", "", None, "é ü　x"])))
    hot = 10 * n
    for c in range(hot, hot + copies):
        rows += [(c, t, "user", "the same words again") for t in range(3)]
    return rows


MESSY = [
    (5, None, "user", "null turns come first"), (5, 2, None, None), (5, 2, None, "x"), (5, 2, None, "x"), (5, 2, "a", None), (5, -1, "user", ""),
    (6, 1, "user", "repeated"), (6, 1, "user", "repeated"), (None, 1, "user", "no conversation"), (7, 1, "us", "erx"), (8, 1, "user", "x"),
    (9, 1, "user", "long " * 20000),
]


@pytest.mark.parametrize("turns_per_task", [3, 40, 1_000_000])
def test_trie_equals_brute_force(spark, monkeypatch, turns_per_task):
    monkeypatch.setattr(prefixtrie, "TURNS_PER_TASK", turns_per_task)
    rows = some(1, 25, copies=30) + MESSY
    found = prefixtrie.prefix_trie(prefixtrie.conversation_sequences(table(spark, rows)))
    assert rows_of(found) == brute_trie(brute_sequences(rows))


def test_openings_of_another_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "TURNS_PER_TASK", 60)
    rows = [r for r in some(2, 60, copies=25) if r[0] % 60 != 0] + MESSY + [(c, t, "system", f"opening {c} {t}") for c in (20, 40, -20) for t in range(c % 3 + 1)]
    own = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    sequences = prefixtrie.with_openings(table(spark, rows), own.cast("int"), F.col("conv_id") - F.col("conv_id") % 20, 3)
    expected = brute_openings(brute_sequences(rows))
    assert any(not seq for seq in expected.values())
    assert rows_of(prefixtrie.prefix_trie(sequences)) == brute_trie(expected)


def test_one_conversation_and_none(spark):
    one = table(spark, [(3, 0, "user", "hello there")])
    assert rows_of(prefixtrie.prefix_trie(prefixtrie.conversation_sequences(one))) == brute_trie({3: [("user", "hello there")]})
    assert prefixtrie.prefix_trie(prefixtrie.conversation_sequences(one.where("false"))).count() == 0
    null = table(spark, [(None, 0, "user", "x")])
    assert prefixtrie.prefix_trie(prefixtrie.conversation_sequences(null)).count() == 0


def test_searches_find_the_extent_of_every_prefix():
    r = random.Random(4)
    seqs = sorted(bytes(r.randrange(2) for _ in range(r.randrange(8))) for _ in range(300))
    keys = np.frombuffer(b"".join(bytes([x]) * 16 for s in seqs for x in s), "S16").view(np.dtype((np.void, 16)))
    trie = prefixtrie.Forest(keys, np.array([len(s) for s in seqs]))
    row = np.array([i for i, s in enumerate(seqs) for _ in range(len(s) + 1)])
    depth = np.array([d for s in seqs for d in range(len(s) + 1)])
    left, right = trie.left(row, depth), trie.right(row, depth)
    for i, d, a, b in zip(row, depth, left, right, strict=True):
        own = [k for k, s in enumerate(seqs) if s[:d] == seqs[i][:d] and len(s) >= d]
        assert (a, b) == (own[0], own[-1])
    least = prefixtrie._Minima(np.arange(300)[::-1].copy(), 999).least(left, right)
    assert (least == 299 - right).all()
