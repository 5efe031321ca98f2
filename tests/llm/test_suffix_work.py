"""The byte form keys and compares windows by content alone, and does no more than it has to."""

import numpy as np
import pyarrow as pa

from tallyline.llm import suffixes


def _plain(data, length):
    """Runs by hand: the leftmost gram with the least hash of every window."""
    form, out = suffixes.ByteWindows(length), []
    for doc, text in enumerate(data):
        x = np.frombuffer(text.encode(), np.uint8)
        for at in range(len(x) - length + 1):
            grams = form._hashes(x[at : at + length]).tolist()
            anchor = at + min(range(len(grams)), key=lambda i: (grams[i], i))
            if out and out[-1][0] == doc and out[-1][1] == anchor:
                out[-1][3] += 1
            else:
                out.append([doc, anchor, at, 1])
    return [(doc, at, count) for doc, _, at, count in out]


def test_runs_equal_those_found_by_hand():
    rng = np.random.default_rng(3)
    same = "".join(chr(97 + i) for i in rng.integers(0, 3, 300))
    data = ["", "short", same, "x", same[40:200], "a" * 120, "", "ab" * 40, "é" * 60, ""]
    for length in (16, 17, 50):
        runs, content = suffixes.ByteWindows(length).runs(pa.array(data))
        assert list(zip(runs.doc.tolist(), runs.start.tolist(), runs.count.tolist())) == _plain(data, length)
        taken = content(np.arange(len(runs.doc))).to_pylist()
        for d, a, n, got in zip(runs.doc, runs.start, runs.count, taken):
            assert got == data[d].encode()[a : a + n + length - 1]


def test_windows_with_the_same_bytes_have_the_same_key_wherever_they_are(monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", 64)
    rng = np.random.default_rng(5)
    passage = bytes(rng.integers(97, 123, 90).astype(np.uint8)).decode()
    data = [bytes(rng.integers(97, 123, n).astype(np.uint8)).decode() + passage for n in (0, 13, 64, 500)]
    form = suffixes.ByteWindows()
    runs, content = form.runs(pa.array(data))
    keys = []
    for doc, text in enumerate(data):
        of = {}
        for d, k, a, n in zip(runs.doc, runs.key, runs.start, runs.count):
            if d == doc:
                of |= dict.fromkeys(range(a, a + n), k)
        assert sorted(of) == list(range(len(text) - 49))
        keys.append([of[i] for i in range(len(text) - 90, len(text) - 49)])
    assert keys[0] == keys[1] == keys[2] == keys[3]
    strings = content(np.arange(len(runs.doc)))
    anchors = form._anchors(np.frombuffer(strings.buffers()[2], np.uint8), np.frombuffer(strings.buffers()[1], np.int64))
    assert len(set(zip(runs.key.tolist(), anchors.tolist()))) == len(set(runs.key.tolist())) == len(set(anchors.tolist()))


def test_positions_are_put_in_order_with_and_without_room_behind_the_keys():
    rng = np.random.default_rng(7)
    for bits in (20, 64):
        key = rng.integers(0, 1 << 18, 5000).astype(np.uint64) << np.uint64(bits - 18)
        order, found = suffixes._ordered(key, bits)
        assert (key[order] == found).all() and (np.diff(found.astype(float)) >= 0).all() and sorted(order) == list(range(5000))


def test_suffix_order_agrees_with_sorting_the_suffixes():
    rng = np.random.default_rng(9)
    for n in (0, 1, 5, 400):
        text = rng.integers(0, 3, n).astype(np.int16)
        padded = text.tolist() + [0] * 60
        order = suffixes.suffix_order(text, 50)
        heads = [padded[i : i + 50] for i in order]
        assert heads == sorted(heads) and sorted(order) == list(range(n))


def test_a_transform_ends_when_nothing_parts_any_more(monkeypatch):
    rounds = []
    counted = np.cumsum
    monkeypatch.setattr(suffixes.np, "cumsum", lambda *a, **k: rounds.append(k) or counted(*a, **k))
    suffixes.common_intervals(np.array([3, 4, 5, 0, 3, 4, 6, 0], np.int16), 50)
    assert len([k for k in rounds if "out" in k]) < 10  # once for each round, of which there were 49
