"""Substring dedup on bytes: threshold-bounded interval expansion on Burrows-Wheeler transforms."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import mix64, table
from tallyline.llm.repeats import ROW, Runs, cut_repeats

LENGTH = 50
#: Bytes whose hashes choose the anchor of a window: every window is dealt by its least-hashed gram.
GRAM = 16
#: Bytes of contexts in one transform.
TRANSFORM = 1 << 21
#: Windows whose grams are hashed at once, so that the numbers stay in a core's cache.
BLOCK = 1 << 15
U = np.uint64
BASE = 0x9E3779B97F4A7C15


def _ordered(key: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys of so many bits, and the keys in that order.

    Where there is room for it in 64 bits, the position is put behind the key: plain numbers are sorted much faster.
    """
    place = len(key).bit_length()
    if bits + place > 64:
        order = np.argsort(key)
        return order, key[order]
    both = np.sort(key << U(place) | np.arange(len(key), dtype=U))
    return (both & U((1 << place) - 1)).astype(np.int64), both >> U(place)


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Positions of ``text`` (bytes above 0, 0 between strings) in the order of their first ``depth`` symbols.

    Prefix multiplication: the first symbols, of nine bits each, make a first rank, and the ranks of the symbols after them
    are put behind it, as many as fit, but one at least. Positions that agree so far come in any order.
    """
    n = len(text)
    room = 64 - n.bit_length()
    reach = room // 9
    wide = np.concatenate([text, np.zeros(reach, text.dtype)]).astype(U)
    key, bits = np.zeros(n, U), 9 * reach
    for k in range(reach):
        key = key << U(9) | wide[k : n + k]
    while True:
        order, step = _ordered(key, bits)
        if reach >= depth or not n:
            return order
        rank = np.cumsum(np.concatenate([[True], step[1:] != step[:-1]])).astype(U)  # from 1; 0 is behind the end
        dense = np.zeros(n, U)
        dense[order] = rank
        bits = int(rank[-1]).bit_length()
        times = max(2, room // bits)
        key = dense
        for k in range(1, times):
            key = key << U(bits)
            key[: max(n - k * reach, 0)] |= dense[k * reach :]
        reach, bits = reach * times, bits * times


def common_intervals(text: np.ndarray, length: int) -> np.ndarray:
    """For each position a number that two positions share exactly if their next ``length`` symbols agree.

    The intervals of the suffix order start as one per symbol, the strings of length one. A round extends
    all strings backwards by a symbol: a row of the order is reached from the row of the suffix after it
    (the step that the transform inverts), and two neighbouring rows part in this round, with a common
    prefix as long as the round's number, if they begin alike and their successors parted in the round
    before. Prefix lengths thus appear in increasing order, only rows that have not parted are looked at
    again, and the expansion stops at ``length``: rows not parted by then share at least so much. Strings
    do not extend over a 0; it parts from everything.
    """
    n = len(text)
    small = np.int32 if n < 1 << 31 else np.int64
    order = suffix_order(text, length)
    row = np.empty(n + 1, small)
    row[order] = np.arange(n, dtype=small)
    row[n] = n  # parts from everything
    after = row[order + 1]  # row of the suffix one symbol later
    symbol = text[order]
    parted = np.ones(n + 1, bool)
    parted[1:n] = (symbol[1:] != symbol[:-1]) | (symbol[1:] == 0)
    active = np.flatnonzero(~parted).astype(small)
    a, b = after[active], after[active - 1]
    # successors are often neighbours themselves, and have parted if the second one is marked; others are looked up in a count
    beside = a - b == 1
    near, its, far, a, b = active[beside], a[beside], active[~beside], a[~beside], b[~beside]
    count = np.empty(n + 1, small)
    ended = 0  # rows that have parted since they were last left out
    for _ in range(1, length):
        np.cumsum(parted, out=count)
        one, other = np.flatnonzero(parted[its]), np.flatnonzero(count[a] != count[b])
        if len(one) + len(other) == ended:  # none has parted in this round, so none will
            break
        parted[near[one]] = True
        parted[far[other]] = True
        ended = len(one) + len(other)
        if 4 * ended > len(near) + len(far):
            kept = ~parted[near]
            near, its = near[kept], its[kept]
            kept = ~parted[far]
            far, a, b, ended = far[kept], a[kept], b[kept], 0
    out = np.empty(n, np.int64)
    out[order] = np.cumsum(parted[:n]) - 1
    return out


def _gram_hashes(x: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes at each position, by doubling."""
    h, size, power = x.astype(U) + U(1), 1, BASE
    while size < GRAM:
        longer = h[..., :-size] * U(power)
        longer += h[..., size:]
        h = longer
        power = power * power % (1 << 64)
        size *= 2
    return mix64(h)


class ByteWindows:
    """Windows of bytes keyed by their least-hashed gram, compared by interval expansion.

    The last bits of a gram's hash give way to its place in the window, so that the least number is the leftmost of
    the grams with the least hash.
    """

    def __init__(self, length: int = LENGTH):
        if length < GRAM:
            raise ValueError(f"length must be at least {GRAM}")
        self.length = length
        self.width = length - GRAM + 1  # grams of a window
        self.place = U(self.width.bit_length())

    def _hashes(self, x: np.ndarray) -> np.ndarray:
        return _gram_hashes(x) >> self.place << self.place

    def _least(self, x: np.ndarray) -> np.ndarray:
        """The least gram of the window at each position."""
        out = np.empty(len(x) - self.length + 1, U)
        for begin in range(0, len(out), BLOCK):
            value, size = self._hashes(x[begin : begin + BLOCK + self.length - 1]), 1
            while size < self.width:  # least of size grams
                step = min(size, self.width - size)
                later = value[step:] + U(step)
                value = np.minimum(value[:-step], later, out=later)
                size += step
            out[begin : begin + len(value)] = value
        return out

    def runs(self, texts: pa.Array) -> tuple[Runs, Callable[[np.ndarray], pa.Array]]:
        raw = texts.fill_null("").cast(pa.large_binary())
        offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
        x = np.frombuffer(raw.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if raw.buffers()[2] else np.empty(0, np.uint8)
        offsets = offsets - offsets[0]
        empty = np.empty(0, np.int64)
        if len(x) < self.length:
            return Runs(empty, empty.astype(U), empty, empty), lambda chosen: pa.array([], pa.large_binary())
        least = self._least(x)
        anchor = np.arange(len(least)) + (least & U((1 << int(self.place)) - 1)).astype(np.int64)
        n = np.maximum(np.diff(offsets) - self.length + 1, 0)  # windows of each text
        ends = np.append(np.concatenate([offsets[:-1], offsets[:-1] + n]), 0)  # of texts and of their windows
        fresh = np.empty(len(anchor) + 1, bool)
        fresh[1:-1] = anchor[1:] != anchor[:-1]
        fresh[ends[ends < len(anchor)]] = True
        fresh[-1] = True
        head = np.flatnonzero(fresh)
        count, head = np.diff(head), head[:-1]
        doc = np.searchsorted(offsets, head, "right") - 1
        inside = head - offsets[doc] < n[doc]
        begin, count, doc = head[inside], count[inside], doc[inside]
        runs = Runs(doc, mix64(least[begin] >> self.place), begin - offsets[doc], count)

        def content(chosen: np.ndarray) -> pa.Array:
            """The bytes that the windows of each chosen run cover."""
            size = count[chosen] + self.length - 1
            ends = np.concatenate([[0], np.cumsum(size)])
            where = np.arange(ends[-1]) + np.repeat(begin[chosen] - ends[:-1], size)
            return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(x[where])])

        return runs, content

    def repeats(self, content: pa.Array, count: np.ndarray, doc_id: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Equal contexts are one string with the smallest of their doc_ids; strings meet in transforms.

        A string shares windows with another one only if they share an anchor, and all of an anchor's
        strings are in one transform.
        """
        coded = content.dictionary_encode()
        code = np.asarray(coded.indices).astype(np.int64)
        strings = coded.dictionary
        least = np.full(len(strings), np.iinfo(np.int64).max)
        np.minimum.at(least, code, doc_id)
        offsets = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
        x = np.frombuffer(strings.buffers()[2], np.uint8)
        size = np.diff(offsets)
        windows = size - self.length + 1
        base = np.concatenate([[0], np.cumsum(windows)])
        earliest = np.repeat(least, windows)  # of each window of each string
        gram = self._anchors(x, offsets)
        order = np.argsort(gram, kind="stable")
        group = np.cumsum(np.concatenate([[True], gram[order][1:] != gram[order][:-1]])) - 1 if len(order) else order
        several = np.bincount(group)[group] > 1 if len(order) else np.empty(0, bool)
        chosen, group = order[several], group[several]
        bytes_upto = np.cumsum(size[chosen] + 1)
        start = 0
        while start < len(chosen):
            done = bytes_upto[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(bytes_upto, done + TRANSFORM)))
            while end < len(chosen) and group[end] == group[end - 1]:
                end += 1
            self._expand(chosen[start:end], x, offsets, size, windows, base, least, earliest)
            start = end
        late = earliest[base[code].repeat(count) + _within(count)] < np.repeat(doc_id, count)
        at = np.flatnonzero(late)
        if not len(at):
            return at, at, at
        run = np.repeat(np.arange(len(count)), count)
        head = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (run[at[1:]] != run[at[:-1]])]))
        begin = np.cumsum(count) - count
        return run[at[head]], at[head] - begin[run[at[head]]], np.diff(np.append(head, len(at)))

    def _anchors(self, x: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Hash of each string's anchor: the least of the grams of its first window, as of every other one."""
        if len(offsets) < 2:
            return np.empty(0, U)
        out = np.empty(len(offsets) - 1, U)
        for begin in range(0, len(out), 1000):
            first = offsets[begin : min(begin + 1000, len(out))]
            grams = self._hashes(x[first[:, None] + np.arange(self.length)]) + np.arange(self.width, dtype=U)
            out[begin : begin + len(first)] = grams.min(1) >> self.place
        return out

    def _expand(self, chosen: np.ndarray, x: np.ndarray, offsets: np.ndarray, size: np.ndarray, windows: np.ndarray, base: np.ndarray, least: np.ndarray, earliest: np.ndarray) -> None:
        """Lower ``earliest`` of the chosen strings' windows to the least doc_id of their interval."""
        n = size[chosen]
        starts = np.cumsum(n + 1) - n - 1
        text = np.zeros(int(starts[-1] + n[-1] + 1), np.int16)
        text[np.repeat(starts, n) + _within(n)] = x[np.repeat(offsets[chosen], n) + _within(n)].astype(np.int16) + 1
        interval = common_intervals(text, self.length)
        w = windows[chosen]
        of = interval[np.repeat(starts, w) + _within(w)]
        first = np.full(int(interval.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(first, of, np.repeat(least[chosen], w))
        earliest[np.repeat(base[chosen], w) + _within(w)] = first[of]


def _within(n: np.ndarray) -> np.ndarray:
    """0 .. n_i - 1 for each n_i, one after another."""
    ends = np.cumsum(n)
    return np.arange(ends[-1] if len(n) else 0) - np.repeat(ends - n, n)


def _kept(rows: pa.RecordBatch, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Number of bytes, spans and kept bytes of every row."""
    raw = rows.column("text").fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    x = np.frombuffer(raw.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if raw.buffers()[2] else np.empty(0, np.uint8)
    size, base = np.diff(offsets), offsets[:-1] - offsets[0]
    edge = np.zeros(len(x) + 1, np.int32)
    np.add.at(edge, base[doc] + start, 1)
    np.add.at(edge, base[doc] + end, -1)
    keep = np.cumsum(edge)[:-1] == 0
    lost = np.bincount(doc, end - start, len(size)).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(size - lost)])
    kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(x[keep])])
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(doc, np.arange(len(size) + 1)).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(start.astype(np.int64)), pa.array(end.astype(np.int64))], names=["start", "end"]),
    )
    return size, spans, kept


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Bytes outside all strings that an earlier document holds: ``doc_id, n_bytes, spans, kept``.

    ``docs`` has ``doc_id`` and ``text``; one row comes back for each, its text read as UTF-8. A byte is
    removed if a string of ``length`` bytes around it also starts in a document with a smaller doc_id,
    judged on the input. ``spans`` are the maximal removed ranges, ``kept`` the other bytes. Null texts are
    empty, shorter texts and rows with a null doc_id lose nothing; rows that share a doc_id do not remove
    each other's bytes. An empty table gives an empty result.
    """

    def cut(rows: pa.RecordBatch, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
        size, spans, kept = _kept(rows, doc, start, end)
        return pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(size.astype(np.int64)), spans, kept.cast(pa.binary())], names=["doc_id", "n_bytes", "spans", "kept"])

    schema = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    return cut_repeats(docs.select("doc_id", "text"), ByteWindows(length), length, schema, cut)


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The columns of ``docs`` with repeated strings cut out of ``text``; ``n_chars`` follows it.

    A character of which some bytes are cut goes as a whole. A document of which nothing is left goes. Any
    column names are allowed beside ``doc_id`` and ``text``.
    """
    taken = {c.lower(): c for c in docs.columns}
    if ROW in taken:  # the name under which rows are known on the way
        free = next(name for name in (f"{ROW}{i}" for i in range(len(taken) + 1)) if name not in taken)
        return deduplicated(docs.withColumnRenamed(taken[ROW], free), length).withColumnRenamed(free, taken[ROW])
    schema = T.StructType([T.StructField(f.name, T.LongType() if f.name == "doc_id" else f.dataType) for f in docs.schema])
    names = schema.names

    def cut(rows: pa.RecordBatch, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
        _, _, kept = _kept(rows, doc, start, end)
        touched = set(doc.tolist())
        texts = rows.column("text").to_pylist()
        for i in touched:
            texts[i] = kept[i].as_py().decode("utf-8", "ignore")
        columns = {name: rows.column(name) for name in names}
        columns["text"] = pa.array(texts, pa.string())
        if "n_chars" in columns:
            chars = rows.column("n_chars").to_pylist()
            columns["n_chars"] = pa.array([len(texts[i]) if i in touched else c for i, c in enumerate(chars)], rows.column("n_chars").type)
        left = pa.array([i for i, x in enumerate(texts) if not (i in touched and not x.strip())], pa.int64())
        return pa.RecordBatch.from_arrays(list(columns.values()), names=names).take(left)

    return cut_repeats(docs, ByteWindows(length), length, schema, cut)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that earlier documents hold."""
    got = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return got.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
