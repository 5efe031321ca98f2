"""Substring dedup on words by recompression."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import mix64, split_words, table
from tallyline.llm.repeats import Runs, cut_repeats

WINDOW = 13
#: Rounds of naming; a window takes the highest symbols it holds. 13 words without repeats always hold a
#: whole symbol of the second round, while those of later rounds are often cut by the window's edge.
ROUNDS = 2
BASE = np.uint64(0x9E3779B97F4A7C15)
U = np.uint64


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word; the distinct ones are hashed once."""
    coded = words.dictionary_encode()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in coded.dictionary.to_pylist()), U, len(coded.dictionary))
    return hashes[np.asarray(coded.indices)] if len(words) else np.empty(0, U)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = U(pow(int(BASE), -1, 1 << 64))
    up, down = np.full(n + 1, BASE, U), np.full(n + 1, inverse, U)
    up[0] = down[0] = U(1)
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


class Recompression:
    """Windows keyed by the symbols that rounds of recompression name inside them.

    A round names maximal runs of one symbol, then pairs: a symbol whose coin shows left and a following
    one whose coin shows right become one. Names are hashes of what they stand for and coins are bits of
    names, so every task names alike and the names are global without a dictionary. Whether two
    neighbours join depends on these two alone, so a symbol whose neighbours of the round before lie
    inside a window is there wherever the window's words are: the window's interior symbols.
    """

    def __init__(self, window: int = WINDOW, rounds: int = ROUNDS):
        self.window, self.rounds = window, rounds

    def levels(self, x: np.ndarray, doc: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each round: names, and the words [a, z) that must lie strictly inside a window that holds the symbol."""
        out = []
        name, first, last = x, np.arange(len(x)), np.arange(len(x)) + 1  # words of each symbol
        own, inner_a, inner_z = doc, first, last
        for r in range(self.rounds):
            same = np.concatenate([[False], (name[1:] == name[:-1]) & (own[1:] == own[:-1])])
            head = np.flatnonzero(~same)
            size = np.diff(np.append(head, len(name)))
            tail = head + size - 1
            letter = name[head]
            runs = np.where(size == 1, letter, mix64(letter + size.astype(U) * U(0xA0761D6478BD642F)))
            coin = (mix64(letter ^ U(r + 1)) >> U(17)) & U(1) == 1
            owner = own[head]
            joins = np.concatenate([coin[:-1] & ~coin[1:] & (owner[1:] == owner[:-1]), [False]])
            left = np.flatnonzero(~np.concatenate([[False], joins[:-1]]))  # first run of each new symbol
            joined = joins[left]
            right = left + joined
            name = np.where(joined, mix64(mix64(runs[left]) + runs[right] * U(0xE7037ED1A0B428DB)), runs[left])
            old_a, old_z, old_own = inner_a, inner_z, own
            begin, end = head[left], tail[right]  # old symbols that the new one spans
            first, last, own = first[begin], last[end], owner[left]
            if r == 0:
                inner_a, inner_z = first, last
            else:  # the neighbours of the round before must be certain, too
                edge_l = (begin == 0) | (old_own[np.maximum(begin - 1, 0)] != own)
                edge_r = (end == len(old_own) - 1) | (old_own[np.minimum(end + 1, len(old_own) - 1)] != own)
                inner_a = np.where(edge_l, -1, old_a[np.maximum(begin - 1, 0)])
                inner_z = np.where(edge_r, len(x) + self.window, old_z[np.minimum(end + 1, len(old_own) - 1)])
            out.append((name, inner_a, inner_z))
        return out

    def window_keys(self, x: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Key of the window at each word, and whether a whole window starts there."""
        w, n = self.window, len(x)
        doc = np.repeat(np.arange(len(counts)), counts)
        ends = np.cumsum(counts)
        whole = np.arange(n) + w <= ends[doc] if n else np.empty(0, bool)
        key, open_ = np.zeros(n, U), whole.copy()
        level = list(enumerate(self.levels(x, doc))) if n else []
        none = U(0xFFFFFFFFFFFFFFFF)

        up, down = _powers(n)
        sums = np.concatenate([[U(0)], np.cumsum(x * up[:-1])])

        def choose(name: np.ndarray, a: np.ndarray, z: np.ndarray, tag: int) -> None:
            """Windows without a key take the least name of those with a > start and z < start + w.

            Names are mixed with the words from a to z, the neighbours that make the symbol certain, so
            that texts which share no more than a short symbol part.
            """
            low, high = z - w + 1, np.minimum(a - 1, n - 1)
            use = low <= high
            around = mix64((sums[z[use]] - sums[a[use]]) * down[a[use]])
            name, low, high = mix64((name[use] ^ around) + U(tag)), low[use], high[use]
            best = np.full(n, none, U)
            for step in range(w - 1):
                on = (low + step <= high) & (low + step >= 0)
                at = low[on] + step  # ends differ between symbols, so no window is named twice here
                best[at] = np.minimum(best[at], name[on])
            take = open_ & (best != none)
            key[take] = best[take]
            open_[take] = False

        for r, (name, a, z) in reversed(level):
            if open_.any():
                choose(name, a, z, r + 1)
        if open_.any():  # no symbol inside: neighbours that differ and do not join
            at = np.flatnonzero(np.concatenate([[False], x[1:] != x[:-1]]))
            choose(mix64(x[at - 1]) + x[at] * U(3), at, at, 101)
        if open_.any():  # one word all along
            at = np.flatnonzero(open_)
            key[at] = mix64(mix64(x[at]) + x[at + w - 1] * U(5) + U(202))
        return key, whole

    def runs(self, texts: pa.Array) -> tuple[Runs, Callable[[np.ndarray], pa.Array]]:
        words, counts = split_words(texts)
        x = word_hashes(words)
        key, whole = self.window_keys(x, counts)
        at = np.flatnonzero(whole)
        doc = np.repeat(np.arange(len(counts)), counts)[at]
        k = key[at]
        fresh = np.concatenate([[True], (k[1:] != k[:-1]) | (doc[1:] != doc[:-1])]) if len(at) else np.empty(0, bool)
        head = np.flatnonzero(fresh)
        size = np.diff(np.append(head, len(at)))
        starts = np.cumsum(counts) - counts
        runs = Runs(doc[head], k[head], at[head] - starts[doc[head]], size)

        def content(chosen: np.ndarray) -> pa.Array:
            """A 64-bit hash of every window of the chosen runs, mixed with the key."""
            up, down = _powers(len(x))
            sums = np.concatenate([[U(0)], np.cumsum(x * up[:-1])])
            n = size[chosen]
            place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(at[head[chosen]], n)
            hashes = mix64(mix64((sums[place + self.window] - sums[place]) * down[place]) + np.repeat(k[head[chosen]], n))
            offsets = np.concatenate([[0], np.cumsum(n)]) * 8
            return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(hashes)])

        return runs, content

    def repeats(self, content: pa.Array, count: np.ndarray, doc_id: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        offsets = np.frombuffer(content.buffers()[1], np.int64)[content.offset : content.offset + len(content) + 1]
        hashes = np.frombuffer(content.buffers()[2], U)[offsets[0] // 8 : offsets[-1] // 8]
        run = np.repeat(np.arange(len(count)), count)
        order = np.argsort(hashes, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))
        ids = doc_id[run]
        least = np.repeat(np.minimum.reduceat(ids[order], first), np.diff(np.append(first, len(order))))
        late = np.zeros(len(run), bool)
        late[order] = ids[order] > least
        at = np.flatnonzero(late)
        if not len(at):
            return at, at, at
        fresh = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (run[at[1:]] != run[at[:-1]])])
        head = np.flatnonzero(fresh)
        begin = np.cumsum(count) - count
        return run[at[head]], at[head] - begin[run[at[head]]], np.diff(np.append(head, len(at)))


def remove_repeated_words(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Words outside all windows that an earlier document holds: ``doc_id, n_words, spans, kept``.

    ``docs`` has ``doc_id`` and ``text``; one row comes back for each. A word is removed if one of the
    ``window`` consecutive words around it also starts in a document with a smaller doc_id, judged on the
    input. ``spans`` are the removed word ranges, ``kept`` the other words joined by one space. Null
    texts have no words, texts shorter than a window and rows with a null doc_id lose none; rows that
    share a doc_id do not remove each other's words. An empty table gives an empty result.
    """

    def cut(rows: pa.RecordBatch, doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
        words, counts = split_words(rows.column("text"))
        base = np.cumsum(counts) - counts
        edge = np.zeros(len(words) + 1, np.int64)
        np.add.at(edge, base[doc] + start, 1)
        np.add.at(edge, base[doc] + end, -1)
        keep = np.cumsum(edge)[:-1] == 0
        left = np.bincount(np.repeat(np.arange(len(counts)), counts)[keep], minlength=len(counts))
        lists = pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(left)]).astype(np.int64)), words.filter(pa.array(keep)))
        kept = pc.binary_join(lists, pa.scalar(" ", pa.large_string())).cast(pa.string())
        spans = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(doc, np.arange(len(counts) + 1)).astype(np.int32)),
            pa.StructArray.from_arrays([pa.array(start.astype(np.int64)), pa.array(end.astype(np.int64))], names=["start", "end"]),
        )
        return pa.RecordBatch.from_arrays([rows.column("doc_id"), pa.array(counts.astype(np.int64)), spans, kept], names=["doc_id", "n_words", "spans", "kept"])

    schema = "doc_id long, n_words long, spans array<struct<start:long,end:long>>, kept string"
    return cut_repeats(docs.select("doc_id", "text"), Recompression(window), window, schema, cut)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 13-word windows that earlier documents hold."""
    got = remove_repeated_words(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return got.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP2_SQL = r"""
WITH words AS (
    SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE regexp_extract_all(text, '[^\x20\x09-\x0D]+') END AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS content
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM words WHERE doc_id IS NOT NULL AND len(w) >= 13)
), least AS (SELECT content, min(doc_id) AS first_doc FROM windows GROUP BY content),
covered AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS place
    FROM windows JOIN least USING (content) WHERE first_doc < doc_id
), gone AS (SELECT doc_id, list(place) AS places FROM covered GROUP BY doc_id)
SELECT words.doc_id, len(w)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN places IS NULL THEN w
              ELSE [w[k] FOR k IN range(1, len(w) + 1) IF NOT list_contains(places, k)] END, ' ')) AS kept_sha256
FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id
"""
