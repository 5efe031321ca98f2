"""Removing what earlier documents already hold: the Spark side, shared by the word and the byte form.

A unit of length L (words or bytes) that also starts in a document with a smaller doc_id is removed. Both
forms give each L-long window a key that depends on nothing but its content; consecutive windows with one
key make a run. Three shuffles follow:

1. Runs by key. A key that several documents have may hide a repeat; those runs are told to their documents.
2. Windows of these runs with their content, again by key. Equal windows learn the smallest doc_id, and
   windows of other documents are told to their documents.
3. Documents with their ranges, which are cut out.

Rows travel packed, a payload per task and part, and parts are as many as the session's shuffle
partitions. Documents are told apart by a hash of doc_id and text, so equal ids with different texts keep
their own ranges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.common import DEALT, dealt, parts, slices, unpacked

#: Bytes of text whose windows are keyed at once; memory follows this, or the longest text.
TEXT_AT_ONCE = 1 << 21
#: Bytes of window contents that a part gathers before it hands them on.
GATHERED = 1 << 26
#: Compression of texts and contents, which are the larger part of what is shuffled.
TEXT_LEVEL = 5
ROW = "_row"


@dataclass
class Runs:
    """Runs of windows with one key, in document order. ``doc`` counts the rows of the slice."""

    doc: np.ndarray
    key: np.ndarray
    start: np.ndarray
    count: np.ndarray

    def ordinals(self, docs: int) -> tuple[np.ndarray, np.ndarray]:
        """First run of each document, and each run's number within its document."""
        first = np.searchsorted(self.doc, np.arange(docs + 1))
        return first, np.arange(len(self.doc)) - first[self.doc]


class Form(Protocol):
    def runs(self, texts: pa.Array) -> tuple[Runs, Callable[[np.ndarray], pa.Array]]:
        """Runs of the texts, and a function from chosen runs to the content of their windows."""

    def repeats(self, content: pa.Array, count: np.ndarray, doc_id: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ranges of windows whose content a smaller doc_id also has: run, first window, number of windows."""


def _numbers(batch: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    x = batch.column(name)
    return np.asarray(x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x)


def _bucket(key: np.ndarray, n: int) -> np.ndarray:
    return ((key >> np.uint64(40)) % np.uint64(n)).astype(np.int64)


def _part(row: np.ndarray, n: int) -> np.ndarray:
    return row % n  # numpy's remainder is not negative


def _first_pass(docs: DataFrame, form: Form, n: int) -> DataFrame:
    """Runs by key: the low 40 bits of the key beside its bucket, the row and the run's number in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for part in slices(batch, "text", TEXT_AT_ONCE):
                runs, _ = form.runs(part.column("text"))
                _, ordinal = runs.ordinals(part.num_rows)
                out.append((runs.key, _numbers(part, ROW)[runs.doc], ordinal.astype(np.uint32)))
            key, row, ordinal = (np.concatenate(x) for x in zip(*out, strict=True)) if out else (np.empty(0, np.uint64),) * 3
            if len(key):
                low = pa.array((key & np.uint64(0xFFFFFFFF)).astype(np.uint32))
                high = pa.array(((key >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8))
                rows = pa.RecordBatch.from_arrays([low, high, pa.array(row), pa.array(ordinal)], names=["low", "high", "row", "run"])
                yield dealt(rows, _bucket(key, n), 0)

    def shared(cell: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [unpacked(x) for batch in cell for x in batch.column(2).to_pylist()]
        if not got:
            return
        rows = pa.concat_tables(got)
        del got
        key = _numbers(rows, "low").astype(np.uint64) | _numbers(rows, "high").astype(np.uint64) << np.uint64(32)
        order = np.argsort(key, kind="stable")
        key, row = key[order], _numbers(rows, "row")[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        several = np.minimum.reduceat(row, first) != np.maximum.reduceat(row, first)
        chosen = np.repeat(several, np.diff(np.append(first, len(key))))
        if chosen.any():
            row, run_of = row[chosen], _numbers(rows, "run")[order][chosen]
            told = np.argsort(row, kind="stable")
            yield dealt(pa.RecordBatch.from_arrays([pa.array(row[told]), pa.array(run_of[told])], names=["row", "run"]), _part(row[told], n), 1)

    rows = docs.where("doc_id is not null and text is not null").select(ROW, "text")
    return rows.mapInArrow(run, DEALT).groupBy("bucket").applyInArrow(shared, DEALT)


def _packed_rows(docs: DataFrame, n: int) -> DataFrame:
    """Documents packed by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield dealt(batch, _part(_numbers(batch, ROW), n), 0, TEXT_LEVEL)

    return docs.mapInArrow(run, DEALT)


def _gathered(cell: Iterator[pa.RecordBatch]) -> tuple[list[bytes], list[pa.Table]]:
    """Payloads of documents, still packed, and what they are told."""
    docs, told = [], []
    for batch in cell:
        for kind, payload in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            if kind:
                told.append(unpacked(payload))
            else:
                docs.append(payload)
    return docs, told


def _sorted_by_row(told: list[pa.Table], names: list[str]) -> list[np.ndarray]:
    if not told:
        return [np.empty(0, np.int64) for _ in names]
    rows = pa.concat_tables(told)
    order = np.argsort(_numbers(rows, "row"), kind="stable")
    return [_numbers(rows, x)[order] for x in names]


def _matches(row: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each document the range of the sorted ``row`` that belongs to it, as pairs (document, index)."""
    low, high = np.searchsorted(row, of, "left"), np.searchsorted(row, of, "right")
    n = high - low
    doc = np.repeat(np.arange(len(of)), n)
    return doc, np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n) + low[doc]


def _second_pass(docs: DataFrame, told: DataFrame, form: Form, n: int) -> DataFrame:
    """Windows of the runs that may repeat, by key; back come ranges of windows to remove, by document."""

    def run(cell: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        payloads, answers = _gathered(cell)
        row, number = _sorted_by_row(answers, ["row", "run"])
        if not len(row):
            return
        out: list[tuple] = []

        def gathered() -> pa.RecordBatch:
            key, ids, own, start, count = (np.concatenate(x) for x in list(zip(*out, strict=True))[:5])
            rows = pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(own), pa.array(start.astype(np.uint32)), pa.array(count.astype(np.uint32)), pa.concat_arrays([x[5] for x in out])],
                names=["doc_id", "row", "start", "count", "content"],
            )
            out.clear()
            return dealt(rows, _bucket(key, n), 0, TEXT_LEVEL)

        for payload in payloads:
            for batch in unpacked(payload).to_batches():
                for part in slices(batch, "text", TEXT_AT_ONCE):
                    ids, own = _numbers(part, "doc_id"), _numbers(part, ROW)
                    doc, at = _matches(row, own)
                    if not len(doc):
                        continue
                    runs, content = form.runs(part.column("text"))
                    first, _ = runs.ordinals(part.num_rows)
                    chosen = np.unique(first[doc] + number[at])
                    mine = runs.doc[chosen]
                    out.append((runs.key[chosen], ids[mine], own[mine], runs.start[chosen], runs.count[chosen], content(chosen)))
                    if sum(x[5].nbytes for x in out) > GATHERED:
                        yield gathered()
        if out:
            yield gathered()

    def resolve(cell: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [unpacked(x) for batch in cell for x in batch.column(2).to_pylist()]
        if not got:
            return
        rows = pa.concat_tables(got)
        del got
        content = rows.column("content").combine_chunks()
        which, first, count = form.repeats(content, _numbers(rows, "count").astype(np.int64), _numbers(rows, "doc_id"))
        if len(which):
            row = _numbers(rows, "row")[which]
            start = _numbers(rows, "start")[which].astype(np.int64) + first
            told = np.lexsort((start, row))
            batch = pa.RecordBatch.from_arrays([pa.array(x[told].astype(t)) for x, t in ((row, np.int64), (start, np.uint32), (count, np.uint32))], names=["row", "start", "count"])
            yield dealt(batch, _part(row[told], n), 1)

    rows = _packed_rows(docs.where("doc_id is not null and text is not null").select(ROW, "doc_id", "text"), n)
    asked = rows.union(told).groupBy("bucket").applyInArrow(run, DEALT)
    return asked.groupBy("bucket").applyInArrow(resolve, DEALT)


def merged(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of overlapping or touching ranges within each document, in order."""
    if not len(doc):
        return doc, start, end
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order].astype(np.int64), end[order].astype(np.int64)
    span = int(end.max()) + 2
    reach = np.maximum.accumulate(doc.astype(np.int64) * span + end)  # documents lie apart, so the maximum never crosses
    fresh = np.concatenate([[True], doc[1:].astype(np.int64) * span + start[1:] > reach[:-1]])
    first = np.flatnonzero(fresh)
    return doc[first], start[first], reach[np.append(first[1:], len(doc)) - 1] - doc[first].astype(np.int64) * span


def cut_repeats(
    docs: DataFrame, form: Form, length: int, schema: str, cut: Callable[[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray], pa.RecordBatch]
) -> DataFrame:
    """Every row of ``docs`` with its repeated ranges cut out by ``cut(rows, doc, start, end)``.

    ``docs`` has ``doc_id`` and ``text``; rows with a null in either neither lose anything nor count as
    earlier documents. ``schema`` is that of the rows that ``cut`` returns.
    """
    n = parts(docs.sparkSession)
    rows = docs.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn(ROW, F.xxhash64("doc_id", "text"))
    ranges = _second_pass(rows, _first_pass(rows, form, n), form, n)

    def run(cell: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        payloads, answers = _gathered(cell)
        row, start, count = _sorted_by_row(answers, ["row", "start", "count"])
        for payload in payloads:
            for batch in unpacked(payload).to_batches():
                for part in slices(batch, "text", 4 * TEXT_AT_ONCE):
                    doc, at = _matches(row, _numbers(part, ROW))
                    first = start[at].astype(np.int64)
                    yield cut(part, *merged(doc, first, first + count[at].astype(np.int64) + length - 1))

    return _packed_rows(rows, n).union(ranges).groupBy("bucket").applyInArrow(run, schema)
