"""Packing tokenized documents into fixed-length sequences by bin completion."""

from __future__ import annotations

import heapq
import re
import struct
import zlib
from array import array
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.common import parts, stage, table

CAPACITY = 2048
SEPARATOR = 0
#: Nodes that the branch-and-bound visits before it settles for its incumbent; no document is left out by it.
SEARCH_NODES = 4000
#: Undominated fillings tried at a node, fullest first.
BREADTH = 6
#: Most rows of one length that are numbered together; longer runs are numbered in salted parts of this size.
RANK_ROWS = 50_000
#: Such parts hold no more than an even share of the rows and of the ids, cut for so many parts to a shuffle partition.
FINER = 8
#: Distinct words a Python worker keeps with their ids, and units of words.
CACHED_WORDS, CACHED_UNITS = 700_000, 150_000
#: Rows tokenized together, so that memory follows this and not the Arrow batch.
ROWS_AT_ONCE = 1000

PIECE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)
DIGEST = T.StructField("ids_crc32", T.LongType())


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: The pre-tokenizer's pattern on lower-case ASCII (fixed value).
ASCII_UNITS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")


class WordEncoder:
    """Ids of whole texts through the ids of their words, for the lower-casing word tokenizer.

    Its pre-tokenizer drops white space, so no token spans ASCII white space and a text's ids are those of
    its words one after another. Each distinct word is encoded once while it is cached. Printable ASCII
    words go straight to the tokenizer's model, others through its normalizer and pre-tokenizer, and those
    that could hold a special token through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.units: dict[str, bytes] = {}  # ids as 32-bit numbers, a fraction of the memory of lists
        self.flat = np.empty(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def _word(self, word: str) -> bytes:
        if "<|" in word:
            return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        if word.isascii() and word.isprintable():
            units = ASCII_UNITS.findall(word.lower())
        else:
            normal = self.tokenizer.normalizer.normalize_str(word)
            units = [x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]
        if len(self.units) + len(units) > CACHED_UNITS:
            self.units.clear()
        ids = []
        for unit in units:
            own = self.units.get(unit)
            if own is None:
                own = self.units[unit] = array("I", [x.id for x in self.model.tokenize(unit)]).tobytes()
            ids.append(own)
        return b"".join(ids)

    def _numbers(self, words: list[str]) -> np.ndarray:
        if len(self.known) + len(words) > CACHED_WORDS:
            self.clear()
        known, fresh = self.known, []
        for word in words:
            if word not in known:
                known[word] = len(known)
                fresh.append(self._word(word))
        if fresh:
            sizes = np.fromiter(map(len, fresh), np.int64, len(fresh)) // 4
            self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(fresh), np.uint32)])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text; a null text has none."""
        split = pc.ascii_split_whitespace(texts.fill_null("").cast(pa.large_string()))
        ends = np.asarray(split.offsets)
        coded = split.flatten().dictionary_encode()
        number = self._numbers(coded.dictionary.to_pylist())[np.asarray(coded.indices)]
        sizes = np.diff(self.starts)[number]
        upto = np.concatenate([[0], np.cumsum(sizes)])
        place = np.arange(upto[-1]) + np.repeat(self.starts[number] - upto[:-1], sizes)
        return self.flat[place], np.diff(upto[ends - ends[0]])


#: One encoder for each Python worker and tokenizer.
_ENCODERS: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def _forget() -> None:
    """Give back what this Python worker holds for tokenizing; it serves later stages, too."""
    _ENCODERS.clear()
    pa.default_memory_pool().release_unused()


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, digest: bool = False) -> DataFrame:
    """``doc_id, text`` to one row per piece: ``doc_id, piece, start, length, ids``, with ``digest`` also ``ids_crc32``.

    A document is its token ids and one separator id at the end; a null or empty text is the separator
    alone. Documents above ``capacity`` are cut into pieces of ``capacity`` ids, the last may be shorter.
    ``ids`` holds unsigned little-endian 32-bit ids, ``ids_crc32`` their unsigned CRC-32. Repeated rows give their
    pieces again.
    """
    path = tokenizer or default_tokenizer()
    schema = T.StructType([*PIECE.fields, DIGEST]) if digest else PIECE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                flat, sizes = encoder.encode(batch.column(1))
                total = sizes + 1
                ends = np.cumsum(total)
                ids = np.full(int(ends[-1]), SEPARATOR, "<u4")
                mark = np.ones(len(ids), bool)
                mark[ends - 1] = False
                ids[mark] = flat
                n = -(-total // capacity)
                row = np.repeat(np.arange(len(n)), n)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(capacity, total[row] - start)
                offsets = np.concatenate([[0], np.cumsum(length)]) * 4  # pieces follow each other in ids
                binary = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(row), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)]
                )
                columns = [
                    batch.column(0).take(pa.array(row)),
                    pa.array(piece.astype(np.int32)),
                    pa.array(start.astype(np.int64)),
                    pa.array(length.astype(np.int64)),
                    binary.cast(pa.binary()),
                ]
                if digest:
                    whole_ids, ends = memoryview(ids).cast("B"), offsets.tolist()
                    columns.append(pa.array([zlib.crc32(whole_ids[a:b]) for a, b in zip(ends, ends[1:])], pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


# Packing works on counts of lengths, of which there are at most as many as the capacity. A pattern is the
# tuple of lengths in one sequence with the number of sequences filled that way.


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: each length goes, as often as it fits, where least room is left."""
    open_at: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, filled: tuple[int, ...], n: int) -> None:
        if n:
            if room not in open_at:
                open_at[room] = []
                insort(rooms, room)
            open_at[room].append((filled, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                filled, n = open_at[room].pop()
                if not open_at[room]:
                    del open_at[room], rooms[at]
            else:
                room, filled, n = capacity, (), -(-left // (capacity // length))
            each = room // length
            whole = min(n, left // each)
            put(room - each * length, filled + (length,) * each, whole)
            left -= whole * each
            if whole < n:
                put(room - left * length, filled + (length,) * left, bool(left))
                put(room, filled, n - whole - bool(left)) if filled else None
                left = 0
    return [x for same in open_at.values() for x in same]


def fillings(room: int, lengths: list[int], counts: dict[int, int], breadth: int = BREADTH) -> list[tuple[int, ...]]:
    """Undominated ways to fill ``room`` with up to three of the ascending ``lengths``, fullest first.

    A filling is dominated if its items fit into the places of another one's items: a single item that
    leaves no more room dominates the pairs below it, and of two pairs with one item in common only the
    larger counts.
    """
    top = bisect_right(lengths, room)
    if not top:
        return [()]
    single = lengths[top - 1]
    found: dict[tuple[int, ...], int] = {(single,): single}
    if single == room:
        return [(single,)]

    def partner(limit: int, used: tuple[int, ...]) -> int | None:
        at = bisect_right(lengths, limit) - 1
        while at >= 0:
            if counts[lengths[at]] > used.count(lengths[at]):
                return lengths[at]
            at -= 1
        return None

    smallest = lengths[0]
    for at in range(top - 1, -1, -1):
        a = lengths[at]
        if 2 * a < single and len(found) >= breadth:
            break
        b = partner(min(a, room - a), (a,)) if room - a >= smallest else None
        if b is None:
            continue
        if a + b > single:
            found[(a, b)] = a + b
        rest = room - a - b
        if rest >= smallest and (c := partner(min(b, rest), (a, b))):
            found[(a, b, c)] = a + b + c
        if max(found.values()) == room and len(found) >= breadth:
            break
    return heapq.nlargest(breadth, found, key=lambda x: (found[x], -len(x), x))


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """The larger of the volume bound and the count of items above half, which never share a sequence."""
    volume = -(-sum(length * n for length, n in counts.items()) // capacity)
    return max(volume, sum(n for length, n in counts.items() if 2 * length > capacity))


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = SEARCH_NODES) -> list[tuple[tuple[int, ...], int]]:
    """Patterns that pack all items, by bin completion with branch and bound.

    The incumbent is best-fit decreasing. A node fills the sequences around the largest length left with
    one of the undominated fillings, as many times as the counts allow, and is pruned once the room wasted
    so far exceeds what a packing better than the incumbent may waste. It ends at the lower bound, when
    all is searched, or after ``nodes`` nodes, with the best packing found by then.
    """
    counts = {length: n for length, n in counts.items() if n > 0}
    incumbent = best_fit(counts, capacity)
    bins = sum(n for _, n in incumbent)
    bound, volume = lower_bound(counts, capacity), sum(length * n for length, n in counts.items())
    if bins <= bound:
        return incumbent

    left, order = dict(counts), sorted(counts)
    path: list[tuple[tuple[int, ...], int, int]] = []  # filling, times, waste before

    def take(filling: tuple[int, ...], times: int) -> None:
        for length in filling:
            left[length] -= times
            if left[length] == 0:
                del order[bisect_left(order, length)]

    def give(filling: tuple[int, ...], times: int) -> None:
        for length in filling:
            left[length] += times
            at = bisect_left(order, length)
            if at == len(order) or order[at] != length:
                insort(order, length)

    def choices(waste: int) -> Iterator[tuple[tuple[int, ...], int]]:
        big = order[-1]
        left[big] -= 1
        rest = order if left[big] else order[:-1]
        tried = fillings(capacity - big, rest, left)
        left[big] += 1
        for filling in tried:
            whole = (big, *filling)
            times = min(left[x] // whole.count(x) for x in set(whole))
            allowed = (bins - 1) * capacity - volume - waste
            lost = capacity - sum(whole)
            if lost * times > allowed and lost:
                times = allowed // lost
            if times > 0:
                yield whole, times

    # Depth first; each level keeps the choices it has not tried.
    waste, seen = 0, 0
    stack = [choices(0)]
    while stack and seen < nodes + len(path):
        if not order:
            packing: dict[tuple[int, ...], int] = {}
            for filling, times, _ in path:
                packing[filling] = packing.get(filling, 0) + times
            if sum(packing.values()) < bins:
                incumbent, bins = list(packing.items()), sum(packing.values())
                if bins <= bound:
                    break
            stack.append(iter(()))
        step = next(stack[-1], None)
        seen += 1
        if step is None:
            stack.pop()
            if path:
                filling, times, waste = path.pop()
                give(filling, times)
            continue
        filling, times = step
        path.append((filling, times, waste))
        take(filling, times)
        waste += (capacity - sum(filling)) * times
        stack.append(choices(waste) if order else iter(()))
    return incumbent


def _ranges(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length, rows of: first rank, first sequence, items in a sequence, offset of the first."""
    base, used, rows = 0, {}, {}
    for filled, n in patterns:
        offset = 0
        for length in sorted(set(filled), reverse=True):
            each = filled.count(length)
            rows.setdefault(length, []).append((used.get(length, 0), base, each, offset))
            used[length] = used.get(length, 0) + n * each
            offset += each * length
        base += n
    return {length: np.asarray(x, np.int64) for length, x in rows.items()}


def numbered_apart(counts: dict[int, int], places: int) -> dict[int, int]:
    """Into how many parts the rows of each length are dealt for numbering.

    A part takes no more than its share of all rows, and no more than its share of their ids, which may travel with
    them: rows of one length are the larger part of a corpus of long texts.
    """
    rows, volume = max(1, sum(counts.values())), max(1, sum(length * n for length, n in counts.items()))
    shares = FINER * places
    return {length: max(-(-n // RANK_ROWS), -(-n * shares // rows), -(-n * length * shares // volume), 1) for length, n in counts.items()}


def place(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Give every row a place: its columns with ``sequence_id, offset`` added.

    ``rows`` has ``doc_id, piece, length`` (1 to ``capacity``) and any columns besides ``sequence_id`` and
    ``offset``. Only the counts of lengths, at most ``capacity`` numbers, reach the driver, which solves
    the packing on them. Rows are numbered within their length, which are many rows or ids in salted parts,
    and a row's number says which sequence it goes to. Rows equal in doc_id and piece are interchangeable.
    An empty table gives an empty result.
    """
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    ranges = _ranges(bin_completion(counts, capacity))
    apart = numbered_apart(counts, parts(rows.sparkSession))
    salts = F.array(*(F.lit(apart.get(k, 1)) for k in range(capacity + 1)))
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.element_at(salts, F.col("length").cast("int") + 1)))
    numbered = salted.withColumn("_own", F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")) - 1)
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    ahead = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    ahead = ahead.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    ranked = numbered.join(ahead, ["length", "_salt"]).select(*rows.columns, (F.col("_own") + F.col("_ahead")).alias("_rank"))

    @F.arrow_udf("struct<sequence_id: long, offset: long>")
    def placed(lengths: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        _forget()  # the tokenizing is over
        for length, rank in lengths:
            length, rank = np.asarray(length), np.asarray(rank)
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for x in np.unique(length):
                of, own = ranges[int(x)], np.flatnonzero(length == x)
                first, base, each, start = of[np.searchsorted(of[:, 0], rank[own], "right") - 1].T
                sequence[own] = base + (rank[own] - first) // each
                offset[own] = start + (rank[own] - first) % each * x
            yield pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], names=["sequence_id", "offset"])

    # only length and rank go through Python, the other columns wait beside it
    found = ranked.withColumn("_place", placed("length", "_rank"))
    return found.select(*rows.columns, "_place.sequence_id", "_place.offset")


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their place: ``pieces`` and ``place`` in one, token ids included."""
    return place(stage(pieces(docs, tokenizer, capacity), "pieces"), capacity)


def digests(placed: DataFrame) -> DataFrame:
    """Replace ``ids`` by their unsigned CRC-32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = [zlib.crc32(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(4)] + [pa.array(crc, pa.int64())], names=[*PIECE.names[:4], "ids_crc32"])

    return placed.select(*PIECE.names).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens: a row per piece with its place.

    The ids are stored with the pieces and their digests; only the digests travel through the numbering.
    """
    return place(stage(pieces(table(spark, sf_dir, "documents"), digest=True), "pieces").drop("ids"))


def sequences(placed: DataFrame) -> DataFrame:
    """One row per sequence: ``sequence_id, doc_ids, length, ids``, the pieces in the order of their offsets."""
    one = F.struct("offset", "doc_id", "length", "ids")
    rows = placed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(one)).alias("all"))
    return rows.select(
        "sequence_id",
        F.col("all.doc_id").alias("doc_ids"),
        F.aggregate("all.length", F.lit(0).cast("long"), lambda a, x: a + x).alias("length"),
        F.aggregate("all.ids", F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x)).alias("ids"),
    )


def ids_of(payload: bytes) -> tuple[int, ...]:
    return struct.unpack(f"<{len(payload) // 4}I", payload)
