"""Cross-entropy difference scores from matched target and background bigram models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import DEALT, dealt, packed, parts, split_words, stage, table, unpacked
from tallyline.llm.langid import HashTable

#: Words of the shared vocabulary; the rest are one unknown word. Ids take 16 bits with it and the start.
VOCABULARY = 65_000
UNKNOWN = 0
START = 0xFFFF
DISCOUNT = 0.75
#: The most frequent bigrams, whose scores every task gets; only the others are looked up by a shuffle.
#: No bigram of the shuffle is therefore frequent, so none makes a hot key.
FREQUENT = 1_000_000
ROWS_AT_ONCE = 2000
#: Bigrams or words a task gathers before it hands on their counts.
GATHERED = 4_000_000


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case words as 64-bit hashes, and the number of words of each text."""
    import xxhash

    words, counts = split_words(pc.utf8_lower(texts.fill_null("").cast(pa.large_string())))
    coded = words.dictionary_encode()
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return hashes[np.asarray(coded.indices)] if len(coded.indices) else np.empty(0, np.uint64), counts


def vocabulary(docs: DataFrame, size: int = VOCABULARY) -> np.ndarray:
    """Sorted hashes of the ``size`` most frequent words of all texts; equal counts go to the smaller hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def sums() -> pa.RecordBatch:
            hashes, at = np.unique(np.concatenate([x for x, _ in waiting]), return_inverse=True)
            n = np.bincount(at, np.concatenate([c for _, c in waiting]), len(hashes)).astype(np.int64)
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(n)], names=["word", "n"])

        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                waiting.append(np.unique(_words(whole.column(0).slice(at, ROWS_AT_ONCE))[0], return_counts=True))
                if sum(len(x) for x, _ in waiting) > GATHERED // 2:
                    yield sums()
        if waiting:
            yield sums()

    words = docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = stage(words, "words")
    # the least count that keeps no more than size words; the rest of the places go by hash
    by_count = words.groupBy(F.least("n", F.lit(1 << 20)).alias("n")).agg(F.count("*").alias("words")).orderBy(F.desc("n")).collect()
    total, least = 0, None
    for r in by_count:
        if total + r["words"] > size:
            least = r["n"]
            break
        total += r["words"]
    top = words if least is None else words.where(F.col("n") > least)
    ids = [np.asarray(top.select("word").toArrow().column(0).combine_chunks())]
    if least is not None and total < size:
        edge = words.where(F.col("n") == least) if least < 1 << 20 else words.where(F.col("n") >= least)
        ids.append(np.asarray(edge.orderBy(F.desc("n"), "word").limit(size - total).select("word").toArrow().column(0).combine_chunks()))
    return np.sort(np.concatenate(ids).view(np.uint64))


def tokens(docs: DataFrame, vocab: np.ndarray) -> DataFrame:
    """``row, doc_id, n, ids`` of every row: 16-bit word ids, stored once; ``row`` tells rows apart."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = HashTable(shared.value, np.arange(1, len(shared.value) + 1))
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                hashes, n = _words(batch.column(1))
                place = find.find(hashes)
                ids = np.where(place >= 0, find.rows[place] if len(find.rows) else UNKNOWN, UNKNOWN).astype("<u2")
                offsets = np.concatenate([[0], np.cumsum(n)]) * 2
                binary = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(n.astype(np.int64)), binary.cast(pa.binary())], names=["doc_id", "n", "ids"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, ids binary")
    return stage(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "n", "ids"), "tokens")


def _bigrams(ids: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bigrams of all rows as one 32-bit number each, every row after START; the row of each."""
    parts_of = [np.frombuffer(x, "<u2") for x in ids.to_pylist()]
    n = np.fromiter(map(len, parts_of), np.int64, len(parts_of))
    after = np.concatenate(parts_of).astype(np.uint32) if parts_of else np.empty(0, np.uint32)
    before = np.empty(len(after), np.uint32)
    before[1:] = after[:-1]
    starts = (np.cumsum(n) - n)[n > 0]
    before[starts] = START
    return before << np.uint32(16) | after, np.repeat(np.arange(len(n)), n)


def _bucket(pairs: np.ndarray, n: int) -> np.ndarray:
    return (pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % n


def _dealt(columns: dict[str, np.ndarray], bucket: np.ndarray, kind: int) -> pa.RecordBatch:
    return dealt(pa.RecordBatch.from_arrays([pa.array(x) for x in columns.values()], names=list(columns)), bucket, kind, 3)


def bigram_counts(rows: DataFrame) -> DataFrame:
    """Background and target counts of all bigrams, packed by bucket and stored. ``rows``: ``ids, target``."""
    n = parts(rows.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []

        def sums() -> pa.RecordBatch:
            pairs, at = np.unique(np.concatenate([x for x, _ in waiting]), return_inverse=True)
            hit = np.concatenate([t for _, t in waiting])
            waiting.clear()
            back, target = np.bincount(at, minlength=len(pairs)), np.bincount(at, hit, len(pairs))
            return _dealt({"pair": pairs, "back": back.astype(np.int64), "target": target.astype(np.int64)}, _bucket(pairs, n), 0)

        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                pairs, row = _bigrams(batch.column(0))
                waiting.append((pairs, np.asarray(batch.column(1).to_numpy(zero_copy_only=False), bool)[row]))
                if sum(len(x) for x, _ in waiting) > GATHERED:
                    yield sums()
        if any(len(x) for x, _ in waiting):
            yield sums()

    def merge(cell: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, None
        for batch in cell:
            bucket = batch.column(0)[0].as_py()
            for payload in batch.column(2).to_pylist():
                got = unpacked(payload)
                held = got if held is None else pa.concat_tables([held, got])
                if held.num_rows > GATHERED:
                    held = _summed(held)
        yield pa.RecordBatch.from_arrays([pa.array([bucket]), pa.array([0], pa.int32()), pa.array([packed(_summed(held).combine_chunks().to_batches()[0])])], names=["bucket", "kind", "payload"])

    return stage(rows.select("ids", "target").mapInArrow(count, DEALT).groupBy("bucket").applyInArrow(merge, DEALT), "bigrams", "none")


def _summed(rows: pa.Table) -> pa.Table:
    pairs, at = np.unique(np.asarray(rows.column("pair")), return_inverse=True)
    return pa.table({"pair": pairs} | {c: np.bincount(at, np.asarray(rows.column(c)), len(pairs)).astype(np.int64) for c in ("back", "target")})


class Matched:
    """What scoring a bigram takes beside its counts: both models' unigrams and context totals."""

    def __init__(self, size: int, contexts: dict[str, np.ndarray], words: dict[str, np.ndarray]):
        self.size = size
        self.total = {m: contexts[m] for m in ("back", "target")}
        self.types = {m: contexts[f"{m}_types"] for m in ("back", "target")}
        self.unigram = {m: (words[m] + 1.0) / (words[m].sum() + size + 1.0) for m in ("back", "target")}

    def log_p(self, pairs: np.ndarray, counts: np.ndarray, model: str) -> np.ndarray:
        """Absolute discounting, interpolated with the unigrams; an unseen context leaves the unigrams."""
        before, after = pairs >> np.uint32(16), pairs & np.uint32(0xFFFF)
        total = self.total[model][before]
        rest = np.where(total > 0, DISCOUNT * self.types[model][before] / np.maximum(total, 1), 1.0)
        seen = np.maximum(counts - DISCOUNT, 0) / np.maximum(total, 1)
        return np.log(seen + rest * self.unigram[model][after])


def _tables(counts: DataFrame, size: int) -> Matched:
    """Sums over contexts and over words of all bigrams: at most 65,536 rows each."""

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, 1 << 16), np.int64)
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                rows = unpacked(payload)
                pair = np.asarray(rows.column("pair"))
                for k, m in enumerate(("back", "target")):
                    c = np.asarray(rows.column(m))
                    sums[3 * k] += np.bincount(pair >> 16, c, 1 << 16).astype(np.int64)
                    sums[3 * k + 1] += np.bincount(pair >> 16, c > 0, 1 << 16).astype(np.int64)
                    sums[3 * k + 2] += np.bincount(pair & 0xFFFF, c, 1 << 16).astype(np.int64)
        used = np.flatnonzero(sums.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(s[used]) for s in sums)], names=["id", *"abcdef"])

    got = counts.select("payload").mapInArrow(totals, "id long, a long, b long, c long, d long, e long, f long")
    got = got.groupBy("id").agg(*[F.sum(x).alias(x) for x in "abcdef"]).toArrow()
    full = np.zeros((6, 1 << 16))
    if got.num_rows:
        full[:, np.asarray(got.column("id"))] = np.stack([np.asarray(got.column(x)) for x in "abcdef"])
    return Matched(size, {"back": full[0], "back_types": full[1], "target": full[3], "target_types": full[4]}, {"back": full[2], "target": full[5]})


def _frequent(counts: DataFrame, most: int) -> tuple[int, pa.Table]:
    """The least count that at most ``most`` bigrams reach, and these bigrams."""
    cap = 1 << 12

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(cap + 1, np.int64)
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                n += np.bincount(np.minimum(np.asarray(unpacked(payload).column("back")), cap), minlength=cap + 1)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used])], names=["count", "n"])

    rows = counts.select("payload").mapInArrow(spread, "count long, n long").groupBy("count").agg(F.sum("n").alias("n")).collect()
    total, least = 0, cap
    for r in sorted(rows, key=lambda r: -r["count"]):
        total += r["n"]
        if total > most:
            break
        least = r["count"]

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                got = unpacked(payload)
                got = got.filter(pc.greater_equal(got.column("back"), least)).combine_chunks()
                for part in got.to_batches():
                    yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), part.column(1), part.column(2)], names=["pair", "back", "target"])

    return least, counts.select("payload").mapInArrow(pick, "pair long, back long, target long").toArrow()


def _row_sums(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of both losses by row, rows in order."""
    row, target, back = (np.concatenate(x) for x in zip(*found, strict=True))
    rows, at = np.unique(row, return_inverse=True)
    return rows, np.bincount(at, target), np.bincount(at, back)


def score(docs: DataFrame, is_target: DataFrame, vocabulary_size: int = VOCABULARY, frequent: int = FREQUENT) -> DataFrame:
    """Cross-entropy difference of every document: ``doc_id, n_tokens, target_loss, background_loss, score``.

    ``is_target`` lists the doc_ids of the target texts; the background is all of ``docs``. Both models
    are bigram models with absolute discounting over one vocabulary, counted over all their texts.
    Losses are nats per token over whole texts; ``score`` is target less background, so low scores are
    close to the target. A document without words has 0 tokens and null losses. Null doc_ids are never
    target; repeated rows are scored each. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    n = parts(spark)
    vocab = vocabulary(docs, vocabulary_size)
    rows = tokens(docs, vocab)
    marks = is_target.select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("target", F.lit(True))
    marked = rows.join(marks, "doc_id", "left").select("ids", F.coalesce("target", F.lit(False)).alias("target"))
    counts = bigram_counts(marked)
    matched = _tables(counts, len(vocab))
    least, top = _frequent(counts, frequent)
    pairs = np.asarray(top.column("pair")).astype(np.uint32)
    known = np.stack([matched.log_p(pairs, np.asarray(top.column(m)), m) for m in ("target", "back")], 1)
    shared = spark.sparkContext.broadcast((matched, HashTable(pairs.astype(np.uint64), known)))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent_pairs = shared.value[1]
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                pairs, row = _bigrams(batch.column(1))
                names = np.asarray(batch.column(0))
                place = frequent_pairs.find(pairs.astype(np.uint64))
                hit = place >= 0
                if hit.any():
                    sums = [np.bincount(row[hit], frequent_pairs.rows[place[hit], k], len(names)) for k in range(2)]
                    used = np.unique(row[hit])
                    yield _dealt({"row": names[used], "target": sums[0][used], "back": sums[1][used]}, np.full(len(used), int(names[0]) % n), 2)
                if not hit.all():
                    yield _dealt({"pair": pairs[~hit], "row": names[row[~hit]]}, _bucket(pairs[~hit], n), 1)

    def resolve(cell: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[pa.Table]] = [[], [], []]
        for batch in cell:
            for kind, payload in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                held[kind].append(unpacked(payload))
        found = [(np.asarray(t.column("row")), np.asarray(t.column("target")), np.asarray(t.column("back"))) for t in held[2]]
        if held[1]:
            model = pa.concat_tables(held[0])
            pair = np.asarray(model.column("pair"))
            logs = [shared.value[0].log_p(pair, np.asarray(model.column(m)), m) for m in ("target", "back")]
            for t in held[1]:
                at = np.searchsorted(pair, np.asarray(t.column("pair")))
                found.append((np.asarray(t.column("row")), logs[0][at], logs[1][at]))
        if found:
            row, target, back = _row_sums(found)
            yield _dealt({"row": row, "target": target, "back": back}, row % n, 0)

    def add(cell: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for batch in cell:
            for payload in batch.column(2).to_pylist():
                t = unpacked(payload)
                found.append(tuple(np.asarray(t.column(c)) for c in ("row", "target", "back")))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in _row_sums(found)], names=["row", "target", "back"])

    asked = rows.select("row", "ids").mapInArrow(look, DEALT).union(counts.select("bucket", "kind", "payload"))
    sums = asked.groupBy("bucket").applyInArrow(resolve, DEALT)
    sums = sums.groupBy("bucket").applyInArrow(add, "row long, target double, back double")
    out = rows.select("row", "doc_id", "n").join(sums, "row", "left")
    tokens_of = F.when(F.col("n") > 0, F.col("n"))
    return out.select(
        "doc_id",
        F.col("n").alias("n_tokens"),
        (-F.col("target") / tokens_of).alias("target_loss"),
        (-F.col("back") / tokens_of).alias("background_loss"),
        ((F.col("back") - F.col("target")) / tokens_of).alias("score"),
    )


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored against the labelled clean texts of good quality."""
    good = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0")
    return score(table(spark, sf_dir, "documents"), good)
