"""Near-duplicates by order MinHash sketches, completed by rare shingles and verified by banded alignment."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import components, mix64, slices, split_words, stage, table
from tallyline.llm.substrings import word_hashes

SHINGLE = 5
THRESHOLD = 0.8
#: Sketches of a document, and the shingles each one samples. Two texts at the threshold with m of u
#: shingles in common share a sketch with a chance of C(m, 6) / C(u, 6), in the limit 0.8 ** 6; that all 40
#: miss has a chance of 9e-6 at u = 101 and 5e-6 in the limit. Texts that share no more than a passage
#: rarely sample six shingles from it.
SKETCHES = 40
SAMPLED = 6
#: Texts of up to so many shingles meet by their rarest shingles as well, which misses no pair: they have too
#: few shingles for the chance above.
SHORT = 100
#: Rounds in which everything in a bucket is compared with one of its members, which gathers the groups before
#: members of different groups are compared.
HUB_ROUNDS = 2
#: Longs of a text's parities, which bound from below how many shingles two texts do not share. They tell texts of
#: up to about 1000 shingles apart; longer ones pass.
PARITIES = 8
TEXT_AT_ONCE = 1 << 21
U = np.uint64
#: Odd multipliers, one per sketch.
SEEDS = mix64(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)


def shingles(words: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """Hash of each run of ``size`` words; a shorter text is one shingle, no words are none."""
    words = words.astype(U)
    if len(words) < size:
        size = len(words)
    if not size:
        return words
    out = np.zeros(len(words) - size + 1, U)
    for k in range(size):
        out = (out ^ words[k : k + len(out)]) * U(0x9E3779B97F4A7C15)
        out ^= out >> U(29)
    return mix64(out)


def labelled(found: np.ndarray) -> np.ndarray:
    """Shingles mixed with their occurrence number, so that each is unique in its text."""
    order = np.argsort(found, kind="stable")
    ranked = found[order]
    head = np.concatenate([[True], ranked[1:] != ranked[:-1]]) if len(found) else np.empty(0, bool)
    at = np.arange(len(found))
    number = at - np.maximum.accumulate(np.where(head, at, 0)) if len(found) else at
    out = found.copy()
    out[order] = mix64(ranked + number.astype(U) * U(0xA0761D6478BD642F))
    return out


def order_sketches(found: np.ndarray, sketches: int = SKETCHES, sampled: int = SAMPLED) -> np.ndarray:
    """Order MinHash: the ``sampled`` least of the labelled shingles under each hash, in text order."""
    marks = labelled(found)
    out = np.empty(sketches, U)
    values = (marks[None, :] ^ SEEDS[:sketches, None]) * SEEDS[:sketches, None]
    values ^= values >> U(31)
    take = min(sampled, len(marks))
    least = np.argpartition(values, take - 1, axis=1)[:, :take] if take < len(marks) else np.tile(np.arange(len(marks)), (sketches, 1))
    least.sort(axis=1)
    out = SEEDS[:sketches].copy()
    for k in range(take):
        out = mix64(out ^ found[least[:, k]]) * U(0xE7037ED1A0B428DB)
    return out


def aligned(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> float:
    """Similarity of two texts given as words: shingles matched in order over all shingles of both.

    Only alignments that could reach ``threshold`` are looked for, others give 0: with m matches of n_a
    and n_b shingles, m / (n_a + n_b - m) >= threshold leaves room for so many unmatched shingles on
    either side, which bounds how far a match may lie off the diagonal. Inside that band the longest
    chain of matches is found. Occurrence labels make the matches one to one.
    """
    x, y = shingles(a), shingles(b)
    if not len(x) or not len(y):
        return 0.0
    need = threshold * (len(x) + len(y)) / (1 + threshold)
    if min(len(x), len(y)) < need - 1e-9:
        return 0.0
    if len(x) == len(y) and (x == y).all():
        return 1.0
    x, y = labelled(x), labelled(y)
    order = np.argsort(y)
    at = np.minimum(np.searchsorted(y[order], x), len(y) - 1)
    place = order[at]
    hit = np.flatnonzero(y[place] == x)
    place = place[hit]
    band = (place - hit <= len(y) - need + 1e-9) & (hit - place <= len(x) - need + 1e-9)
    place = place[band]
    if len(place) < need - 1e-9:
        return 0.0
    if (place[1:] > place[:-1]).all():
        chain = len(place)
    else:
        tops: list[int] = []
        for p in place.tolist():
            k = bisect_left(tops, p)
            if k == len(tops):
                tops.append(p)
            else:
                tops[k] = p
        chain = len(tops)
    return chain / (len(x) + len(y) - chain)


def _digests(x: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit hashes of each text's word sequence."""
    out = []
    for seed in (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F)):
        place = np.arange(len(x), dtype=np.int64) - np.repeat(starts, counts)
        marks = mix64(mix64(x ^ seed) + place.astype(U) * seed)
        sums = np.concatenate([[U(0)], np.cumsum(marks)])
        out.append(mix64(sums[starts + counts] - sums[starts] + counts.astype(U)).view(np.int64))
    return out


def sketch_table(docs: DataFrame, count: int = SKETCHES, sampled: int = SAMPLED) -> DataFrame:
    """``doc_id, n, h1, h2, sketches`` of every row with words and a doc_id.

    Sketches start with their number and so differ from each other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", TEXT_AT_ONCE):
                words, counts = split_words(part.column("text"))
                x = word_hashes(words)
                starts = np.cumsum(counts) - counts
                h1, h2 = _digests(x, starts, counts)
                used = np.flatnonzero(counts)
                made = [order_sketches(shingles(x[starts[i] : starts[i] + counts[i]]), count, sampled) for i in used]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(used)), *(pa.array(v[used]) for v in (counts.astype(np.int64), h1, h2)), _lists(made)],
                    names=["doc_id", "n", "h1", "h2", "sketches"],
                )

    rows = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id long, n long, h1 long, h2 long, sketches array<bigint>")


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, U), *values]).view(np.int64)))


def _words_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``id, words`` of the wanted documents: 32-bit hashes of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", TEXT_AT_ONCE):
                words, counts = split_words(part.column("text"))
                x = (word_hashes(words) >> U(32)).astype("<u4")
                offsets = np.concatenate([[0], np.cumsum(counts)]) * 4
                made = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(x)])
                yield pa.RecordBatch.from_arrays([part.column("id"), made.cast(pa.binary())], names=["id", "words"])

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text").where("text is not null").join(wanted, "id", "left_semi")
    return rows.mapInArrow(run, "id long, words binary")


def shingle_rows(words: DataFrame) -> DataFrame:
    """``rep, key``: every labelled shingle of the texts ``id, words``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "words", TEXT_AT_ONCE):
                marks = [labelled(shingles(np.frombuffer(v.as_buffer(), "<u4"))) for v in part.column("words")]
                row = np.repeat(np.arange(len(marks)), [len(m) for m in marks])
                keys = np.concatenate([np.empty(0, U), *marks]).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(row)), pa.array(keys)], names=["rep", "key"])

    return words.select("id", "words").mapInArrow(run, "rep long, key long")


def parity_table(words: DataFrame) -> DataFrame:
    """``rep, parities`` of the texts ``id, words``: of each of 64 ``PARITIES`` classes of labelled shingles, whether
    their number is odd. Where the parities of two texts differ, one has a shingle of this class that the other lacks.
    """
    bits = 64 * PARITIES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.zeros((batch.num_rows, bits), np.uint8)
            for i, v in enumerate(batch.column("words")):
                found = labelled(shingles(np.frombuffer(v.as_buffer(), "<u4")))
                made[i] = np.bincount((found >> U(32)).astype(np.int64) % bits, minlength=bits) & 1
            yield pa.RecordBatch.from_arrays([batch.column("id"), _lists(list(np.packbits(made, axis=1).view(U)))], names=["rep", "parities"])

    return words.select("id", "words").mapInArrow(run, "rep long, parities array<bigint>")


def _apart_by(x: str, y: str) -> Column:
    """In how many classes of shingles two texts differ, by their parities; they differ in so many shingles at least."""
    return sum((F.bit_count(F.col(x)[k].bitwiseXOR(F.col(y)[k])) for k in range(PARITIES)), F.lit(0))


def rare_buckets(rows: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Buckets of texts with a rare shingle in common: ``bucket, rep, n, root, index``.

    ``rows`` is ``shingle_rows`` of the ``texts`` (``rep, n, root``). In one order of all shingles, from the
    rarest to the most frequent, two texts with o shingles in common share one of the first n - o + 1 of each. At
    the threshold t, o is at least t * n for either text and at least 2 t / (1 + t) * n for the shorter one, whose
    fewer ones are marked ``index``. So every pair has a bucket that the shorter text is in by ``index``. Shingles
    of a single text come first in the order and take places, but no rows: texts that share only a passage, and
    are different enough beside it, are in no bucket together.
    """
    several = rows.groupBy("key").agg(F.count("*").alias("df")).where("df > 1")
    shared = rows.join(several, "key").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("df", "key"))).alias("shared"))

    def first(least: float) -> Column:
        """How many of the shared shingles are among the first ones of a text, given the least overlap."""
        return F.col("n") - F.ceil(F.col("n") * least - 1e-9) + 1 - (F.col("n") - F.size("shared"))

    found = shared.join(texts, "rep").where(first(threshold) > 0)
    found = found.select("rep", "n", "root", first(2 * threshold / (1 + threshold)).alias("few"), F.posexplode(F.slice("shared", F.lit(1), first(threshold).cast("int"))))
    return found.select(F.col("col.key").alias("bucket"), "rep", "n", "root", (F.col("pos") < F.col("few")).alias("index"))


def _verified(pairs: DataFrame, words: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` whose texts align to at least ``threshold``; more than once where versions share an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [[np.frombuffer(v.as_buffer(), "<u4") for v in batch.column(c)] for c in ("x", "y")]
            good = [aligned(p, q, threshold) >= threshold for p, q in zip(*sides, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(good, pa.bool_())) for c in ("a", "b")], names=["a", "b"])

    left = words.select(F.col("id").alias("b"), F.col("words").alias("y"))
    right = words.select(F.col("id").alias("a"), F.col("words").alias("x"))
    both = pairs.join(left, "b").join(right, "a").select("a", "b", "x", "y")
    return both.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, sketches: int = SKETCHES, sampled: int = SAMPLED) -> DataFrame:
    """Groups of near-duplicate documents: ``doc_id, class_id, kept``, a row per row of ``docs``.

    Two texts link if their five-word shingles, matched in text order, reach ``threshold`` (see
    ``aligned``) and they meet: by a sketch or, if neither has more than ``SHORT`` shingles, by a rare one, which
    misses none. Equal word sequences always link. A group is a connected
    component, ``class_id`` its smallest doc_id, and ``kept`` marks that document. A null or empty text and
    a row with a null doc_id link with nothing (class_id is the doc_id). Rows that share a doc_id are
    versions of one document. An empty table gives an empty result.

    Equal texts become one class before anything is compared. A bucket of texts with one sketch is never
    expanded into its pairs: all compare with one member, twice. Texts that then still share a bucket with
    texts of other groups go, whatever their number, through ``rare_buckets`` together with the short ones. It
    loses no pair at the threshold and leaves out the pairs that only share a passage. Of the pairs in one rare
    bucket only those are listed whose parities leave the threshold possible.
    """
    made = stage(sketch_table(docs, sketches, sampled), "sketches")
    classes = stage(made.groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"), F.min("sketches").alias("sketches")), "classes")
    copies = made.join(classes.select("h1", "h2", "n", "rep"), ["h1", "h2", "n"]).select("doc_id", "rep")
    copies = stage(copies.distinct(), "copies")
    firsts = copies.groupBy("doc_id").agg(F.min("rep").alias("rep"), F.max("rep").alias("last"))
    versions = copies.join(firsts.where("rep < last").select("doc_id", F.col("rep").alias("b")), "doc_id")
    versions = versions.select(F.col("rep").alias("a"), "b").where("a != b").distinct()

    texts = classes.select("rep", F.greatest(F.col("n") - (SHINGLE - 1), F.lit(1)).alias("n"), F.col("rep").alias("root"), "sketches")
    buckets = texts.select(F.explode("sketches").alias("bucket"), "rep", "n", "root", F.lit(True).alias("index"))
    several = _apart(buckets.groupBy("bucket").agg(*_members()).where("first < last"))
    left = stage(buckets.join(several, "bucket", "left_semi"), "buckets")
    wanted = left.select("rep").union(texts.where(F.col("n") <= SHORT).select("rep")).distinct()
    words = stage(_words_of(docs, wanted.withColumnRenamed("rep", "id")), "words")

    roots, tested = None, None

    def link(pairs: DataFrame) -> None:
        """Test the pairs that were not tested yet, and join the groups that the links found lie between."""
        nonlocal roots, tested
        pairs = _long_enough(pairs, threshold).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        tested = pairs if tested is None else tested.union(pairs)
        links = _verified(pairs, words, threshold)
        if roots is None:
            roots = stage(components(versions.union(links)), "roots").withColumnRenamed("node", "rep")
        else:
            roots = stage(_joined(roots, stage(links, "links")), "roots")

    def gathered(left: DataFrame) -> DataFrame:
        """Compare the members of each bucket with one of them; what then belongs to different groups stays."""
        for _ in range(HUB_ROUNDS):
            hubs = left.groupBy("bucket").agg(F.min(F.struct("rep", "root", "n")).alias("hub"))
            met = left.join(hubs, "bucket").where("rep != hub.rep")
            link(met.where("root != hub.root").select(F.col("hub.rep").alias("a"), F.col("rep").alias("b"), F.col("hub.n").alias("n_a"), F.col("n").alias("n_b")))
            left = stage(_mixed(met.drop("hub", "root").join(roots, "rep", "left")), "left")
        return left

    left = gathered(left).select("rep").union(texts.where(F.col("n") <= SHORT).select("rep")).distinct()
    left = texts.select("rep", "n").join(left, "rep", "left_semi").join(roots, "rep", "left")
    left = stage(left.select("rep", "n", F.coalesce("root", "rep").alias("root")), "open")
    rows = shingle_rows(words.join(left.select(F.col("rep").alias("id")), "id", "left_semi"))
    left = stage(_mixed(rare_buckets(rows, left, threshold)), "left")
    left = gathered(left)
    open_words = words.join(left.select(F.col("rep").alias("id")).distinct(), "id", "left_semi")
    left = stage(left.join(parity_table(open_words), "rep"), "left")
    # the shorter text by its index shingles, the other one by any; texts that reach the threshold differ in so few shingles
    other = left.select("bucket", F.col("rep").alias("b"), F.col("root").alias("root_b"), F.col("n").alias("n_b"), F.col("parities").alias("parities_b"))
    most = (F.col("n_a") + F.col("n_b")) * ((1 - threshold) / (1 + threshold)) + 1e-6
    pairs = left.where("index").withColumnsRenamed({"rep": "a", "n": "n_a"}).join(other, "bucket").where("root != root_b and n_a <= n_b and a != b")
    pairs = pairs.where(_apart_by("parities", "parities_b") <= most)
    link(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "n_a", "n_b"))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id")).join(firsts.select("doc_id", "rep"), "doc_id", "left").join(roots, "rep", "left")
    group = F.coalesce("root", "rep", "doc_id")
    return out.select("doc_id", group.alias("class_id"), F.coalesce(F.col("doc_id") == group, F.lit(True)).alias("kept"))


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """The groups ``rep, root`` after further links ``a, b``: only the groups that these lie between are compared."""
    between = links
    for c in ("a", "b"):
        own = roots.select(F.col("rep").alias(c), F.col("root").alias("_root"))
        between = between.join(own, c, "left").withColumn(c, F.coalesce("_root", c)).drop("_root")
    tops = stage(components(between), "tops").select(F.col("node").alias("rep"), F.col("root").alias("_top"))
    moved = roots.join(tops.withColumnRenamed("rep", "root"), "root", "left").select("rep", F.coalesce("_top", "root").alias("root"))
    return moved.union(tops.join(roots, "rep", "left_anti").select("rep", F.col("_top").alias("root")))


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows of buckets whose members belong to different groups.

    Of buckets with the same members one stays: shingles of one passage come together in all texts.
    """
    rows = rows.select("bucket", "rep", "n", F.coalesce("root", "rep").alias("root"), "index")
    sizes = rows.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), *_members())
    return rows.join(_apart(sizes.where("low < high")), "bucket", "left_semi")


def _members() -> list[Column]:
    """What tells sets of members apart: their number, the first, the last and two hashes over all."""
    marks = [F.bit_xor(F.xxhash64("rep", "index", F.lit(seed))).alias(name) for seed, name in enumerate(("mark", "mark_2"))]
    return [F.count("*").alias("members"), F.min("rep").alias("first"), F.max("rep").alias("last"), *marks]


def _apart(sizes: DataFrame) -> DataFrame:
    """``bucket`` of one bucket of each set of members."""
    return sizes.groupBy("members", "first", "last", "mark", "mark_2").agg(F.min("bucket").alias("bucket")).select("bucket")


def _long_enough(pairs: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose numbers of shingles allow the threshold."""
    return pairs.where(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * (threshold - 1e-9)).select("a", "b")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that stay: one row of each group of near-duplicates, with the columns of ``docs``.

    Rows with a null doc_id stay. Of several versions of the kept document, the first by text stays, a null
    text last.
    """
    kept = near_duplicates(docs, threshold).where("kept and doc_id is not null").select("doc_id").distinct()
    stays = docs.join(kept, "doc_id", "left_semi")
    # the join has dealt the rows by doc_id already, so this takes no further shuffle
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    first = stays.groupBy("doc_id").agg(F.min(F.struct(F.col("text").isNull().alias("_gone"), F.struct("text", *others).alias("_own"))).alias("_row"))
    first = first.select(*[F.col("doc_id") if c == "doc_id" else F.col("_row._own")[c].alias(c) for c in docs.columns])
    return first.union(docs.where("doc_id is null"))


def op6_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near-duplicates of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))
