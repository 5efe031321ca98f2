"""Token counts of a byte-pair vocabulary by heap-and-linked-list merging, without token ids."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import slices, table

LIMIT = 4096
#: Text handled at a time in a task; a longer text comes alone.
SLICE_BYTES = 8 << 20
#: Words whose counts a Python worker remembers, in each of two generations.
CACHED_WORDS = 400_000
#: What stands for a blank inside the vocabulary (fixed value).
BLANK = "▁"
#: Position bits of a heap entry, below its rank.
PLACE_BITS = 40
PLACE = (1 << PLACE_BITS) - 1


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PairMerger:
    """Counts tokens with the ranks of a sentencepiece byte-pair model.

    Blanks become ``BLANK`` and one is put before a text that is not empty; nothing else is normalized. A
    character outside the vocabulary counts as its UTF-8 bytes and never merges. No piece has a blank after
    another character, so no token spans the start of a run of blanks and a text's count is the sum over
    its units: a run of blanks and what follows it, cut at line feeds, which are in no piece either.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        apart = (model.is_control, model.is_unknown, model.is_byte)
        plain = [i for i in range(len(model)) if not any(f(i) for f in apart)]
        score = {model.id_to_piece(i): model.get_score(i) for i in plain}
        order = {s: n for n, s in enumerate(sorted(set(score.values()), reverse=True))}
        self.rank = {piece: order[s] << PLACE_BITS for piece, s in score.items() if len(piece) > 1}
        self.single = {piece for piece in score if len(piece) == 1}
        self.neighbours = {piece[i : i + 2] for piece in self.rank for i in range(len(piece) - 1)}
        fits = (
            model.normalize(" A ﬁ  b ") == f"{BLANK}{BLANK}A{BLANK}ﬁ{BLANK}{BLANK}b{BLANK}"
            and all(BLANK not in piece.lstrip(BLANK) for piece in score)
            and all(c in self.single for piece in score for c in piece)
            and BLANK in self.single
            and "\n" not in self.single
            and any(model.is_byte(i) for i in range(len(model)))
            and not any(model.is_unused(i) for i in plain)
        )
        if not fits:
            raise ValueError("the model does not keep texts as they are, or has other than byte-pair pieces with byte fallback")
        self.recent: dict[str, int] = {}
        self.older: dict[str, int] = {}

    def merged(self, unit: str) -> int:
        """Tokens of a unit: its first symbols less the merges of their lowest-ranked pairs, leftmost first among equals."""
        rank, symbols, n = self.rank.get, list(unit), len(unit)
        count = n if self.single.issuperset(unit) else sum(1 if c in self.single else len(c.encode()) for c in unit)
        pairs = [rank(a + b) for a, b in zip(symbols, symbols[1:])]  # of each symbol with the next one
        heap = [r | i for i, r in enumerate(pairs) if r is not None]
        if not heap:
            return count
        pairs.append(None)
        symbols.append("")
        following, before = list(range(1, n + 1)), list(range(-1, n))
        heapq.heapify(heap)
        while heap:
            top = heapq.heappop(heap)
            i = top & PLACE
            if pairs[i] != top - i:  # one of the two has been merged since
                continue
            count -= 1
            j = following[i]
            k = following[i] = following[j]
            before[k] = i
            pair = symbols[i] = symbols[i] + symbols[j]
            pairs[j] = None
            r = pairs[i] = rank(pair + symbols[k]) if k < n else None
            if r is not None:
                heapq.heappush(heap, r | i)
            h = before[i]
            if h >= 0:
                r = pairs[h] = rank(symbols[h] + pair)
                if r is not None:
                    heapq.heappush(heap, r | h)
        return count

    def tokens(self, unit: str) -> int:
        """The same from memory, where the unit was met before.

        No token spans two characters that are neighbours in no piece; a last character that is so apart,
        mostly a full stop or comma, is counted by itself, and the rest is met more often.
        """
        found = self.recent.get(unit)
        if found is None:
            found = self.older.get(unit)
            if found is None:
                apart = len(unit) > 1 and unit[-2:] not in self.neighbours
                found = self.tokens(unit[:-1]) + self.merged(unit[-1]) if apart and len(unit) <= 64 else self.merged(unit)
            if len(unit) <= 64:
                if len(self.recent) >= CACHED_WORDS:
                    self.older, self.recent = self.recent, {}
                self.recent[unit] = found
        return found

    def _word(self, word: str) -> int:
        """Tokens of a word and the blank before it, or of a line feed and what follows it."""
        return 1 + self.tokens(word[1:]) if word.startswith("\n") else self.tokens(BLANK + word)

    def _spaced(self, text: str) -> int:
        """Tokens of a text with runs of blanks."""
        return sum(self.tokens(unit) for unit in re.findall(f"{BLANK}*[^{BLANK}]+|{BLANK}+", (BLANK + text).replace(" ", BLANK)))

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; 0 for a null or empty one."""
        texts = texts.fill_null("").cast(pa.large_string())
        spaced = pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, BLANK))
        spaced = np.asarray(pc.or_(spaced, pc.starts_with(texts, " ")))
        blank = np.asarray(pc.binary_length(texts)) == 0
        plain = texts.filter(pa.array(~spaced & ~blank))
        # one blank before every word but the first; a line feed starts a word of its own
        split = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
        coded = split.flatten().dictionary_encode()
        each = np.fromiter(map(self._word, coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
        total = np.append(0, np.cumsum(each[np.asarray(coded.indices)]))
        ends = np.asarray(split.offsets)
        out = np.zeros(len(texts), np.int64)
        out[~spaced & ~blank] = total[ends[1:] - ends[0]] - total[ends[:-1] - ends[0]]
        if spaced.any():
            out[spaced] = [self._spaced(x) for x in texts.filter(pa.array(spaced)).to_pylist()]
        return out


def _merger(path: str, cache: dict = {}) -> PairMerger:  # noqa: B006  one for each Python worker
    if path not in cache:
        cache[path] = PairMerger(path)
    return cache[path]


def token_counts(
    docs: DataFrame, model: str | None = None, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row, repeated rows included.

    ``model`` is the path of a sentencepiece byte-pair model with byte fallback, the same on all executors;
    one that rewrites texts is refused. Whole texts are counted, without begin or end tokens; special
    strings inside a text are plain text. A null text counts as empty, with 0 bytes and tokens; a null id
    stays null; other columns are not read. An empty table gives an empty result. Rows are counted where
    they are read, without a shuffle.
    """
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = _merger(path)
        for batch in batches:
            for rows in slices(batch, "text", SLICE_BYTES):
                found = pa.array(merger.counts(rows.column("text")))
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), rows.column("n_bytes"), found], names=["doc_id", "n_bytes", "n_tokens"])

    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), size.alias("n_bytes"), F.col(text).alias("text"))
    counted = rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents by the 32k piece vocabulary, and which exceed 4096 tokens."""
    return token_counts(table(spark, sf_dir, "documents"))
