"""Language identification with interpolated Kneser-Ney character models."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import table

#: Characters in an n-gram. Four 16-bit symbols make one 64-bit key.
ORDER = 4
#: The models are fitted on about this many labelled documents of each language, chosen by a hash of the
#: text; languages with fewer give all. This bounds the models, whatever the input's size.
SAMPLE_DOCS = 3000
#: Every tenth of them is left out of the counts and calibrates score and rejection.
CALIBRATION = 10
#: Texts scored together, in characters; a worker's memory is about 100 bytes for each.
CHARS_AT_ONCE = 1_000_000
#: The same for the calibration texts, which the driver scores beside all else that it holds.
CALIBRATED_AT_ONCE = 50_000
UNKNOWN = "und"
#: Short texts vary more: the rejection limit is wider by this over the root of the number of symbols.
SHORT_SLACK = 8.0
START, SPACE, ASTRAL = 1, 32, 0xFFFF
#: Odd 64-bit multiplier that spreads keys over the hash range.
MIX = np.uint64(0x9E3779B97F4A7C15)


@cache
def _symbols() -> np.ndarray:
    """Symbol of each UTF-16 unit: lower-case letter, START for the separator, else SPACE."""
    out = np.full(0x10000, SPACE, np.uint16)
    for c in range(0x10000):
        x = chr(c)
        if not 0xD800 <= c < 0xE000 and unicodedata.category(x)[0] == "L":
            low = x.lower()
            out[c] = ord(low) if len(low) == 1 else c
    out[0] = START
    return out


def has_letter(text: str) -> bool:
    return any(unicodedata.category(x)[0] == "L" for x in text)


def _stream(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts as symbols, each after ORDER - 1 starts, runs of non-letters as one space; index of text."""
    pad = "\0" * (ORDER - 1)
    raw = (pad + pad.join(x.replace("\0", " ") for x in texts)).encode("utf-16-le", "surrogatepass")
    units = np.frombuffer(raw, np.uint16)
    got = _symbols()[units]
    high = (units >= 0xD800) & (units < 0xDC00)
    if high.any():  # letters outside the basic plane are one symbol
        low = np.flatnonzero(high)
        points = 0x10000 + ((units[low].astype(np.int64) - 0xD800) << 10) + (units[np.minimum(low + 1, len(units) - 1)].astype(np.int64) & 0x3FF)
        got[low[[unicodedata.category(chr(min(p, 0x10FFFF)))[0] == "L" for p in points]]] = ASTRAL
    keep = np.ones(len(got), bool)
    keep[1:] = (got[1:] != SPACE) | (got[:-1] != SPACE)
    got = got[keep]
    text = np.cumsum((got == START)) // (ORDER - 1) - 1
    return got, text


def _grams(symbols: np.ndarray) -> np.ndarray:
    """Key of the n-gram that ends at each symbol: four symbols, the newest in the low bits."""
    x = symbols.astype(np.uint64)
    key = x.copy()
    for back in range(1, ORDER):
        key[back:] |= x[:-back] << np.uint64(16 * back)
    return key


def _low(keys: np.ndarray, n: int) -> np.ndarray:
    return keys if n == 4 else keys & np.uint64((1 << 16 * n) - 1)


@dataclass
class HashTable:
    """Rows found by the hash of a 64-bit key: sorted hashes, with an index by their leading bits."""

    keys: np.ndarray
    rows: np.ndarray
    bits: int = field(init=False)

    def __post_init__(self) -> None:
        hashes = self.keys * MIX
        order = np.argsort(hashes, kind="stable")
        self.keys, self.rows = hashes[order], self.rows[order]  # the multiplier is odd: hashes are as unique as keys
        self.bits = max(1, int(len(order)).bit_length())
        self.first = np.searchsorted(self.keys >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1, dtype=np.uint64))
        self.steps = int(np.diff(self.first).max(initial=0))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row number of each key, -1 where it is not there."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.keys):
            return out
        hashes = keys * MIX
        at = self.first[hashes >> np.uint64(64 - self.bits)]
        todo = np.arange(len(keys))
        for _ in range(self.steps):
            here = self.keys[np.minimum(at, len(self.keys) - 1)]
            hit = here == hashes
            out[todo[hit]] = at[hit]
            more = here < hashes
            todo, at, hashes = todo[more], at[more] + 1, hashes[more]
            if not len(todo):
                break
        return out


@dataclass
class _Counts:
    """One language's counts of one order: sorted keys with discounted shares and the contexts' rest."""

    keys: np.ndarray
    share: np.ndarray
    contexts: np.ndarray
    rest: np.ndarray


def _fit(keys: np.ndarray, counts: np.ndarray, n: int) -> _Counts:
    """Absolute discounting of one order: share = max(c - D, 0) / C(h), rest = D N(h) / C(h)."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order].astype(float)
    ones, twos = (counts == 1).sum(), (counts == 2).sum()
    discount = float(np.clip(ones / max(ones + 2 * twos, 1), 0.1, 0.95))
    contexts, at, types = np.unique(keys >> np.uint64(16), return_inverse=True, return_counts=True)
    total = np.bincount(at, counts, len(contexts))
    return _Counts(keys, np.maximum(counts - discount, 0) / total[at], contexts, discount * types / total)


def _lookup(sorted_keys: np.ndarray, values: np.ndarray, keys: np.ndarray, default: float) -> np.ndarray:
    if not len(sorted_keys):
        return np.full(len(keys), default)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, values[at], default)


class Model:
    """Interpolated Kneser-Ney models of all languages over one set of n-grams.

    The highest order uses counts, the lower ones the number of distinct symbols seen before the n-gram.
    ``tables[n]`` has a row of log probabilities, one per language, for each n-gram that any language has,
    and ``rests[n]`` the log backoff weights of contexts; both are sorted hash arrays.
    """

    def __init__(self, languages: list[str], keys: dict[str, np.ndarray], counts: dict[str, np.ndarray]):
        self.languages = sorted(languages)
        by: dict[str, dict[int, _Counts]] = {}
        union: dict[int, list[np.ndarray]] = {n: [] for n in range(1, ORDER + 1)}
        for lang in self.languages:
            own, c = keys[lang], counts[lang]
            by[lang] = {}
            for n in range(ORDER, 0, -1):
                by[lang][n] = _fit(own, c, n)
                union[n].append(own)
                own, c = np.unique(_low(own, n - 1), return_counts=True) if n > 1 else (own, c)
        symbols = np.unique(np.concatenate(union[1])) if union[1] else np.empty(0)
        self.floor = -np.log(len(symbols) + 1.0)
        self.tables, self.rests = {}, {}
        for n in range(1, ORDER + 1):
            every = np.unique(np.concatenate(union[n])) if self.languages else np.empty(0, np.uint64)
            logp = np.stack([np.log(self._p(by[x], n, every)) for x in self.languages], 1) if self.languages else np.empty((0, 0))
            self.tables[n] = HashTable(every, logp.astype(np.float32))
            heads = np.unique(every >> np.uint64(16))
            rest = [np.log(_lookup(by[x][n].contexts, by[x][n].rest, heads, 1.0)) for x in self.languages]
            self.rests[n] = HashTable(heads, np.stack(rest, 1).astype(np.float32) if rest else np.empty((0, 0)))
        self.temperature, self.limits = 1.0, np.full(len(self.languages), np.inf)

    def _p(self, orders: dict[int, _Counts], n: int, keys: np.ndarray) -> np.ndarray:
        if n == 0:
            return np.full(len(keys), np.exp(self.floor))
        own = orders[n]
        share = _lookup(own.keys, own.share, keys, 0.0)
        rest = _lookup(own.contexts, own.rest, keys >> np.uint64(16), 1.0)
        return share + rest * self._p(orders, n - 1, _low(keys, n - 1))

    def _log_p(self, keys: np.ndarray, n: int = ORDER) -> np.ndarray:
        if n == 0:
            return np.full((len(keys), len(self.languages)), self.floor, np.float32)
        at = self.tables[n].find(keys)
        out = self.tables[n].rows[at] if len(self.tables[n].rows) else np.zeros((len(keys), len(self.languages)), np.float32)
        if len(lost := np.flatnonzero(at < 0)):
            rest = self.rests[n].find(keys[lost] >> np.uint64(16))
            backed = self._log_p(_low(keys[lost], n - 1), n - 1)
            if len(self.rests[n].rows):
                backed = backed + np.where(rest[:, None] >= 0, self.rests[n].rows[rest], 0)
            out[lost] = backed
        return out

    def cross_entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Mean loss of each text under each language, in nats per symbol, and the number of symbols."""
        symbols, text = _stream(texts)
        scored = np.flatnonzero(symbols != START)
        loss = -self._log_p(_grams(symbols)[scored])
        own = text[scored]
        n = np.bincount(own, minlength=len(texts))
        sums = np.stack([np.bincount(own, loss[:, k], len(texts)) for k in range(len(self.languages))], 1)
        return sums / np.maximum(n, 1)[:, None], n

    def calibrate(self, texts: list[str], truth: list[str]) -> None:
        """Fit score and rejection on labelled texts that the counts have not seen.

        The score is a softmax of the languages' cross-entropies at the temperature with the least log
        loss. A language's limit is far outside the cross-entropies of its own calibration texts: their
        highest plus twice their spread.
        """
        if not texts or not self.languages:
            return
        parts = [self.cross_entropy(texts[a:b]) for a, b in _groups(list(map(len, texts)), CALIBRATED_AT_ONCE)]
        h, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        y = np.array([self.languages.index(x) for x in truth])
        used = n > 0
        h, y = h[used], y[used]
        if not len(y):
            return
        grid = 2.0 ** np.arange(-2, 8)
        losses = [-np.log(np.maximum(_softmax(-h * t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
        self.temperature = float(grid[int(np.argmin(losses))])
        for k in range(len(self.languages)):
            own = h[y == k, k]
            if len(own) >= 5:
                self.limits[k] = own.max() + 2 * own.std()

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether the text is rejected, for each text."""
        letters = [x is not None and has_letter(x) for x in texts]
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        h, n = self.cross_entropy([x if ok else "" for x, ok in zip(texts, letters, strict=True)])
        best = h.argmin(1) if len(texts) else np.empty(0, int)
        p = _softmax(-h * self.temperature)[np.arange(len(best)), best]
        limit = self.limits[best] + SHORT_SLACK / np.sqrt(np.maximum(n, 1))
        over = np.maximum(h[np.arange(len(best)), best] - limit, 0)
        none = ~np.array(letters, bool)
        score = np.where(none, 0.0, p * np.exp(-over))
        names = [UNKNOWN if no else self.languages[b] for no, b in zip(none, best, strict=True)]
        return names, score, none | (over > 0)


def _softmax(x: np.ndarray) -> np.ndarray:
    if not x.size:
        return x
    e = np.exp(x - x.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def _groups(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes add up to about ``most``; one larger row is a range of its own."""
    start, total = 0, 0
    for k, x in enumerate(sizes):
        if k > start and total + x > most:
            yield start, k
            start, total = k, 0
        total += x
    if start < len(sizes):
        yield start, len(sizes)


def train(labelled: DataFrame, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit the models on ``text, lang``; rows with a null or letterless text or a null lang are left out.

    About ``sample_docs`` documents of each language are used. Spark counts their n-grams; what reaches
    the driver is one row per distinct n-gram of the sample and the calibration texts, a tenth of it.
    """
    rows = labelled.where("text is not null and lang is not null").select("text", "lang")
    sizes = {r["lang"]: r["n"] for r in labelled.where("lang is not null").groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Model([], {}, {})
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in sorted(sizes.items()) for x in (k, min(1.0, sample_docs / n))]), F.col("lang"))
    draw = F.xxhash64("text", F.lit(11))
    rows = rows.where(F.pmod(draw, F.lit(1_000_000)) < share * 1_000_000)
    spare = F.pmod(F.shiftright(draw, 24), F.lit(CALIBRATION)) == 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist(), object)
            for start, end in _groups(list(map(len, texts)), CHARS_AT_ONCE):
                symbols, text = _stream(texts[start:end])
                keys, scored = _grams(symbols), symbols != START
                for lang in sorted(set(langs[start:end])):
                    own = scored & (langs[start:end] == lang)[np.clip(text, 0, None)]
                    grams, n = np.unique(keys[own], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(n.astype(np.int64))],
                        names=["lang", "gram", "n"],
                    )

    grams = rows.where(~spare).mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    got = grams.toArrow().to_pandas()
    by = {lang: x for lang, x in got.groupby("lang")}
    keys = {lang: x["gram"].to_numpy().view(np.uint64) for lang, x in by.items()}
    model = Model(list(by), keys, {lang: x["n"].to_numpy() for lang, x in by.items()})
    known = rows.where(spare).toArrow().to_pylist()
    model.calibrate([r["text"] for r in known if r["lang"] in by], [r["lang"] for r in known if r["lang"] in by])
    return model


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """The columns of ``docs`` with ``lang_pred, lang_score, lang_rejected``; only ``text`` is looked at.

    Whole texts are scored. A null text or one without a letter is ``und`` with score 0 and rejected. A
    text is also rejected if its cross-entropy lies beyond the calibrated limit of the nearest language.
    Equal cross-entropies go to the language first in code point order. Repeated rows get equal answers;
    input columns with the names of new ones are replaced.
    """
    new = "lang_pred string, lang_score double, lang_rejected boolean"
    names = ["lang_pred", "lang_score", "lang_rejected"]
    base = docs.drop(*names)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = base.columns
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema] + [new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(kept.index("text")).to_pylist()
            for start, end in _groups([len(x or "") for x in texts], CHARS_AT_ONCE):
                lang, score, rejected = shared.value.predict(texts[start:end])
                part = batch.slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], names=[*kept, *names]
                )

    return base.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document belongs to the fold that is kept from training."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out(F.col("doc_id"))))
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
