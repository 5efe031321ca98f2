"""Quality and toxicity by document evidence and hierarchical empirical Bayes over hosts and paths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm.common import stage, table

#: Hashed word features; together with the style features they bound the model, not the documents.
BINS = 1 << 18
#: Rows whose features are computed together.
ROWS_AT_ONCE = 2000
#: Pseudo-documents behind each feature: a word seen in few labelled documents carries little evidence.
PRIOR = 10.0
#: The classifier is fitted on about this many labelled rows, chosen by a hash of doc_id; fewer are all used.
#: The sample's ids and labels are what a task gets of them, so the texts need no shuffle.
SAMPLE_DOCS = 60_000
TARGETS = ("quality", "toxic")
#: A host's or path's prior is worth between these numbers of documents.
STRENGTH = (1.0, 1000.0)


def _style(texts: list[str], words: np.ndarray, distinct: np.ndarray) -> np.ndarray:
    """Style features of each text, as one of four grades each: capitals, marks, repetition, word count."""
    out = np.zeros((len(texts), 4), np.int64)
    for i, x in enumerate(texts):
        n = max(len(x), 1)
        capitals = sum(map(x.count, "AEIOUNST")) / max(sum(map(x.lower().count, "aeiounst")), 1)
        marks = sum(map(x.count, "!|#*_=<>{}")) / n
        out[i] = (
            np.searchsorted([0.1, 0.3, 0.7], capitals),
            np.searchsorted([0.005, 0.02, 0.05], marks),
            np.searchsorted([0.2, 0.4, 0.7], distinct[i] / max(words[i], 1)),
            np.searchsorted([5, 20, 200], words[i]),
        )
    return out * 1 + np.arange(4) * 4


def _features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct features of each text: row number and bin, sorted by row. Words are lower case letters and digits."""
    strings = texts.fill_null("").cast(pa.large_string())
    split = pc.ascii_split_whitespace(pc.utf8_lower(strings))
    coded = pc.utf8_trim(split.flatten(), ".,;:!?|\"'()[]").dictionary_encode()
    bins = np.fromiter((zlib.crc32(x.encode()) % BINS for x in coded.dictionary.to_pylist()), np.int64, len(coded.dictionary))
    ends = np.asarray(split.offsets)
    words = np.diff(ends)
    row = np.repeat(np.arange(len(texts)), words)
    pair = np.unique(row * (BINS + 16) + bins[np.asarray(coded.indices)]) if len(row) else np.empty(0, np.int64)
    distinct = np.bincount(pair // (BINS + 16), minlength=len(texts))
    style = _style(strings.to_pylist(), words, distinct) + BINS
    pair = np.sort(np.concatenate([pair, (np.arange(len(texts))[:, None] * (BINS + 16) + style).ravel()]))
    return pair // (BINS + 16), pair % (BINS + 16)


@dataclass
class Evidence:
    """Log likelihood ratios of each feature for each target, and the calibrated line from mean to log odds."""

    weights: np.ndarray
    slope: np.ndarray
    shift: np.ndarray
    base: np.ndarray

    def raw(self, texts: pa.Array) -> np.ndarray:
        """Two numbers per target: summed strongest evidence and mean evidence."""
        row, bins = _features(texts)
        n = np.maximum(np.bincount(row, minlength=len(texts)), 1)
        out = []
        for k in range(len(TARGETS)):
            w = self.weights[k][bins]
            strong = np.where(np.abs(w) > 1.5, w, 0)
            out.append(np.stack([np.bincount(row, strong, len(texts)).clip(-60, 60), np.bincount(row, w, len(texts)) / n], 1))
        return np.stack(out, 1)

    def log_ratio(self, texts: pa.Array) -> np.ndarray:
        """Log likelihood ratio per target: calibrated log odds less the log odds of the labelled base rate."""
        raw = self.raw(texts)
        return (np.einsum("nkf,kf->nk", raw, self.slope) + self.shift - self.base).clip(-12, 12)


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 30) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by Newton steps."""
    scale = np.maximum(np.abs(x).max(0), 1e-9)
    a = np.column_stack([x / scale, np.ones(len(x))])
    beta = np.zeros(a.shape[1])
    ridge = np.diag([1e-2] * x.shape[1] + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(a @ beta).clip(-30, 30)))
        step = np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + ridge, a.T @ (y - p) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta[:-1] / scale, float(beta[-1])


def label_sample(labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """About ``sample_docs`` labelled doc_ids with their labels; repeated labels of one id become the larger."""
    rows = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    rows = rows.agg(*[F.max(F.col(t).cast("int")).alias(t) for t in TARGETS])
    share = min(1.0, sample_docs / max(rows.count(), 1))
    return rows.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < int(share * 1_000_000))


def fit_evidence(labelled: DataFrame) -> Evidence:
    """Fit on ``text, quality, toxic``; rows with null labels are left out of that target.

    Counts of documents by feature and class are grouped sums over a fixed number of bins. A fifth of the
    texts is kept from the counts and fits the evidence's scale; of these four numbers a row reach the
    driver, so ``labelled`` should be a bounded sample.
    """
    rows = labelled.select("text", *[F.col(t).cast("int") for t in TARGETS])
    draw = F.pmod(F.xxhash64("text", F.lit(3)), F.lit(5))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2 * len(TARGETS), BINS + 16), np.int64)
        totals = np.zeros(2 * len(TARGETS), np.int64)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                row, bins = _features(batch.column(0))
                for k in range(len(TARGETS)):
                    y = np.array([-1 if v is None else v for v in batch.column(1 + k).to_pylist()])
                    for c in (0, 1):
                        sums[2 * k + c] += np.bincount(bins[y[row] == c], minlength=BINS + 16)
                        totals[2 * k + c] += (y == c).sum()
        used = np.flatnonzero(sums.any(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, -1)), *(pa.array(np.append(s[used], n)) for s, n in zip(sums, totals, strict=True))],
            names=["bin", "q0", "q1", "t0", "t1"],
        )

    counts = rows.where(draw != 0).mapInArrow(count, "bin long, q0 long, q1 long, t0 long, t1 long")
    got = counts.groupBy("bin").agg(*[F.sum(c).alias(c) for c in ("q0", "q1", "t0", "t1")]).toArrow().to_pandas().set_index("bin")
    weights = np.zeros((len(TARGETS), BINS + 16))
    total = got.loc[-1] if -1 in got.index else {c: 0 for c in ("q0", "q1", "t0", "t1")}
    got = got.drop(index=-1, errors="ignore")
    for k, (no, yes) in enumerate((("q0", "q1"), ("t0", "t1"))):
        share = total[yes] / max(total[no] + total[yes], 1)
        up = (got[yes] + PRIOR * share) / (total[yes] + PRIOR)
        down = (got[no] + PRIOR * (1 - share)) / (total[no] + PRIOR)
        if total[no] and total[yes]:
            weights[k, got.index] = np.log(up / down)
    model = Evidence(weights, np.zeros((len(TARGETS), 2)), np.zeros(len(TARGETS)), np.zeros(len(TARGETS)))
    spare = rows.where(draw == 0)
    bc = rows.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                raw = bc.value.raw(batch.column(0))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(raw[:, k, f]) for k in range(2) for f in range(2)] + [batch.column(1), batch.column(2)],
                    names=["q_sum", "q_mean", "t_sum", "t_mean", "quality", "toxic"],
                )

    seen = spare.mapInArrow(measure, "q_sum double, q_mean double, t_sum double, t_mean double, quality int, toxic int").toArrow().to_pandas()
    for k, (a, b) in enumerate((("q_sum", "q_mean"), ("t_sum", "t_mean"))):
        known = seen[seen[TARGETS[k]].notna()]
        y = known[TARGETS[k]].to_numpy(float)
        if len(set(y)) == 2:
            model.slope[k], model.shift[k] = _logistic(known[[a, b]].to_numpy(), y)
            rate = y.mean()
            model.base[k] = np.log(rate / (1 - rate))
    return model


def evidence(docs: DataFrame, model: Evidence) -> DataFrame:
    """``doc_id, host, path`` and the log likelihood ratio of each target for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(at, ROWS_AT_ONCE)
                ratio = shared.value.log_ratio(batch.column(3))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], *(pa.array(ratio[:, k]) for k in range(len(TARGETS)))],
                    names=["doc_id", "host", "path", *TARGETS],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("host").cast("string"), F.col("path").cast("string"), "text")
    return rows.mapInArrow(run, "doc_id long, host string, path string, quality double, toxic double")


def _logit(p: Column) -> Column:
    q = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(q / (1 - q))


def _strength(mean: Column, between: Column, count: Column) -> Column:
    """Pseudo-documents of a prior, by moments: m (1 - m) over the variance of the groups' rates, less one.

    The observed variance holds sampling noise m (1 - m) / n, which is taken off first.
    """
    noise = mean * (1 - mean) / F.greatest(count, F.lit(1.0))
    true = F.greatest(between - noise, F.lit(1e-9))
    return F.greatest(F.lit(STRENGTH[0]), F.least(F.lit(STRENGTH[1]), mean * (1 - mean) / true - 1))


def shrunken_rates(rows: DataFrame, target: str) -> DataFrame:
    """Posterior rate of ``target`` for each host and path: ``host, path, rate``.

    ``rows`` has ``host, path`` and the documents' expected membership in ``target`` under the global rate.
    A host's posterior is its mean shrunk towards the global mean, a path's is its mean shrunk towards its
    host's posterior, each by a strength estimated from the spread of the groups' means. Sums per path
    are aggregated map-side, so a host with a third of all rows is a few rows per task.
    """
    paths = rows.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum(target).alias("s"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    per_host = F.col("host_s") / F.col("host_n")
    world = hosts.agg(
        (F.sum("host_s") / F.sum("host_n")).alias("world"),
        F.coalesce(F.var_samp(per_host), F.lit(0.0)).alias("host_var"),
        (F.count("*") / F.sum(1 / F.col("host_n"))).alias("host_size"),
    )
    m = F.col("world")
    k = _strength(m, F.col("host_var"), F.col("host_size"))
    hosts = hosts.join(F.broadcast(world)).withColumn("host_rate", (F.col("host_s") + k * m) / (F.col("host_n") + k))
    joined = paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).drop(hosts["host"])
    inside = joined.agg(
        F.coalesce(F.avg(F.pow(F.col("s") / F.col("n") - F.col("host_rate"), 2)), F.lit(0.0)).alias("path_var"),
        (F.count("*") / F.sum(1 / F.col("n"))).alias("path_size"),
    )
    h = F.col("host_rate")
    kp = _strength(h, F.col("path_var"), F.col("path_size"))
    return joined.join(F.broadcast(inside)).select("host", "path", ((F.col("s") + kp * h) / (F.col("n") + kp)).alias("rate"))


def assess(docs: DataFrame, model: Evidence, keep_quality: float = 0.5, drop_toxic: float = 0.5) -> DataFrame:
    """A row per row of ``docs`` (``doc_id, host, path, text``): posteriors and the decision.

    Returns ``doc_id, quality, toxic, kept``: a document's posterior log odds are those of its path's
    posterior rate plus its own evidence. ``kept``: quality at least ``keep_quality`` and toxic below
    ``drop_toxic``. Null hosts and paths are groups of their own; a null or empty text is judged by its
    style features and its path. Repeated rows are judged alike. An empty table gives an empty result.
    """
    seen = stage(evidence(docs, model), "evidence")
    expected = seen.select("host", "path", *[(1 / (1 + F.exp(-(F.col(t) + F.lit(float(model.base[k])))))).alias(t) for k, t in enumerate(TARGETS)])
    rates = None
    for t in TARGETS:
        own = shrunken_rates(expected, t).withColumnRenamed("rate", f"{t}_rate")
        own = own.withColumnsRenamed({"host": f"{t}_host", "path": f"{t}_path"})
        if rates is None:
            rates = own
        else:
            rates = rates.join(own, F.equal_null("quality_host", f"{t}_host") & F.equal_null("quality_path", f"{t}_path"))
    rates = rates.select(F.col("quality_host").alias("_host"), F.col("quality_path").alias("_path"), "quality_rate", "toxic_rate")
    got = seen.join(rates, F.equal_null("host", "_host") & F.equal_null("path", "_path"))
    post = {t: 1 / (1 + F.exp(-(_logit(F.col(f"{t}_rate")) + F.col(t)))) for t in TARGETS}
    out = got.select("doc_id", post["quality"].alias("quality"), post["toxic"].alias("toxic"))
    return out.withColumn("kept", (F.col("quality") >= keep_quality) & (F.col("toxic") < drop_toxic))


def with_host(docs: DataFrame) -> DataFrame:
    """Documents with a source as host and its language section as path."""
    return docs.select("doc_id", F.col("source").alias("host"), F.concat_ws("/", "source", "lang").alias("path"), "text")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posterior quality and toxicity of every document, learned from the labels."""
    docs = table(spark, sf_dir, "documents")
    sample = F.broadcast(label_sample(table(spark, sf_dir, "labels")))  # at most about SAMPLE_DOCS rows
    model = fit_evidence(docs.select("doc_id", "text").join(sample, "doc_id").where("text is not null"))
    return assess(with_host(docs), model)
