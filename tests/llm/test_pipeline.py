import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tallyline.llm import mixing, neardup, packing
from tests.llm.test_models import text_in
from tests.llm.test_neardup import edited, hashes
from tests.llm.test_removal import brute


@pytest.fixture(scope="module")
def steps(spark, documents, tmp_path_factory):
    """Input rows and the rows after each stage, stored and read back."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(100 + i, text_in("aa" if i % 2 else "bb", i, 10 + i % 50), "aa" if i % 2 else "bb", f"s{i % 4}") for i in range(150)]
    passage = text_in("aa", 999, 40)
    rows += [(300 + i, f"{text_in('aa', 1000 + i, 30)} {passage} {text_in('aa', 2000 + i, 30)}", "aa", "s1") for i in range(5)]
    rows += [(400 + i, " ".join(edited(rows[49][1].split(), i, 1)), None, "s0") for i in range(6)]
    rows += [(501, "12 34 !", "aa", "s2"), (600, None, None, "s3"), (601, "", "aa", None), (602, "same same", None, None)]
    documents(rows).write.parquet(f"{folder}/documents.parquet")
    out, docs = [rows], spark.read.parquet(f"{folder}/documents.parquet")
    for k, (_, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, docs, folder).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append(docs)
    return folder, out


def rows_of(df):
    return [(r.doc_id, r.text, r.lang, r.source) for r in df.collect()]


def test_names_and_columns(steps):
    _, (rows, *kept) = steps
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "minhash_near_dedup", "suffix_array_dedup", "source_mixing", "best_fit_packing"]
    assert all(k.columns == kept[0].columns for k in kept[:-1])


def test_language_stage_drops_what_is_no_language(steps):
    _, (rows, first, *_) = steps
    gone = {r[0] for r in rows} - {r[0] for r in rows_of(first)}
    assert {501, 600, 601} <= gone and not any(100 <= i < 500 for i in gone)
    assert all(r[2] for r in rows_of(first))


def test_near_dedup_stage_equals_brute_force(steps):
    _, (_, before, after, *_) = steps
    rows = rows_of(before)
    root = {r[0]: r[0] for r in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    x = {r[0]: hashes(r[1].split()) for r in rows}
    for a in sorted(x):
        for b in sorted(x):
            if a < b and neardup.aligned(x[a], x[b]) >= 0.8:
                i, j = sorted((find(a), find(b)))
                root[j] = i
    assert sorted(r[0] for r in rows_of(after)) == sorted({find(i) for i in root})


def test_byte_stage_equals_brute_force(steps):
    _, (_, _, before, after, *_) = steps
    rows = rows_of(before)
    want = {}
    for r, (u, gone) in zip(rows, brute(rows, lambda t: list(t.encode()), 50), strict=True):
        text = bytes(b for b, g in zip(u, gone, strict=True) if not g).decode("utf-8", "ignore")
        if text.strip() or not any(gone):
            want[r[0]] = text
    assert {r[0]: r[1] for r in rows_of(after)} == want
    assert sum(map(len, want.values())) < sum(len(r[1]) for r in rows)


def test_mixing_stage_holds_every_target(spark, steps):
    _, (_, _, _, before, after, _) = steps
    size = mixing.sized_documents(before)
    target = {r.source: r.target for r in mixing.source_targets(size.select("source", "size")).collect()}
    got = dict.fromkeys(target, 0)
    for r in rows_of(after):
        got[r[3]] += len(r[1].split())
    assert all(abs(got[s] - target[s]) <= 0.5 for s in target)


def test_packing_stage_holds_every_token(steps):
    folder, (*_, before, after) = steps
    want, encoder = [], packing.WordEncoder(packing.default_tokenizer())
    for r in rows_of(before):
        flat, _ = encoder.encode(pa.array([r[1]]))
        want.append((r[0], [*flat.tolist(), 0]))
    got = {}
    for r in after.collect():
        got.setdefault(r.doc_id, []).extend(packing.ids_of(bytes(r.ids)))
    total = {}
    for doc_id, ids in want:
        total.setdefault(doc_id, []).extend(ids)
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in total.items()}
    sums = np.array([r.n for r in after.groupBy("sequence_id").agg({"length": "sum"}).toDF("s", "n").collect()])
    assert (sums <= 2048).all() and len(sums) <= -(-sums.sum() // 2048) + 1


def test_run_is_the_stages_and_repeats(spark, steps):
    folder, (*_, last) = steps
    names = ["doc_id", "piece", "start", "length", "ids"]
    once = sorted(map(str, corpus_pipeline.run(spark, folder).select(*names).collect()))
    assert once == sorted(map(str, last.select(*names).collect()))


def test_no_documents(spark, documents, tmp_path):
    documents([]).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
