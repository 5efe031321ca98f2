"""Language ID, quality and language-model scoring."""

import collections
import copy
import math
import random

import numpy as np
import pytest
import xxhash

from tallyline.llm import langid, lmscore, quality
from tests.llm.conftest import words

SYLLABLES = {"aa": "ba de fo lu mi", "bb": "tsch krz wrm pfl xt", "cc": "ña ço éu ãi ô", "dd": "λο γι κα το νε"}


def text_in(lang, seed, n):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(SYLLABLES[lang].split()) for _ in range(r.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    return [(i, text_in(lang, i, 5 + i % 40), lang, "s") for i in range(400) for lang in [sorted(SYLLABLES)[i % 4]]]


@pytest.fixture(scope="module")
def model(documents, corpus):
    return langid.train(documents(corpus[:320]))


def test_held_out_accuracy(model, corpus):
    names, score, rejected = model.predict([r[1] for r in corpus[320:]])
    assert names == [r[2] for r in corpus[320:]]
    assert (score > 0.9).all() and (score <= 1).all() and not rejected.any()


def test_probabilities_add_up_to_one(model):
    symbols = np.unique(langid._symbols()[[ord(c) for c in " ".join(SYLLABLES.values())]])
    for context in ("ba", "λο", "zz", "a b"):
        head, _ = langid._stream([context])
        keys = np.array([langid._grams(np.append(head, s))[-1] for s in symbols])
        mass = np.exp(model._log_p(keys)).sum(0)
        assert (mass <= 1 + 1e-5).all() and (mass > 0.9).all()  # the rest belongs to symbols never seen


def test_stored_tables_equal_the_plain_recursion(documents, corpus):
    rows = [r for r in corpus[:60]]
    model = langid.train(documents(rows), sample_docs=10**6)
    kept = [r for r in rows]
    symbols, _ = langid._stream([r[1] for r in kept])
    keys = np.unique(langid._grams(symbols)[symbols != langid.START])
    found = model.tables[4].find(keys)
    direct = model._log_p(keys)
    assert np.allclose(direct[found >= 0], model.tables[4].rows[found[found >= 0]])
    odd = keys ^ np.uint64(0x55)
    assert (model.tables[4].find(odd[~np.isin(odd, keys)])[:50] >= -1).all()


def test_calibration_texts_are_scored_in_portions(model, corpus, monkeypatch):
    texts, truth = [r[1] for r in corpus[320:]], [r[2] for r in corpus[320:]]
    fitted, portions = [], []
    score = langid.Model.cross_entropy
    monkeypatch.setattr(langid.Model, "cross_entropy", lambda self, x: portions.append(sum(map(len, x))) or score(self, x))
    for most in (10**9, 2000):
        monkeypatch.setattr(langid, "CALIBRATED_AT_ONCE", most, raising=False)
        other = copy.copy(model)
        other.limits = model.limits.copy()
        other.calibrate(texts, truth)
        fitted.append((other.temperature, other.limits.tolist()))
    assert fitted[0] == fitted[1]
    assert len(portions) > 3 and max(portions[1:]) <= max(2000, max(map(len, texts)))


def test_texts_without_letters_and_foreign_texts(model):
    names, score, rejected = model.predict([None, "", "123 !?", "\U0001f600\U0001f600", "ba \0 de", "\U00010330" * 3])
    assert names[:4] == ["und"] * 4 and (score[:4] == 0).all() and rejected[:4].all()
    assert names[4] == "aa" and names[5] != "und"
    names, score, rejected = model.predict(["qqqqjjjj wwwqq jjxq " * 40])
    assert rejected[0] and score[0] < 0.5


def test_a_text_is_scored_alone(model, corpus):
    texts = [r[1] for r in corpus[:50]]
    together, _ = model.cross_entropy(texts)
    alone = np.concatenate([model.cross_entropy([t])[0] for t in texts])
    assert np.allclose(together, alone)


def test_identify_messy_rows(documents, model, messy):
    docs = documents(messy)
    out = langid.identify(docs, model)
    assert out.columns == [*docs.columns, "lang_pred", "lang_score", "lang_rejected"]
    assert sorted(r.lang_pred for r in out.collect() if r.doc_id in (4, 5, 6, 16)) == ["und"] * 4
    assert langid.identify(documents([]), model).count() == 0
    nothing = langid.train(documents([]))
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}


def test_held_out_fold(spark):
    import zlib

    rows = spark.range(50).select("id", langid.held_out(langid.F.col("id")).alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in rows)


# --- quality


def labelled(n=600):
    rows = []
    for i in range(n):
        text = words(i, 30 + i % 50, 300)
        if i % 5 == 0:
            text = [w.upper() + "!!" for w in text]
        if i % 7 == 0:
            text[3] = text[9 % len(text)] = random.Random(i).choice(["grumble", "snarl"])
        rows.append((i, " ".join(text), "en", f"h{i % 3}", int(i % 5 != 0), int(i % 7 == 0)))
    return rows


def test_quality_finds_what_labels_show(spark):
    rows = labelled()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, quality int, toxic int")
    model = quality.fit_evidence(docs.where("doc_id < 400").select("text", "quality", "toxic"))
    got = {r.doc_id: r for r in quality.assess(quality.with_host(docs), model).collect()}
    late = rows[400:]
    assert sum(got[r[0]].kept == (r[4] == 1 and r[5] == 0) for r in late) >= 0.97 * len(late)


def test_sparse_paths_shrink_to_their_host(spark):
    rows = [("h1", "a", 0.9)] * 200 + [("h1", "b", 0.1)] * 2 + [("h1", "c", 0.5)] * 200 + [("h2", "d", 0.2)] * 300 + [(None, None, 0.4)] * 3
    df = spark.createDataFrame(rows, "host string, path string, p double")
    rate = {(r.host, r.path): r.rate for r in quality.shrunken_rates(df, "p").collect()}
    assert len(rate) == 5
    assert abs(rate["h1", "a"] - 0.9) < 0.02 and abs(rate["h1", "c"] - 0.5) < 0.02
    assert 0.1 < rate["h1", "b"] < 0.7  # two documents move it only so far
    assert quality.shrunken_rates(df.where("false"), "p").count() == 0


def test_quality_of_messy_rows(spark, documents, messy):
    docs = documents(messy)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (7, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    sample = quality.label_sample(labels)
    assert sorted(map(tuple, sample.collect()), key=str) == [(1, 1, 1), (7, 1, None)]
    model = quality.fit_evidence(docs.select("doc_id", "text").join(sample, "doc_id"))
    out = quality.assess(quality.with_host(docs), model)
    assert out.count() == len(messy) and out.where("kept is null").count() == 0
    assert quality.assess(quality.with_host(documents([])), model).count() == 0


# --- language model scores


@pytest.mark.parametrize(("size", "frequent"), [(100, 50), (40, 0), (65000, 10**6)])
def test_scores_equal_plain_models(spark, documents, messy, size, frequent):
    rows = [(100 + i, " ".join(words(i, i % 60, 90))) for i in range(80)] + [r for r in messy if r[0] != 17]
    good = {100 + i for i in range(0, 80, 3)} | {1}
    target = spark.createDataFrame([(i,) for i in good] * 2 + [(None,)], "doc_id long")
    got = lmscore.score(documents(rows), target, vocabulary_size=size, frequent=frequent).collect()
    texts = [(r[1] or "").lower().split() for r in rows]
    counts = collections.Counter(w for t in texts for w in t)
    order = sorted(counts.items(), key=lambda x: (-x[1], np.uint64(xxhash.xxh3_64_intdigest(x[0])).view(np.int64)))
    known = {w for w, _ in order[:size]}
    texts = [["<s>", *(w if w in known else "<unk>" for w in t)] for t in texts]

    def model(ts):
        pairs = collections.Counter(p for t in ts for p in zip(t, t[1:], strict=False))
        total, kinds, unigram = collections.Counter(), collections.Counter(), collections.Counter()
        for (a, b), n in pairs.items():
            total[a] += n
            kinds[a] += 1
            unigram[b] += n
        n = sum(unigram.values())

        def loss(a, b):
            u = (unigram[b] + 1) / (n + len(known) + 1)
            return -math.log(max(pairs[a, b] - 0.75, 0) / total[a] + 0.75 * kinds[a] / total[a] * u if total[a] else u)

        return loss

    back, near = model(texts), model([t for t, r in zip(texts, rows, strict=True) if r[0] in good])
    want = []
    for r, t in zip(rows, texts, strict=True):
        n = len(t) - 1
        a, b = (sum(m(x, y) for x, y in zip(t, t[1:], strict=False)) / n if n else None for m in (near, back))
        want.append((r[0], n, *(None if v is None else round(v, 6) for v in (a, b, a - b if n else None))))
    found = [(r.doc_id, r.n_tokens, *(None if v is None else round(v, 6) for v in (r.target_loss, r.background_loss, r.score))) for r in got]
    near_enough = lambda x: [(a, n, *(None if v is None else round(v, 4) + 0.0 for v in rest)) for a, n, *rest in x]
    assert sorted(near_enough(found), key=str) == sorted(near_enough(want), key=str)


def test_scores_of_an_empty_table(spark, documents):
    assert lmscore.score(documents([]), spark.createDataFrame([], "doc_id long")).count() == 0
