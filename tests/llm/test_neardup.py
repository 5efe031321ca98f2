import numpy as np
import pyarrow as pa

from tallyline.llm import neardup
from tests.llm.conftest import words


def reference(a, b):
    """Longest common subsequence of occurrence-labelled shingles, by the plain table."""
    x, y = (neardup.labelled(neardup.shingles(hashes(t))) for t in (a, b))
    table = np.zeros((len(x) + 1, len(y) + 1), int)
    for i in range(len(x)):
        for j in range(len(y)):
            table[i + 1, j + 1] = table[i, j] + 1 if x[i] == y[j] else max(table[i, j + 1], table[i + 1, j])
    m = table[-1, -1]
    return m / (len(x) + len(y) - m)


def hashes(text):
    return neardup.word_hashes(pa.array(text, pa.large_string()))


def edited(text, seed, edits):
    r, out = np.random.default_rng(seed), list(text)
    for _ in range(edits):
        at = int(r.integers(len(out)))
        kind = r.integers(3)
        if kind == 0:
            out[at] = f"new{r.integers(1000)}"
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, f"new{r.integers(1000)}")
    return out


def test_banded_alignment_equals_the_full_table():
    for seed in range(60):
        a = words(seed, 20 + seed * 3, 30 if seed % 2 else 500)
        b = edited(a, seed, seed % 6) if seed % 5 else a[10:] + a[:10]
        full = reference(a, b)
        got = neardup.aligned(hashes(a), hashes(b))
        assert got == full if full >= 0.8 else got < 0.8


def test_groups(spark, documents, messy):
    rows = {}
    for r in neardup.near_duplicates(documents(messy)).collect():
        rows.setdefault(r.doc_id, []).append((r.class_id, r.kept))
    assert rows[1] == [(1, True)] and rows[2] == [(1, False)] * 2
    assert rows[3] == [(1, False)]  # one change in sixty words leaves 51 of 61 shingles
    assert rows[4] == [(4, True)] and rows[5] == [(5, True)] and rows[6] == [(6, True)]
    assert rows[10] == [(10, True)] and rows[11] == [(10, False)]
    assert rows[None] == [(None, True)] * 2
    assert rows[17] == [(17, True)] * 2
    assert neardup.near_duplicates(documents([])).count() == 0


def test_a_large_group_of_different_near_copies_and_a_common_passage(spark, documents):
    base, passage = words(9, 150, 5000), words(10, 60, 5000)
    rows = [(i, " ".join(edited(base, i, 2))) for i in range(120)]
    rows += [(1000 + i, " ".join([*passage, *words(500 + i, 90, 5000)])) for i in range(80)]
    chain = words(11, 200, 5000)
    rows.append((3000, " ".join(chain)))
    for k in range(1, 4):  # each like the one before, the ends unlike each other
        chain = [f"c{k}", *chain[8:]]
        rows.append((3000 + k, " ".join(chain)))
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(documents(rows)).collect()}
    texts = {i: t.split() for i, t in rows}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(texts)
    x = {i: hashes(texts[i]) for i in ids}
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if neardup.aligned(x[i], x[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert got == {i: find(i) for i in ids}
    assert len({got[i] for i in range(1000, 1080)}) == 80


def test_one_of_each_keeps_one_row(documents, messy):
    docs = documents(messy)
    out = neardup.one_of_each(docs)
    assert out.columns == docs.columns
    ids = sorted((r.doc_id for r in out.collect()), key=lambda x: (x is None, x))
    assert not {2, 3, 11} & set(ids) and {1, 4, 5, 6, 7, 8, 9, 10, 12, 14, 16, 17} <= set(ids)
    assert ids.count(17) == 1 and ids.count(None) == 2


def test_one_of_each_with_columns_named_like_inner_ones(spark, messy):
    rows = [(r[0], r[1], f"own {i}", i) for i, r in enumerate(messy)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _kept string, _row long")
    found = neardup.one_of_each(docs)
    assert found.columns == docs.columns
    plain = neardup.one_of_each(docs.select("doc_id", "text"))
    assert sorted(map(str, found.select("doc_id", "text").collect())) == sorted(map(str, plain.collect()))
    assert all(r[2] == f"own {r[3]}" for r in found.collect())


def test_short_pairs_always_meet(spark, documents):
    rows = []
    for k, (m, n) in enumerate([(8, 9), (9, 10), (10, 11), (10, 12), (11, 13), (12, 14), (16, 19), (24, 29), (84, 104)] * 40):
        text = words(7000 + k, n, 10**6)
        rows += [(2 * k, " ".join(text)), (2 * k + 1, " ".join(text[:m] if k % 2 else text[n - m :]))]
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(documents(rows)).collect()}
    linked = {(2 * k, 2 * k + 1) for k in range(len(rows) // 2) if neardup.aligned(*(hashes(t.split()) for _, t in rows[2 * k : 2 * k + 2])) >= 0.8}
    assert len(linked) == 40 * 7  # of 10 and 12 words, 6 of 8 shingles are shared, of 11 and 13, 7 of 9
    assert got == {i: i - 1 if (i - 1, i) in linked else i for i, _ in rows}


def test_near_copies_meet_in_a_rare_bucket_by_the_index_of_the_shorter(spark):
    r = np.random.default_rng(3)
    texts = {}
    for seed in range(200):
        n = 5 + seed % 60
        a = words(seed, n, 8 if seed % 3 == 0 else 60)
        at = int(r.integers(n))
        texts[2 * seed], texts[2 * seed + 1] = a, [*a[:at], *a[at + 1 :]] if seed % 2 else [*a, *a[: n // 6]]
    x = {i: (hashes(t) >> np.uint64(32)).astype("<u4") for i, t in texts.items()}
    rows = neardup.shingle_rows(spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in x.items()], "id long, words binary"))
    sizes = {i: max(len(v) - 4, 1) for i, v in x.items()}
    found = neardup.rare_buckets(rows, spark.createDataFrame([(i, n, i) for i, n in sizes.items()], "rep long, n long, root long"), 0.8)
    every, index = {}, {}
    for b in found.collect():
        every.setdefault(b.rep, set()).add(b.bucket)
        index.setdefault(b.rep, set()).update([b.bucket] if b.index else [])
    linked = [(i, j) for i in x for j in range(i) if neardup.aligned(x[i], x[j]) >= 0.8]
    assert len(linked) > 100
    for pair in linked:
        short, long = sorted(pair, key=sizes.get)
        assert index[short] & every[long]


def test_texts_that_only_share_a_passage_are_in_no_rare_bucket(spark):
    passage = words(40, 60, 10**6)
    x = {i: hashes([*passage, *words(6000 + i, 40, 10**6)]) >> np.uint64(32) for i in range(300)}
    rows = neardup.shingle_rows(spark.createDataFrame([(i, bytearray(v.astype("<u4").tobytes())) for i, v in x.items()], "id long, words binary"))
    texts = spark.createDataFrame([(i, len(v) - 4, i) for i, v in x.items()], "rep long, n long, root long")
    assert neardup.rare_buckets(rows, texts, 0.8).count() == 0


def test_one_of_each_prefers_a_text_to_none(documents):
    rows = [(1, None), (1, "the text of this document"), (2, None)]
    got = {r.doc_id: r.text for r in neardup.one_of_each(documents(rows)).collect()}
    assert got == {1: "the text of this document", 2: None}


def test_a_crowded_bucket_keeps_all_its_pairs(spark, documents):
    """One sketch of one shingle, which all texts have in common."""
    many = words(20, 300_000, 10**6)
    values = (neardup.labelled(neardup.shingles(hashes(many))) ^ neardup.SEEDS[0]) * neardup.SEEDS[0]
    least = int(np.argmin(values ^ (values >> np.uint64(31))))
    passage = many[least : least + 5]
    rows = [(i, " ".join([*passage, *words(8000 + i, 130, 10**6)])) for i in range(150)]
    for k in range(12):
        text = [*passage, *words(9000 + k, 130, 10**6)]
        rows += [(1000 + 2 * k, " ".join(text)), (1001 + 2 * k, " ".join([*text[:-12], *words(9500 + k, 12, 10**6)]))]
    sketches = {neardup.order_sketches(neardup.shingles(hashes(t.split())), 1, 1)[0] for _, t in rows}
    assert len(sketches) == 1 and len(rows) > 100
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(documents(rows), sketches=1, sampled=1).collect()}
    assert got == {i: i - 1 if i >= 1000 and i % 2 else i for i, _ in rows}


def test_short_texts_of_one_template_meet_in_crowded_buckets(spark, documents):
    """Texts whose rarest shingles are common to all of them as well, so that buckets stay crowded for rounds."""
    r = np.random.default_rng(5)
    base = words(30, 24, 10**6)
    rows = []
    for i in range(240):
        text = list(base)
        for at in r.choice(24, 2, replace=False):
            text[at] = f"v{r.integers(3)}"
        rows.append((i, " ".join(text)))
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(documents(rows)).collect()}
    x = {i: hashes(t.split()) for i, t in rows}
    root = {i: i for i in x}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in x:
        for j in range(i):
            if neardup.aligned(x[i], x[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert got == {i: find(i) for i in x}


def test_unlike_texts_of_one_template_are_not_paired(spark, documents, monkeypatch):
    """Each has three words of its own: rare shingles are common to all, and no two reach the threshold."""
    base = words(50, 149, 10**6)
    rows = []
    for i in range(120):
        text = list(base)
        for k, at in enumerate(np.random.default_rng(700 + i).choice(14, 3, replace=False)):
            text[at * 10 + 5] = f"own{i}x{k}"
        rows.append((i, " ".join(text)))
    listed, store = [], neardup.stage

    def counted(df, purpose, *more):
        out = store(df, purpose, *more)
        if purpose == "pairs":
            listed.append(out.count())
        return out

    monkeypatch.setattr(neardup, "stage", counted)
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(documents(rows)).collect()}
    x = {i: hashes(t.split()) for i, t in rows}
    near = {(i, j) for i in x for j in range(i) if neardup.aligned(x[i], x[j]) >= 0.8}
    assert all(got[i] == got[j] for i, j in near) and len(set(got.values())) >= len(x) - len(near)
    assert listed[-1] <= 120  # of 7140


def test_parities_never_rule_out_a_pair_at_the_threshold(spark):
    texts = {}
    for seed in range(150):
        a = words(seed, 5 + 3 * seed, 12 if seed % 3 == 0 else 3000)
        texts[2 * seed], texts[2 * seed + 1] = a, edited(a, seed, seed % 8)
    x = {i: (hashes(t) >> np.uint64(32)).astype("<u4") for i, t in texts.items()}
    made = neardup.parity_table(spark.createDataFrame([(i, bytearray(v.tobytes())) for i, v in x.items()], "id long, words binary"))
    bits = {r.rep: [b & (2**64 - 1) for b in r.parities] for r in made.collect()}
    for i, j in ((2 * k, 2 * k + 1) for k in range(150)):
        a, b = (set(neardup.labelled(neardup.shingles(x[k])).tolist()) for k in (i, j))
        assert sum((p ^ q).bit_count() for p, q in zip(bits[i], bits[j], strict=True)) <= len(a ^ b)
