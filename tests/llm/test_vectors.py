import math

import duckdb
import numpy as np
import pytest

from pyspark.sql import functions as F
from tallyline.llm import topk, vectordup

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score long, rep long, cell int, home boolean, dim long, payload binary"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, 1, 1, 1, 1, True, 1, b"x") for i, v, label in rows], SCHEMA)


def vectors(n, dim=8, seed=0):
    r = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if i % 3 == 1 and rows:
            v = np.array(rows[int(r.integers(len(rows)))][1]) + r.normal(0, 0.12 if i % 2 else 0.0, dim)
        else:
            v = r.normal(0, 1, dim)
        rows.append((i, np.float32(v).tolist(), int(r.integers(3)) if i % 5 else 0))
    return rows


ODD = [
    (900, None, 1), (950, [1.0, None, 0.0, 0, 0, 0, 0, 0], 1), (951, [float("nan")] * 8, 1), (952, [float("inf")] + [0.0] * 7, 1),
    (953, [0.0] * 8, 1), (954, [1.0, 2.0], 1), (1000, [1.0, 2.0], 1), (956, [], 1), (957, [1.0] * 8, None), (None, [1.0] * 8, 1), (958, [1.0] * 8, 1), (958, [1.0] * 8, 1),
]


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def long(x):
    return max(min(x, 2**63 - 1), -(2**63))


def brute_top(rows, k=5):
    good = sorted({(i, tuple(math.floor(256 * x) for x in v)) for i, v, _ in rows if i is not None and usable(v)})
    out = []
    for q, a in good:
        if q % 50 == 0:
            scored = sorted((-long(sum(x * y for x, y in zip(a, b, strict=True))), i) for i, b in good if i != q and len(a) == len(b))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(dict.fromkeys(scored))][:k]
    return sorted(out)


@pytest.mark.parametrize("block", [4, 256])
def test_top_k_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "BLOCKS_PER_TASK", 3)
    monkeypatch.setattr(topk, "QUERIES_PER_TASK", 8)
    rows = vectors(400) + ODD + [(1100 + i, [0.0] * 8, 1) for i in range(20)]
    got = topk.top_k(table(spark, rows), F.col("vec_id") % 50 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute_top(rows)


def test_top_k_of_huge_components_few_rows_and_none(spark):
    big = [(0, [3e15, -2e15], 1), (1, [2e15, 1.5], 1), (50, [1.0, 1.0], 1)]
    got = sorted(map(tuple, topk.top_k(table(spark, big), F.col("vec_id") % 50 == 0).collect()))
    assert got == brute_top([(i, np.float32(v).tolist(), x) for i, v, x in big])
    assert topk.top_k(table(spark, []), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(table(spark, vectors(3)), F.col("vec_id") % 50 == 0).count() == 2


def test_pruning_skips_blocks(monkeypatch):
    r = np.random.default_rng(2)
    merged, merge = [], topk._merge
    monkeypatch.setattr(topk, "_merge", lambda *a: merged.append(1) or merge(*a))
    near = [(np.arange(8) + 10, r.integers(90, 100, (8, 4)).astype(float))]
    far = [(np.arange(8) + 100 * k, r.integers(-100, -90, (8, 4)).astype(float)) for k in range(2, 6)]

    score, ident = topk._best(np.array([0]), np.ones((1, 4)), far + near, 5)
    assert set(ident[0]) <= set(near[0][0]) and (score > 0).all() and len(merged) == 1


def brute_links(rows, threshold=0.93):
    good = [(n, np.float64(np.float32(v)), label) for n, (i, v, label) in enumerate(rows) if i is not None and label is not None and usable(v) and any(v)]
    links, root = [0] * len(rows), {i: i for i, *_ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (m, a, p) in enumerate(good):
        for n, b, q in good[x + 1 :]:
            if p == q and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                links[m] += 1
                links[n] += 1
                i, j = sorted((find(rows[m][0]), find(rows[n][0])))
                root[j] = i
    return sorted(((i, links[n], find(i), i is None or find(i) == i) for n, (i, *_) in enumerate(rows)), key=str)


@pytest.mark.parametrize(("cell", "chunk"), [(4096, 4096), (20, 16), (6, 5)])
def test_near_vectors_equal_brute_force(spark, cell, chunk):
    rows = vectors(300, dim=4) + [r for r in ODD if r[0] != 958] + [(2000 + i, [1.0, 2.0, 3.0, 4.0], 2) for i in range(40)]
    got = vectordup.near_vectors(table(spark, rows), cell=cell, chunk=chunk)
    assert sorted(map(tuple, got.collect()), key=str) == brute_links(rows)


def test_near_vectors_of_repeated_ids_and_none(spark):
    got = sorted(map(tuple, vectordup.near_vectors(table(spark, [(958, [1.0] * 8, 1), (958, [1.0] * 8, 1), (3, [1.0] * 8, 1)])).collect()))
    assert got == [(3, 2, 3, True), (958, 2, 3, False), (958, 2, 3, False)]
    assert vectordup.near_vectors(table(spark, [])).count() == 0


def test_sql_agrees(spark):
    rows = vectors(150, dim=4)
    con = duckdb.connect()
    con.register("embeddings", table(spark, rows).select("vec_id", "embedding", "label").toArrow())
    assert sorted(con.execute(vectordup.OP9_SQL).fetchall(), key=str) == brute_links(rows)
    assert sorted(con.execute(topk.OP4_SQL).fetchall()) == brute_top(rows)
