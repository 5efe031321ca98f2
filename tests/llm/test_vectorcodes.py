import math
import random

import duckdb
import numpy as np
import pytest

from tallyline.llm import vectorcodes

SCHEMA = "vec_id long, embedding array<double>, label int, v array<double>, code string, error long, label_key string, part int, entry int, position int, n long, total string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, label, [1.0], "c", 1, "k", 1, 1, 1, 1, "t") for i, v, label in rows], SCHEMA)


def vectors(n, dim, seed=0, spread=1.0):
    r = random.Random(seed)
    rows = [(i * 3 % (2 * n), [float(np.float32(r.gauss(0, spread))) for _ in range(dim)], None if i % 7 == 0 else 1 if i % 3 else i % 5) for i in range(n)]
    return rows + rows[: n // 4]


ODD = [
    (900, None, 1), (901, [1.0, None] + [0.0] * 6, 1), (902, [float("nan")] * 8, 1), (903, [float("inf")] + [0.0] * 7, 1),
    (904, [], 1), (905, [1.0] * 7, 1), (906, [1.0] * 12, 1), (None, [0.25] * 8, 1), (None, [0.5] * 8, None), (907, [-0.001] * 8, 2), (907, [-0.001] * 8, 2),
]


def brute(rows, parts, entries, rounds):
    good = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1]) and len(r[1]) % parts == 0]
    good.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = len(good[0][1])
    cut = []
    for i, v, label in good:
        if len(v) == dim:
            whole = [max(-(2**86), min(2**86, math.floor(256 * x) if abs(x) < 2**45 else int(256 * x))) for x in v]
            w = dim // parts
            cut.append((i, label, [tuple(whole[p * w : (p + 1) * w]) for p in range(parts)]))
    books = [[c[2][p] for c in cut[:entries]] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        moved = []
        for p, book in enumerate(books):
            groups = {}
            for _, _, own in cut:
                groups.setdefault(nearest(own[p], book)[1], []).append(own[p])
            moved.append([tuple(sum(x) // len(x) for x in zip(*groups[k], strict=True)) if k in groups else e for k, e in enumerate(book)])
        books = moved
    out, errors = [], {}
    for i, label, own in cut:
        found = [nearest(own[p], books[p]) for p in range(parts)]
        error = min(sum(d for d, _ in found), 2**63 - 1)
        errors[label] = errors.get(label, 0) + error
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), error))
    return sorted(((*r, min(errors[r[1]], 2**63 - 1)) for r in out), key=str), books


@pytest.mark.parametrize("chunk", [5, 2048])
def test_codes_equal_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(vectorcodes, "CHUNK", chunk)
    rows = vectors(120, 8) + ODD
    found, books = vectorcodes.vector_codes(table(spark, rows), parts=4, entries=16)
    expected, expected_books = brute(rows, 4, 16, 2)
    assert found.columns == ["vec_id", "label", "code", "error", "label_error"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected
    assert [[tuple(int(x) for x in e) for e in b] for b in books.books] == expected_books


def test_many_labels_take_the_spread_join(spark, monkeypatch):
    monkeypatch.setattr(vectorcodes, "MOST_BROADCAST", 0)
    rows = vectors(60, 8) + ODD
    found, _ = vectorcodes.vector_codes(table(spark, rows), parts=4, entries=8)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, 4, 8, 2)[0]


def test_huge_components_are_exact(spark):
    rows = [(i, [(-1) ** i * 10.0 ** (3 * (i + j)) for j in range(4)], i % 2) for i in range(12)]
    found, books = vectorcodes.vector_codes(table(spark, rows), parts=2, entries=4)
    expected, expected_books = brute(rows, 2, 4, 2)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected
    assert [[tuple(int(x) for x in e) for e in b] for b in books.books] == expected_books


def test_few_vectors_and_none(spark):
    rows = [(1, [1.0] * 4, 1), (2, [1.0] * 4, None)]
    found, books = vectorcodes.vector_codes(table(spark, rows), parts=4)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows, 4, 64, 2)[0]
    assert books.books.shape == (4, 2, 1)
    found, books = vectorcodes.vector_codes(table(spark, rows).where("false"))
    assert books is None and found.count() == 0


def test_orchard_finds_the_nearest_with_ties_to_the_lower_index():
    r = np.random.default_rng(1)
    books = r.integers(-3, 4, (3, 40, 2))  # many equal entries and equal distances
    x = r.integers(-4, 5, (500, 3, 2)).astype(float)
    now, least = vectorcodes.orchard(x, vectorcodes.Codebooks(books))
    away = ((x[:, :, None].astype(int) - books[None]) ** 2).sum(-1)
    assert (now == away.argmin(-1)).all() and (least == away.min(-1)).all()


def test_orchard_skips_most_distances(monkeypatch):
    r = np.random.default_rng(2)
    books = vectorcodes.Codebooks(r.integers(-300, 300, (1, 64, 2)))
    x = r.integers(-300, 300, (400, 1, 2)).astype(float)
    walked = 0
    take = books.lists

    class Counting:
        def __getitem__(self, at):
            nonlocal walked
            walked += len(at[0])
            return take[at]

    object.__setattr__(books, "lists", Counting())
    vectorcodes.orchard(x, books)
    assert walked < 400 * 63 / 2


def test_sql_equals_brute_force(spark, tmp_path):
    rows = [(i, v, label) for i, v, label in vectors(150, 32, 3) if i is not None]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    got = con.execute(f"SELECT vec_id, code, error, label_error FROM ({vectorcodes.OP13_SQL})").fetchall()
    expected, _ = brute(rows, 16, 64, 2)
    assert sorted(got, key=str) == sorted(((i, c, e, s) for i, _, c, e, s in expected), key=str)
