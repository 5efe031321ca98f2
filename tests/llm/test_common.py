import random

import pytest

from tallyline.llm import common, neardup, packing

EDGE = "a long, b long"


def by_hand(edges):
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            low, high = sorted((top(a), top(b)))
            root[high] = low
    return {(x, top(x)) for x in list(root)}


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def some_edges(seed):
    r = random.Random(seed)
    edges = [(r.randrange(60), r.randrange(60)) for _ in range(30)] + [(100 + k, 101 + k) for k in range(17)]
    return edges + edges[:5] + [(7, 7)] + [(300, x) for x in range(290, 310)]


@pytest.fixture
def steps(monkeypatch):
    names, real = [], common.stage
    monkeypatch.setattr(common, "stage", lambda df, purpose, *a: names.append(purpose) or real(df, purpose, *a))
    return names


def test_components_equal_a_search_by_hand(spark):
    for seed in range(2):
        edges = some_edges(seed)
        assert found(common.components(spark.createDataFrame(edges, EDGE))) == by_hand(edges)


def test_stars_and_no_edges_take_no_round(spark, steps):
    edges = [(1, 2), (3, 1), (1, 4), (4, 1), (9, 8)]
    assert found(common.components(spark.createDataFrame(edges, EDGE))) == by_hand(edges)
    assert found(common.components(spark.createDataFrame([], EDGE))) == set()
    assert "stars" not in steps


def test_further_links_join_whole_groups(spark):
    edges = some_edges(5)
    first, more = edges[::2], edges[1::2]
    roots = common.components(spark.createDataFrame(first, EDGE)).withColumnRenamed("node", "rep")
    joined = neardup._joined(roots, spark.createDataFrame(more, EDGE))
    assert found(joined.select("rep", "root")) == by_hand(edges)


def test_only_lengths_and_ranks_go_through_python(spark, capfd):
    rows = spark.createDataFrame([(k, 0, 3, bytearray(b"xyz")) for k in range(5)], "doc_id long, piece int, length long, ids binary")
    placed = packing.place(rows, 10)
    placed.explain()
    plan = capfd.readouterr().out
    assert "MapInArrow" not in plan and "placed(length" in plan
    got = placed.collect()
    assert {(r.doc_id, bytes(r.ids)) for r in got} == {(k, b"xyz") for k in range(5)}
    assert sorted((r.sequence_id, r.offset) for r in got) == [(0, 0), (0, 3), (0, 6), (1, 0), (1, 3)]


def test_encoders_are_given_back():
    packing._ENCODERS["x"] = None
    packing._forget()
    assert not packing._ENCODERS
