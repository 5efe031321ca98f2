import hashlib
import random
from fractions import Fraction

import duckdb
import pytest

from tallyline.llm import mixing
from tests.llm.conftest import words


def reference(rows):
    """(size, source_size, target, taken) of every row, by filling up one source after another."""
    size = [len((r[1] or "").split()) for r in rows]
    names = sorted({r[3] for r in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {s: sum(n for n, r in zip(size, rows, strict=True) if r[3] == s) for s in names}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, Fraction(sum(size)), set(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if 3 * total[s] <= level * weight[s]]
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in full:
            target[s] = Fraction(3 * total[s])
            left -= target[s]
            open_.remove(s)
    out = []
    for s in names:
        mine = [(hashlib.md5(str(r[0] if r[0] is not None else "").encode()).hexdigest(), r[0] is not None, r[0] or 0, n) for n, r in zip(size, rows, strict=True) if r[3] == s]
        budget = int(target[s] + Fraction(1, 2))
        epochs, rest = divmod(budget, total[s]) if total[s] else (0, 0)
        for _, known, doc_id, n in sorted(mine):
            part = max(0, min(n, rest))
            rest -= part
            out.append((doc_id if known else None, n, total[s], round(float(target[s]), 6), epochs * n + part))
    return sorted(out, key=str)


def mixes():
    r = random.Random(1)
    yield [(i, " ".join(words(i, r.randrange(60))), "en", f"s{min(i % 9, 3)}") for i in range(120)]
    yield [(i, " ".join(words(i, 5)), "en", "only") for i in range(7)]
    yield [(1, None, None, "a"), (2, "", None, None)]
    yield [(i, " ".join(words(i, 200 if i < 5 else 1)), None, "big" if i < 5 else f"t{i}") for i in range(30)]


@pytest.mark.parametrize("case", range(5))
def test_mix_equals_the_reference(documents, messy, case):
    rows = [(*r, None, None)[:4] for r in ([*mixes(), messy][case])]
    rows = [(a, b if b is None or "\U0001f600" not in b else "x", c, d) for a, b, c, d in rows]
    got = mixing.mix(mixing.sized_documents(documents(rows))).collect()
    found = sorted(((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got), key=str)
    assert found == reference(rows)
    for s in {r[3] for r in rows}:
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 0.5
    assert all(r.taken <= 3 * r.size for r in got)


def test_sql_agrees(documents, messy):
    rows = [r for r in messy if r[0] is not None]
    docs = documents(rows)
    arrow = docs.select("doc_id", "text", "source").toArrow()
    con = duckdb.connect()
    con.register("documents", arrow)
    theirs = sorted(((a, b, c, round(d, 6), e) for a, b, c, d, e in con.execute(mixing.OP3_SQL).fetchall()), key=str)
    mine = mixing.mix(mixing.sized_documents(docs)).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted(((a, b, c, round(d, 6), e) for a, b, c, d, e in mine), key=str) == theirs


def test_mixed_documents_hold_the_budget(documents, messy):
    docs = documents(messy)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    plan = mixing.mix(mixing.sized_documents(docs)).collect()
    taken = {}
    for r in plan:
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    found = {}
    for r in out.collect():
        found[r.doc_id] = found.get(r.doc_id, 0) + len(r.text.split())
    assert found == {k: v for k, v in taken.items() if v}
    assert mixing.mixed_documents(documents([])).count() == 0
    assert mixing.mix(mixing.sized_documents(documents([]))).count() == 0


def test_plan_has_no_python(documents, messy):
    plan = mixing.mix(mixing.sized_documents(documents(messy)))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))
