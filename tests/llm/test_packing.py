import random
import zlib

import numpy as np
import pyarrow as pa

from tallyline.llm import packing


def check(counts, patterns, capacity):
    used = {}
    for filled, n in patterns:
        assert n > 0 and sum(filled) <= capacity
        for length in filled:
            used[length] = used.get(length, 0) + n
    assert used == {k: n for k, n in counts.items() if n}
    return sum(n for _, n in patterns)


def optimum(lengths, capacity):
    """Fewest bins, by trying every bin for every item."""
    best = [len(lengths)]

    def step(at, rooms):
        if len(rooms) >= best[0]:
            return
        if at == len(lengths):
            best[0] = len(rooms)
            return
        for i in range(len(rooms)):
            if rooms[i] >= lengths[at] and rooms[i] not in rooms[:i]:
                step(at + 1, [*rooms[:i], rooms[i] - lengths[at], *rooms[i + 1 :]])
        step(at + 1, [*rooms, capacity - lengths[at]])

    step(0, [])
    return best[0]


def counted(lengths):
    out = {}
    for x in lengths:
        out[x] = out.get(x, 0) + 1
    return out


def test_small_cases_reach_the_optimum():
    r, worse = random.Random(3), 0
    for _ in range(150):
        lengths = sorted((r.randint(1, 50) for _ in range(r.randint(1, 9))), reverse=True)
        got = check(counted(lengths), packing.bin_completion(counted(lengths), 50), 50)
        worse += got > optimum(lengths, 50)
    assert worse == 0


def test_never_worse_than_best_fit_and_near_the_bound():
    rng = np.random.default_rng(0)
    for lengths in (rng.integers(1, 2049, 3000), rng.integers(600, 1100, 2000), np.full(5000, 683), np.minimum(2048, rng.lognormal(6, 1, 20000)).astype(int) + 0):
        counts = counted(np.clip(lengths, 1, 2048).tolist())
        fit = check(counts, packing.best_fit(counts, 2048), 2048)
        got = check(counts, packing.bin_completion(counts, 2048), 2048)
        assert packing.lower_bound(counts, 2048) <= got <= fit
    assert packing.bin_completion({}, 2048) == []


def test_search_beats_best_fit_where_it_can():
    counts = counted([6, 5, 5, 4, 4, 4, 3, 3, 2, 2, 2])  # 40 in bins of 10
    assert check(counts, packing.bin_completion(counts, 10), 10) == 4


def expected_pieces(text):
    tokenizer = packing.WordEncoder(packing.default_tokenizer()).tokenizer
    ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
    return [(k // 2048, k, len(ids[k : k + 2048]), ids[k : k + 2048].tobytes()) for k in range(0, len(ids), 2048)]


def test_pieces_and_places(documents, messy):
    rows = [*messy, (90, "İstanbul ΣΑΣ it's we'll <|endoftext|>x ½ ²\u0085q a　b ́x", None, None)]
    placed = packing.pack(documents(rows)).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.piece, r.start, r.length, bytes(r.ids)) for r in placed)
    assert got == sorted((r[0] is None, r[0] or 0, *p) for r in rows for p in expected_pieces(r[1]))
    by = {}
    for r in placed:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(by) == -(-sum(r.length for r in placed) // 2048)
    assert packing.pack(documents([])).count() == 0


def test_digests_and_sequences_round_trip(spark, documents, messy):
    placed = packing.pack(documents(messy)).cache()
    crc = {(r.doc_id, r.piece): r.ids_crc32 for r in packing.digests(placed).collect() if r.doc_id and r.doc_id != 17}
    assert crc == {(r[0], p[0]): zlib.crc32(p[3]) for r in messy if r[0] and r[0] != 17 for p in expected_pieces(r[1])}
    ids = {r.sequence_id: packing.ids_of(bytes(r.ids)) for r in packing.sequences(placed).collect()}
    for r in placed.collect():
        assert ids[r.sequence_id][r.offset : r.offset + r.length] == packing.ids_of(bytes(r.ids))


def test_long_runs_of_one_length_are_numbered_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 50)
    rows = spark.range(1000).selectExpr("id AS doc_id", "0 AS piece", "CASE WHEN id % 3 = 0 THEN 700L ELSE 300L END AS length")
    out = packing.place(rows).groupBy("sequence_id").agg({"length": "sum", "offset": "count"}).collect()
    assert max(r["sum(length)"] for r in out) <= 2048 and sum(r["count(offset)"] for r in out) == 1000
    assert len(out) == 223  # two of each length in 167, the other short ones by sixes


def test_encoder_keeps_its_cache_in_bounds(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_WORDS", 10)
    encoder = packing.WordEncoder(packing.default_tokenizer())
    for k in range(5):
        text = " ".join(f"word{k}{j}" for j in range(8))
        flat, sizes = encoder.encode(pa.array([text, None]))
        assert flat.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids and sizes.tolist() == [len(flat), 0]
    assert len(encoder.known) <= 10


def test_digests_come_with_the_pieces(documents, messy):
    made = packing.pieces(documents(messy).select("doc_id", "text"), digest=True)
    assert made.columns == [*packing.PIECE.names, "ids_crc32"]
    got = made.collect()
    assert got and all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in got)
    plain = packing.pieces(documents(messy).select("doc_id", "text")).collect()
    assert sorted(map(str, plain)) == sorted(str(r) for r in made.drop("ids_crc32").collect())
