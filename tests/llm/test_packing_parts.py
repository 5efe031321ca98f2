"""Rows are numbered in parts that are no larger than an even share."""

import pyarrow as pa

from tallyline.llm import packing


def test_no_part_is_larger_than_its_share():
    counts = {2048: 40_000, 900: 10_000, 7: 300_000, 3: 1}
    rows, volume = sum(counts.values()), sum(k * n for k, n in counts.items())
    for places in (4, 200):
        apart = packing.numbered_apart(counts, places)
        for length, n in counts.items():
            part = -(-n // apart[length])
            assert part <= max(1, 2 * rows / places / packing.FINER) and part * length <= max(length, 2 * volume / places / packing.FINER)
        assert sum(apart.values()) <= 2 * (packing.FINER * places + len(counts))
    assert packing.numbered_apart({5: 1_000_000}, 1)[5] == 20
    assert packing.numbered_apart({}, 4) == {}


def test_places_do_not_depend_on_the_parts(spark):
    rows = spark.range(900).selectExpr("id AS doc_id", "0 AS piece", "CASE WHEN id % 5 = 0 THEN 2048L WHEN id % 5 = 1 THEN 1500L ELSE 548L END AS length")
    out = packing.place(rows)
    found = out.groupBy("sequence_id").agg({"length": "sum", "offset": "count"}).collect()
    assert sum(r["count(offset)"] for r in out.groupBy().agg({"offset": "count"}).collect()) == 900
    assert max(r["sum(length)"] for r in found) <= 2048 and len(found) == 480  # 180 full ones, 180 pairs, the other short ones by threes
    assert out.select("sequence_id", "offset").distinct().count() == 900


def test_units_of_words_are_kept_in_bounds(monkeypatch):
    monkeypatch.setattr(packing, "CACHED_UNITS", 6)
    encoder = packing.WordEncoder(packing.default_tokenizer())
    for k in range(4):
        text = " ".join(f"unit{j}-part{k}" for j in range(5))
        assert encoder._word(text.split()[0]) and len(encoder.units) <= 6
        flat, _ = encoder.encode(pa.array([text]))
        assert flat.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids and len(encoder.units) <= 6
