import os
import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators import changes as cdc
from tallyline.sources import KeyedTable
from tallyline.streaming import ChangeFeed, classify_stream, fold_changes, read_changes, read_stream_parquet

SCHEMA = "id long, part string, at long, v string, note string"
FEED = ChangeFeed(["id", "part"], ["at"], "v = 'delete'", ["v"], parts=8)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def run(spark, tmp, rows=None, checkpoint="checkpoint"):
    landing, root = str(tmp / "landing"), str(tmp / "root")
    if rows is not None:
        frame(spark, rows).coalesce(1).write.mode("append").parquet(landing)
    stream = read_stream_parquet(spark, landing, frame(spark, []).schema, "*.parquet", 1)
    classify_stream(stream, root, str(tmp / checkpoint), FEED).awaitTermination()
    return root


def kinds(spark, root):
    return sorted((r.batch_id, r.id, r.change_type) for r in read_changes(spark, root).collect())


def files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet") and "/_" not in d}


def test_each_kind_of_row(spark, tmp_path):
    root = run(spark, tmp_path, [(1, "a", 5, "x", "n"), (1, "a", 4, "old", "n"), (2, "a", 5, "x", "n"), (3, "a", 1, "delete", "n"), (None, "a", 1, "x", "n"), (4, "a", None, "x", "n")])
    run(spark, tmp_path, [(1, "a", 6, "y", "n"), (2, "a", 6, "delete", "n"), (3, "a", 0, "late", "n"), (4, "a", 1, "x", "other note")])
    run(spark, tmp_path, [(1, "a", 3, "late", "n"), (2, "a", 5, "late", "n"), (3, "a", 9, "back", "n"), (4, "a", 1, "same age", "n")])
    run(spark, tmp_path, [(2, "a", 7, "again", "n"), (2, "a", 7, "delete", "n"), (1, "a", 7, "y", "n")])
    assert kinds(spark, root) == [
        (0, 1, "insert"), (0, 2, "insert"), (0, 4, "insert"),
        (1, 1, "update"), (1, 2, "delete"),
        (2, 3, "insert"),
    ]
    gone = read_changes(spark, root).where("change_type = 'delete'").first()
    assert (gone.v, gone.note, gone.at, gone.delta_business_key) == (None, None, None, "2|a")
    known = read_changes(spark, root).where("batch_id = 0 AND id = 2").first()
    assert gone.record_hash == known.record_hash
    # a row that only grew newer between two batches still makes the next one late
    run(spark, tmp_path, [(1, "a", 6, "late", "n")])
    assert [k for k in kinds(spark, root) if k[0] == 4] == []


def test_unchanged_and_replayed_rows_write_nothing(spark, tmp_path):
    rows = [(i, "a", 1, f"v{i}", "n") for i in range(50)]
    root = run(spark, tmp_path, rows)
    before, first = files(root), kinds(spark, root)
    run(spark, tmp_path, rows)
    assert kinds(spark, root) == first
    assert read_changes(spark, root).where("batch_id = 1").count() == 0
    new = files(f"{root}/index") - before
    assert not any("version=1/key_part" in f for f in new)  # no part of the index moved on
    # the same files under a new checkpoint replay both batches to the same end
    run(spark, tmp_path, checkpoint="checkpoint-2")
    assert kinds(spark, root) == first


def test_a_few_rows_touch_a_few_parts(spark, tmp_path):
    root = run(spark, tmp_path, [(i, "a", 1, f"v{i}", "n") for i in range(200)])
    run(spark, tmp_path, [(7, "a", 2, "new", "n")])
    parts = [n for n in os.listdir(f"{root}/index/version=1") if n.startswith("key_part=")]
    assert len(parts) == 1


@pytest.mark.parametrize("seed", [1, 2])
def test_batches_equal_comparison_of_snapshots(spark, tmp_path, seed):
    r = random.Random(seed)
    state, loads = {}, []
    for _ in range(4):
        load = [(r.randrange(25), r.choice("ab"), r.randrange(40), r.choice(["x", "y", "z", "delete"]), str(r.random())) for _ in range(40)]
        loads.append(load + (r.sample(loads[0], 10) if loads else []))
    for load in loads:
        root = run(spark, tmp_path, load)

    def alive(now):
        return frame(spark, [k + row for k, row in now.items() if row[1] != "delete"]).drop("note", "at")

    table = KeyedTable(spark, str(tmp_path / "folded"), FEED.keys, 4)
    found = read_changes(spark, root).cache()
    for n, load in enumerate(loads):
        before, state = state, dict(state)
        newest = {}
        for i, part, at, v, note in load:
            held = newest.get((i, part))
            rank = (at, v == "delete")
            if held is None or rank > held[0] or (rank == held[0] and v != held[1][1] and digest(v) < digest(held[1][1])):
                newest[i, part] = (rank, (at, v, note))
        for key, (_, row) in newest.items():
            if key not in state or row[0] > state[key][0]:
                state[key] = row
        wanted = cdc.change_set(cdc.detect_changes(alive(state), alive(before), FEED.keys, "record_hash"))
        pick = ["id", "part", "v", "record_hash", "change_type", "delta_business_key"]
        mine = found.where(F.col("batch_id") == n).select(*pick)
        assert sorted(map(str, mine.collect())) == sorted(map(str, wanted.select(*pick).collect())), n
        assert fold_changes(spark, root, table, upto=n) == str(n)
        assert sorted(map(str, table.read(str(n)).select("id", "part", "v").collect())) == sorted(map(str, alive(state).collect()))
    found.unpersist()


def digest(value):
    import hashlib

    return hashlib.sha256(value.encode()).hexdigest()
