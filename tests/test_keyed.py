import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tallyline import functions as fn
from tallyline.operators import changes as cdc
from tallyline.sources import KeyedTable, staged

KEYS = ["id", "part"]


def frame(spark, rows):
    df = spark.createDataFrame(rows, "id int, part string, value string")
    return df.withColumn("record_hash", fn.record_hash(["value"]))


def base_rows(n=200):
    return [(i, str(i % 3), f"v{i % 7}") for i in range(n)]


def rows_of(df):
    return sorted(map(str, map(tuple, df.select("id", "part", "value").collect())))


def expected(rows):
    return sorted(map(str, rows))


def files(root):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


@pytest.fixture
def made(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), KEYS, parts=16)
    table.create(frame(spark, base_rows()), "1")
    return table


def test_a_small_change_reads_and_writes_its_parts_only(spark, made):
    rows = base_rows()
    changed = [(5, "2", "new"), (1000, "1", "added")]
    latest = [r for r in rows if r[0] not in (5, 7)] + changed  # an update, a delete, an insert
    before = files(made.root)
    changes = staged(made.compare(frame(spark, latest), "1"))
    assert {r.id: r.change_type for r in changes.collect()} == {5: "update", 7: "delete", 1000: "insert"}
    parts = made.apply("1", "2", changes)
    assert 0 < len(parts) <= 3 and rows_of(made.read("2")) == expected(latest)

    after = files(made.root)
    assert {f: after[f] for f in before} == before  # nothing of the first version is written again
    new = {f for f in after if f not in before and "version=2" in f and "/_" not in f}
    assert {int(f.split("key_part=")[1].split("/")[0]) for f in new} <= set(parts)
    holders = made.holders("2")
    assert {p for p, v in holders.items() if v == "2"} <= set(parts) and {holders[p] for p in holders if p not in parts} == {"1"}
    # only the folders of touched parts are scanned
    scanned = made.read("1", parts).inputFiles()
    assert scanned and {int(f.split("key_part=")[1].split("/")[0]) for f in scanned} <= set(parts)

    assert rows_of(made.read("1")) == expected(rows)
    made.apply("1", "2", changes)  # once more
    assert rows_of(made.read("2")) == expected(latest)


def test_no_change_writes_no_part(spark, made):
    changes = staged(made.compare(frame(spark, base_rows()), "1"))
    assert made.apply("1", "2", changes) == []
    assert set(made.holders("2").values()) == {"1"}
    assert rows_of(made.read("2")) == expected(base_rows())


def test_versions_equal_plain_application(spark, made):
    kept, version = base_rows(), 1
    for seed in range(3):
        latest = [(i, p, v if (i + seed) % 9 else f"x{seed}") for i, p, v in kept if (i * 7 + seed) % 11] + [(500 + seed, "0", "n")]
        changes = staged(made.compare(frame(spark, latest), str(version)))
        plain = cdc.apply_changes(frame(spark, kept), changes, KEYS)
        made.apply(str(version), str(version + 1), changes)
        assert rows_of(made.read(str(version + 1))) == rows_of(plain) == expected(latest)
        kept, version = latest, version + 1


def test_upsert_by_key_and_hash(spark, made):
    incoming = staged(frame(spark, [(3, "0", "v3"), (4, "1", "other"), (900, "0", "n"), (None, "0", "no key")]))
    parts = made.upsert("1", "2", incoming, staged)
    assert len(parts) <= 2
    rows = [r for r in base_rows() if r[0] != 4] + [(4, "1", "other"), (900, "0", "n")]
    assert rows_of(made.read("2")) == expected(rows)
    same = staged(frame(spark, [(3, "0", "v3")]))
    assert made.upsert("2", "3", same, staged) == []


def test_rows_without_a_key_stay_and_wider_keys_meet(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), KEYS, parts=4)
    rows = [*base_rows(20), *[(None, "0", f"keyless {i}") for i in range(40)], (3, None, "half")]
    table.create(frame(spark, rows), "1")
    spread = {f.split("key_part=")[1].split("/")[0] for f in table.read("1").where("id IS NULL").inputFiles()}
    assert len(spread) > 1
    change = frame(spark, [(3, "0", "z")]).withColumn("id", F.col("id").cast("long")).withColumn("change_type", F.lit("update"))
    table.apply("1", "2", change)
    assert rows_of(table.read("2")) == expected([r for r in rows if r[:2] != (3, "0")] + [(3, "0", "z")])


def test_parts_and_lists(spark, made):
    assert KeyedTable(spark, made.root, KEYS, parts=5).parts == 16  # as the table was made
    all_gone = staged(made.compare(frame(spark, []), "1"))
    made.apply("1", "2", all_gone)
    assert made.read("2").count() == 0 and made.holders("2") == {} and made.read("2").columns == made.read("1").columns
    made.apply("2", "3", staged(made.compare(frame(spark, base_rows(3)), "2")))
    assert rows_of(made.read("3")) == expected(base_rows(3))
    assert made.versions() == ["1", "2", "3"]


def test_unused_parts_are_dropped(spark, made):
    latest = [(5, "2", "new"), *[r for r in base_rows() if r[0] != 5]]
    made.apply("1", "2", staged(made.compare(frame(spark, latest), "1")))
    dropped = made.drop_unused(["2"])
    assert len(dropped) == 1 and made.versions() == ["2"]
    assert rows_of(made.read("2")) == expected(latest)


def test_parts_are_stored_by_a_codec_that_makes_hashes_smaller(spark, made):
    stored = [f for f in files(made.root) if "version=1" in f and "/_" not in f]
    codecs = {pq.ParquetFile(f).metadata.row_group(0).column(i).compression for f in stored for i in range(4)}
    assert codecs == {"ZSTD"} and rows_of(made.read("1")) == expected(base_rows())
