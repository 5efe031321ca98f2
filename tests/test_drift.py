import gzip
import os
from datetime import datetime

from tallyline.streaming import DriftingFeed, SchemaLog, ingest_drifting, read_drifted
from tallyline.streaming.drift import header

AT = datetime(2026, 3, 1)


def land(tmp, name, text):
    os.makedirs(tmp / "landing", exist_ok=True)
    (tmp / "landing" / name).write_text(text)


def run(spark, tmp, checkpoint="checkpoint", evolve=True, columns=(), files=1000):
    feed = DriftingFeed("crm", "load-1", columns, evolve, AT)
    ingest_drifting(spark, str(tmp / "landing"), str(tmp / "root"), str(tmp / checkpoint), feed, files_per_trigger=files).awaitTermination()
    return read_drifted(spark, str(tmp / "root"))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_new_and_missing_columns_lose_nothing(spark, tmp_path):
    land(tmp_path, "1.csv", "id,name,city\n1,Ann,Oslo\n2,Bo,\n")
    found = run(spark, tmp_path)
    assert rows(found, "id", "name", "city") == [("1", "Ann", "Oslo"), ("2", "Bo", None)]
    hashes = {r.id: r.record_hash for r in found.collect()}

    land(tmp_path, "2.csv", "name,city,id\nCy,Rome,3\n")  # another order
    land(tmp_path, "3.csv", 'id,phone,name\n4,"55, ext 5",Di\n')  # a new column and a missing one
    found = run(spark, tmp_path)
    assert rows(found, "id", "name", "city", "phone", "schema_version") == [
        ("1", "Ann", "Oslo", None, 1), ("2", "Bo", None, None, 1), ("3", "Cy", "Rome", None, 2), ("4", "Di", None, "55, ext 5", 2)
    ]
    versions = SchemaLog(spark, str(tmp_path / "root")).versions()
    assert [(v.number, v.columns, v.batch_id) for v in versions] == [(1, ("id", "name", "city"), 0), (2, ("id", "name", "city", "phone"), 1)]
    assert versions[1].file.endswith("3.csv")
    assert {r.id: r.record_hash for r in found.collect() if r.id in hashes} == hashes
    assert {(r.source_system, r.load_id, r.ingestion_timestamp) for r in found.collect()} == {("crm", "load-1", AT)}
    assert {r.source_file_name.rsplit("/", 1)[1] for r in found.collect()} == {"1.csv", "2.csv", "3.csv"}

    again = rows(found, "id", "name", "phone", "schema_version")
    assert rows(run(spark, tmp_path), "id", "name", "phone", "schema_version") == again  # nothing new
    # under a new checkpoint the files arrive in one batch; the first batch is written again, the second stays
    log = [(v.number, v.columns) for v in versions]
    run(spark, tmp_path, "checkpoint-1", files=1)
    assert [(v.number, v.columns) for v in SchemaLog(spark, str(tmp_path / "root")).versions()][-1][1] == log[-1][1]


def test_unknown_fields_are_rescued(spark, tmp_path):
    land(tmp_path, "1.csv", "id,name\n1,Ann\n")
    land(tmp_path, "2.csv", "ID,extra,name,,name\n2,x,Bo,y,z\n3,,Cy,,\n")
    found = run(spark, tmp_path, evolve=False, columns=("id", "name"))
    assert rows(found, "id", "name", "rescued") == [
        ("1", "Ann", None), ("2", "Bo", {"extra": "x", "#3": "y", "name#4": "z"}), ("3", "Cy", None)
    ]
    assert [v.columns for v in SchemaLog(spark, str(tmp_path / "root")).versions()] == [("id", "name")]


def test_broken_lines_are_kept_apart(spark, tmp_path):
    land(tmp_path, "1.csv", 'id,name\n1,Ann\n2\n3,x,y\n4,"open\n')
    found = run(spark, tmp_path)
    assert rows(found, "id", "name") == [("1", "Ann")]
    broken = read_drifted(spark, str(tmp_path / "root"), broken=True)
    assert rows(broken, "parse_error", "raw_line") == [("bad_quote", '4,"open'), ("too_few_fields", "2"), ("too_many_fields", "3,x,y")]
    assert {r.source_file_name.rsplit("/", 1)[1] for r in broken.collect()} == {"1.csv"}


def test_empty_files_and_headers(spark, tmp_path):
    land(tmp_path, "0.csv", "")
    land(tmp_path, "1.csv", "﻿id , name\n1,a\n")
    assert rows(run(spark, tmp_path), "id", "name") == [("1", "a")]
    packed = tmp_path / "x y.csv.gz"
    packed.write_bytes(gzip.compress(b'"a ""b""",c\n1,2\n'))
    assert header(spark, str(packed)) == ('a "b"', "c")
    assert header(spark, f"file://{str(packed).replace(' ', '%20')}") == ('a "b"', "c")
    (tmp_path / "none.csv").write_text("")
    assert header(spark, str(tmp_path / "none.csv")) == ()
