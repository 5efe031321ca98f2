from datetime import datetime

from pyspark.sql import functions as F

from tallyline import streaming
from tallyline.plans import trials
from tests.fixtures import STUDIES, land

AT = datetime(2026, 3, 1)


def test_each_file_is_ingested_once(spark, tmp_path):
    landing, raw, checkpoint = tmp_path / "landing", str(tmp_path / "raw"), str(tmp_path / "checkpoint")

    def run():
        stream = streaming.read_stream_csv(spark, f"{landing}/studies/batch_date=*", trials.STUDY_COLUMNS)
        streaming.ingest_stream(stream, raw, checkpoint, "studies", "load-1", AT).awaitTermination()
        return spark.read.parquet(raw)

    land(landing, ["2026-01-01"])
    assert run().count() == 3
    assert run().count() == 3
    land(landing, ["2026-01-15", "2026-02-15"])
    rows = run().collect()
    assert len(rows) == 5
    assert {r.batch_date for r in rows} == {"2026-01-01", "2026-01-15", "2026-02-15"}
    assert {len(r.record_hash) for r in rows} == {64}
    assert {r.study_id for r in rows if r.batch_date == "2026-01-15"} == {STUDIES["2026-01-15"][0].split(",")[0]}


def _write(spark, path, rows):
    spark.createDataFrame(rows, "id string, ts long, v string").coalesce(1).write.mode("append").parquet(path)


def test_upserts_survive_replays_and_late_rows(spark, tmp_path):
    landing, root, checkpoint = str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "checkpoint")
    keys, order = ["id"], [F.col("ts").desc()]

    def run():
        stream = streaming.read_stream_parquet(spark, landing, spark.read.parquet(landing).schema, "*.parquet")
        streaming.upsert_stream(stream, root, checkpoint, keys, order).awaitTermination()
        return {r.id: r.v for r in streaming.read_current(spark, root, keys, order).collect()}

    _write(spark, landing, [("a", 1, "a1"), ("a", 2, "a2"), ("b", 1, "b1")])
    assert run() == {"a": "a2", "b": "b1"}
    _write(spark, landing, [("a", 0, "late"), ("b", 5, "b5"), ("c", 1, "c1")])
    expected = {"a": "a2", "b": "b5", "c": "c1"}
    assert run() == expected

    # the same files under a new checkpoint replay batch 0 and leave the table as it was
    stream = streaming.read_stream_parquet(spark, landing, spark.read.parquet(landing).schema, "*.parquet")
    streaming.upsert_stream(stream, root, checkpoint + "-2", keys, order).awaitTermination()
    assert {r.id: r.v for r in streaming.read_current(spark, root, keys, order).collect()} == expected

    streaming.compact(spark, root, keys, order, upto=1)
    assert {r.id: r.v for r in streaming.read_current(spark, root, keys, order, compacted_to=1).collect()} == expected
    _write(spark, landing, [("c", 9, "c9")])
    run()
    now = {**expected, "c": "c9"}
    assert {r.id: r.v for r in streaming.read_current(spark, root, keys, order, compacted_to=1).collect()} == now
    streaming.compact(spark, root, keys, order, upto=2, compacted_to=1)
    assert {r.id: r.v for r in streaming.read_current(spark, root, keys, order, compacted_to=2).collect()} == now


def test_deleted_keys_stay_deleted(spark, tmp_path):
    landing, root, checkpoint = str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "checkpoint")
    keys, order, gone = ["id"], [F.col("ts").desc()], F.col("v") == "delete"

    def run(compacted_to=None):
        stream = streaming.read_stream_parquet(spark, landing, spark.read.parquet(landing).schema, "*.parquet", 1)
        streaming.upsert_stream(stream, root, checkpoint, keys, order).awaitTermination()
        return {r.id: r.v for r in streaming.read_current(spark, root, keys, order, compacted_to, gone).collect()}

    _write(spark, landing, [("a", 5, "delete"), ("b", 1, "b1"), ("c", 1, None)])
    assert run() == {"b": "b1", "c": None}
    streaming.compact(spark, root, keys, order, upto=0)
    _write(spark, landing, [("a", 2, "late"), ("b", 2, "delete")])
    assert run(compacted_to=0) == {"c": None}
    _write(spark, landing, [("a", 6, "back")])
    assert run(compacted_to=0) == {"a": "back", "c": None}
