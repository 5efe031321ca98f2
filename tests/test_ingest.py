from datetime import datetime

from pyspark.sql import functions as F

from tallyline import sources
from tallyline.plans import trials
from tests.fixtures import land

AT = datetime(2026, 3, 1)


def test_batches_are_read_as_text_with_lineage(spark, tmp_path):
    globs = land(tmp_path)
    counts = {}
    for name, (columns) in {
        "studies": trials.STUDY_COLUMNS,
        "contracts": trials.CONTRACT_COLUMNS,
        "invoices": trials.INVOICE_COLUMNS,
        "sponsors": trials.SPONSOR_COLUMNS,
    }.items():
        raw = sources.read_batch_csv(spark, globs[name], columns)
        assert raw.columns == list(columns)
        assert {t for _, t in raw.dtypes} == {"string"}
        assert sources.read_batch_csv(spark, globs[name]).columns == list(columns)
        loaded = sources.add_ingestion_metadata(raw, name, "load-1", AT)
        assert loaded.columns[-6:] == [
            "source_file_name", "batch_date", "source_system", "ingestion_timestamp", "load_id", "record_hash",
        ]
        rows = loaded.collect()
        counts[name] = len(rows)
        assert {len(r.record_hash) for r in rows} == {64}
        assert {r.batch_date for r in rows} == {"2026-01-01", "2026-01-15", "2026-02-01", "2026-02-15"}
        assert all(r.source_file_name.endswith(f"{name}.csv") for r in rows)
    assert counts == {"studies": 6, "contracts": 6, "invoices": 7, "sponsors": 6}


def test_lineage_of_rows_without_a_file(spark):
    df = spark.createDataFrame([("S1", "Study", None)], "study_id string, study_name string, protocol_no string")
    row = sources.add_ingestion_metadata(df, "sys", "load-2").first()
    assert (row.source_file_name, row.batch_date, row.source_system, row.load_id) == ("", "", "sys", "load-2")
    assert row.ingestion_timestamp is not None


def test_reloading_keeps_the_hash(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    first = sources.add_ingestion_metadata(df, "s", "1", AT).first().record_hash
    assert sources.add_ingestion_metadata(df, "s", "2", datetime(2027, 1, 1)).first().record_hash == first


def test_append_is_partitioned_by_batch(spark, tmp_path):
    df = spark.createDataFrame([("a", "2026-01-01"), ("b", "2026-01-15")], "x string, batch_date string")
    path = str(tmp_path / "raw")
    sources.append_raw(df, path)
    sources.append_raw(df, path)
    back = sources.read_table(spark, path)
    assert back.count() == 4
    plan = back.where("batch_date = '2026-01-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(batch_date" in plan


def test_versions_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    one = sources.write_version(spark.range(3), path, 1)
    two = sources.write_version(spark.read.parquet(one).where("id > 0"), path, 2)
    assert spark.read.parquet(two).count() == 2
    sources.write_version(spark.read.parquet(one).where("id > 0"), path, 2)
    assert spark.read.parquet(two).count() == 2
    sources.overwrite_table(spark.range(5), str(tmp_path / "o"))
    sources.overwrite_table(spark.range(2), str(tmp_path / "o"))
    assert sources.read_table(spark, str(tmp_path / "o")).count() == 2


def test_added_columns_are_merged_on_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(1,)], "a int").write.mode("append").parquet(path)
    spark.createDataFrame([(2, "x")], "a int, b string").write.mode("append").parquet(path)
    assert sorted(map(tuple, sources.read_table(spark, path).select("a", "b").collect())) == [(1, None), (2, "x")]


def test_json_and_labels(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a": 1, "b": "x"}\n{"a": null}\n')
    rows = sources.read_json(spark, str(tmp_path / "a.json"), ["a", "b"]).collect()
    assert sorted(map(tuple, rows), key=str) == [("1", "x"), (None, None)]
    (tmp_path / "l.csv").write_text("study_id,contract_id,expected_match\ns,c,TRUE\ns,d,FALSE\n")
    labels = sources.read_labels(spark, str(tmp_path / "l.csv"), ["study_id", "contract_id"])
    assert sorted(r.expected_match for r in labels.collect()) == [False, True]


def test_export_leaves_out_unchanged_rows(spark, tmp_path):
    df = spark.createDataFrame([("a", "insert"), ("b", "no_change"), ("c", "delete")], "id string, change_type string")
    path = sources.export_changes(df, str(tmp_path), "customer", "20260301", num_files=1)
    assert path == f"{tmp_path}/customer_delta/batch_id=20260301"
    assert len(list((tmp_path / "customer_delta" / "batch_id=20260301").glob("*.csv"))) == 1
    back = sources.read_batch_csv(spark, path, ["id", "change_type"])
    assert sorted(r.id for r in back.collect()) == ["a", "c"]
    sources.export_changes(df, str(tmp_path), "customer", "20260301")
    assert sources.read_batch_csv(spark, path).count() == 2


def test_staged_gives_the_same_rows(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    assert sources.staged(df).exceptAll(df).count() == 0


def test_staged_tables_are_dropped_together(spark):
    first, second = sources.staged(spark.range(5)), sources.staged(spark.range(7))
    assert (first.count(), second.count()) == (5, 7)
    folder = first.inputFiles()[0].rsplit("/", 2)[0]
    assert second.inputFiles()[0].startswith(folder)
    sources.drop_staged(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    assert not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
