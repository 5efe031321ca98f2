from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyline.sources import Limit, completeness_limits, completeness_measures, gated_write, measured, published, read_audit, read_published

T1, T2, T3 = datetime(2026, 1, 1), datetime(2026, 2, 1), datetime(2026, 3, 1)
COLUMNS = ["id", "name"]
LIMITS = completeness_limits("people", COLUMNS)


def frame(spark, n, blanks):
    rows = [(str(i), " " if i < blanks else f"n{i}") for i in range(n)]
    return spark.createDataFrame(rows, "id string, name string").repartition(5)


def test_a_batch_below_the_limit_is_written_but_held(spark, tmp_path):
    root = str(tmp_path / "t")

    def write(version, df, at):
        return gated_write(df, root, version, "people", completeness_measures(COLUMNS), LIMITS, at)

    assert published(spark, root) is None
    with pytest.raises(LookupError):
        read_published(spark, root)
    audit = write("1", frame(spark, 100, 2), T1)
    assert sorted((r.metric_name, r.metric_value, r.passed) for r in audit.collect()) == [("completeness_id", 1.0, True), ("completeness_name", 0.98, True)]
    assert published(spark, root) == "1"

    audit = write("2", frame(spark, 100, 3), T2)
    assert [r.reason for r in audit.where("NOT passed").collect()] == ["people.completeness_name is 0.97, below 0.98"]
    assert spark.read.parquet(f"{root}/version=2").count() == 100  # it is there
    assert published(spark, root) == "1" and read_published(spark, root).where("name = ' '").count() == 2

    write("3", frame(spark, 50, 0), T3)
    assert published(spark, root) == "3" and read_published(spark, root).count() == 50
    # mended and audited again, an older batch is published but not the newest; spoilt, it is held again
    write("2", frame(spark, 100, 0), T2)
    assert published(spark, root) == "3" and read_audit(spark, root, "2").where("passed").count() == 2
    write("3", frame(spark, 50, 9), T3)
    assert published(spark, root) == "2"


def test_limits_on_either_side_and_measures_not_taken(spark, tmp_path):
    df = frame(spark, 10, 0)
    limits = [Limit("g", "rows", 5, 9), Limit("g", "absent", 1), Limit("g", "empty_avg", 1)]
    measures = {"rows": F.count("*"), "empty_avg": F.avg(F.when(F.col("id") == "none", 1.0))}
    audit = gated_write(df, str(tmp_path / "t"), "1", "g", measures, limits, T1)
    found = {r.metric_name: (r.passed, r.reason) for r in audit.collect()}
    assert found == {"rows": (False, "g.rows is 10.0, above 9.0"), "absent": (False, "not measured"), "empty_avg": (True, None)}
    assert published(spark, str(tmp_path / "t")) is None


def test_measures_are_taken_in_the_pass_that_writes(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = frame(spark, 40, 4).mapInArrow(count, "id string, name string")
    rows = measured(df, completeness_measures(["name"]), lambda x: x.write.parquet(str(tmp_path / "t")), "people")
    assert [tuple(r) for r in rows.collect()] == [("people", "completeness_name", 0.9)]
    assert seen.value == 40


def test_an_empty_table(spark, tmp_path):
    gated_write(frame(spark, 0, 0), str(tmp_path / "t"), "1", "people", completeness_measures(COLUMNS), LIMITS, T1)
    assert published(spark, str(tmp_path / "t")) == "1"
