import pytest

from tallyline.operators.hierarchy import roll_up


def test_totals_over_all_levels(spark):
    values = spark.createDataFrame([("a1", 1.0), ("a1", 2.5), ("a2", 4.0), ("a", 10.0), ("lone", 3.0), (None, 9.0), ("a2", None)], "node string, amount double")
    parents = spark.createDataFrame([("a1", "a"), ("a2", "a"), ("a", "top"), ("unused", "top"), ("top", None)], "node string, parent string")
    found = {r.node: (float(r.amount), r.members) for r in roll_up(values, parents).collect()}
    assert found == {"a1": (3.5, 1), "a2": (4.0, 1), "a": (17.5, 3), "top": (17.5, 3), "lone": (3.0, 1)}
    assert roll_up(values.where("false"), parents).count() == 0


def test_a_cycle_is_reported(spark):
    values = spark.createDataFrame([("x", 1.0)], "node string, amount double")
    parents = spark.createDataFrame([("x", "y"), ("y", "x")], "node string, parent string")
    with pytest.raises(ValueError):
        roll_up(values, parents, max_depth=5)
