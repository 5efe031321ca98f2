import random

import pytest
from pyspark.sql import functions as F

from tallyline.operators.joins import any_key_join, link_on_keys, prefixed, priority_join
from tallyline.operators.skew import hot_keys, skew_join


def bag(df):
    columns = sorted(df.columns)
    return sorted(str(tuple(r)) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(7)
    left = [(i, None if i % 5 == 0 else "hot" if i % 3 == 0 else f"k{rng.randrange(300)}") for i in range(3000)]
    right = [("hot", "H"), (None, "N")] + [(f"k{i}", f"v{i}") for i in range(0, 300, 2)]
    return spark.createDataFrame(left, "id long, k string"), spark.createDataFrame(right, "k string, v string")


def test_hot_keys_are_found_and_few(skewed):
    left, _ = skewed
    expected = left.where("k = 'hot'").select(F.xxhash64("k").alias("_hot")).distinct()
    found = hot_keys(left, ["k"], partitions=16)
    assert bag(found.select("_hot")) == bag(expected)
    assert [r._parts for r in found.collect()] == [11]  # twice 16 parts for a third of the rows that have a key


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot", [None, False])
def test_skew_join_equals_the_plain_join(skewed, how, hot):
    left, right = skewed
    assert bag(skew_join(left, right, ["k"], how, hot=hot)) == bag(left.join(right, "k", how))


def test_skew_join_with_a_repeated_right_side(spark, skewed):
    left, right = skewed
    twice = right.unionByName(right)
    assert bag(skew_join(left, twice, ["k"])) == bag(left.join(twice, "k"))


def test_keys_hot_on_both_sides(spark, skewed):
    left, right = skewed
    many = right.unionByName(spark.range(200).selectExpr("'hot' AS k", "CAST(id AS STRING) AS v"))
    cut = hot_keys(left, ["k"], 16), hot_keys(many, ["k"], 16)
    assert bag(skew_join(left, many, ["k"], hot=cut[0], hot_right=cut[1])) == bag(left.join(many, "k"))
    assert bag(skew_join(left, many, ["k"], hot=False, hot_right=True)) == bag(left.join(many, "k"))


def test_skew_join_spreads_the_hot_key(spark, skewed):
    left, right = skewed
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = skew_join(left, right, ["k"]).where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
        plain = left.join(right, "k").where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plain == 1 and parts > 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("columns", ["k", "k, id % 3 AS c", "k, id"])
@pytest.mark.parametrize("value", ["'hot'", "CAST(NULL AS STRING)"])
def test_equal_rows_of_a_hot_or_missing_key_are_spread(spark, how, columns, value):
    if value != "'hot'" and how in ("inner", "left_semi"):
        pytest.skip("rows without a key are dropped before the join")
    parts, rows = 16, 20_000
    key = f"CASE WHEN id % 10 = 0 THEN concat('k', id % 500) ELSE {value} END AS k"
    left = spark.range(0, rows, 1, 8).selectExpr(key, "id").selectExpr(*columns.split(", "))
    right = spark.createDataFrame([("none",), ("other",)] + ([("hot",)] if how != "left_anti" else []), "k string")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": str(parts)}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, v in settings.items():
            spark.conf.set(name, v)
        joined = skew_join(left, right, ["k"], how)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        whole = left.join(right, "k", how).count()
    finally:
        for name, v in before.items():
            spark.conf.set(name, v)
    assert sum(sizes) == whole
    assert max(sizes) <= 2.5 * rows / parts  # parts meet in tasks by chance


@pytest.fixture(scope="module")
def feeds(spark):
    rng = random.Random(3)
    pick = lambda *xs: rng.choice(xs)
    left = [(i, pick("", None, "a", "b"), pick(None, "p", "q", "r"), pick("x", "y", "")) for i in range(40)]
    right = [(100 + i, pick("", "a", "b", "c"), pick(None, "p", "q", ""), pick("x", "y", "z")) for i in range(30)]
    return (
        spark.createDataFrame(left, "lid long, k1 string, k2 string, w string"),
        spark.createDataFrame(right, "rid long, k1 string, k2 string, w string"),
    )


def _or_join(left, right, within, how):
    eq = lambda c: (F.col(f"l_{c}") == F.col(f"r_{c}")) & (F.trim(f"l_{c}") != "")
    condition = eq("k1") | eq("k2")
    for c in within:
        condition = condition & eq(c)
    return prefixed(left, "l_").join(prefixed(right, "r_"), condition, how)


@pytest.mark.parametrize("within", [[], ["w"]])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_any_key_join_equals_the_or_join(feeds, within, how):
    left, right = feeds
    got = any_key_join(left, right, ["k1", "k2"], within, left_id="lid", how=how)
    assert bag(got) == bag(_or_join(left, right, within, how))


def test_any_key_join_has_no_nested_loop(feeds):
    left, right = feeds
    plan = any_key_join(left, right, ["k1", "k2"])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_priority_join_prefers_the_first_key(spark):
    left = spark.createDataFrame([(1, "a", "p"), (2, "zz", "p"), (3, None, None), (4, "b", "q")], "id long, k1 string, k2 string")
    right = spark.createDataFrame(
        [("a", "x", "A2"), ("a", "x", "A1"), (None, "p", "P1"), ("b", None, None), (None, "q", "Q")],
        "k1 string, k2 string, v string",
    )
    got = priority_join(left, right, ["k1", "k2"], [F.col("v")], ["v"])
    assert sorted((r.id, r.v) for r in got.collect()) == [(1, "A1"), (2, "P1"), (3, None), (4, None)]


def test_link_on_keys_renames_shared_columns(spark):
    studies = spark.createDataFrame([("P", "S", "study"), ("Q", "S", "other")], "p string, s string, name string")
    contracts = spark.createDataFrame([("P", "S", "c1"), ("P", "S", "c2")], "p string, s string, name string")
    got = link_on_keys(studies, contracts, ["p", "s"])
    assert got.columns == ["p", "s", "name", "name_right"]
    assert sorted(map(str, (r.name_right for r in got.collect()))) == ["None", "c1", "c2"]


def test_the_last_key_is_not_carried_through_the_join(spark):
    """A pair that meets on the last key is judged by the keys before it; the last one is needed only where it is asked for."""
    left = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (3, None, "y")], "id int, code string, name string")
    right = spark.createDataFrame([(10, "a", "x"), (20, None, "y"), (30, "b", "x")], "rid int, code string, name string")
    pairs = any_key_join(left, right, ["code", "name"]).select("l_id", "r_rid")
    assert sorted(map(tuple, pairs.collect())) == [(1, 10), (1, 30), (2, 30), (3, 20)]
    joined = [x for x in pairs._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter NOT" in x or "Join Inner" in x]
    assert joined and not any("r_name" in x for x in joined)
