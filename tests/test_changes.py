import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyline import functions as fn
from tallyline.operators import changes as cdc
from tallyline.operators import history as hist
from tallyline.sources import staged

T1, T2, T3 = datetime(2026, 1, 1), datetime(2026, 2, 1), datetime(2026, 3, 1)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "id string, part string, value string")
    return df.withColumn("record_hash", fn.record_hash(["value"]))


def rows_of(df):
    return sorted(map(str, map(tuple, df.select("id", "part", "value").collect())))


def snapshots(spark, seed):
    rng = random.Random(seed)
    return [
        staged(frame(spark, [(f"k{i}", str(i % 2), str(rng.randrange(2))) for i in range(30) if rng.random() < 0.7]))
        for _ in range(3)
    ]


def test_kinds_of_change(spark):
    source = spark.createDataFrame([("A", "1"), ("B", "2x"), ("D", "4")], "id string, record_hash string")
    target = spark.createDataFrame([("A", "1"), ("B", "2"), ("C", "3")], "id string, record_hash string")
    found = cdc.detect_changes(source, target, ["id"], detected_at=T1)
    assert {r.id: r.change_type for r in found.collect()} == {"A": "no_change", "B": "update", "C": "delete", "D": "insert"}
    assert {r.delta_business_key for r in found.collect()} == {"A", "B", "C", "D"}
    assert found.columns == ["id", "record_hash", "change_type", "delta_business_key", "delta_detected_at"]
    assert {r.delta_detected_at for r in found.collect()} == {T1}


def test_hash_is_made_where_it_is_absent(spark):
    old = spark.createDataFrame([("A", "x", 1), ("B", "y", 2)], "id string, v string, extra int")
    new = spark.createDataFrame([("A", "x"), ("B", "z")], "id string, v string")
    kinds = {r.id: r.change_type for r in cdc.detect_changes(new, old, ["id"]).collect()}
    assert kinds == {"A": "no_change", "B": "update"}


def test_composite_and_missing_keys(spark):
    source = frame(spark, [("a", "1", "x"), ("a", "2", "x"), (None, "1", "x")])
    target = frame(spark, [("a", "1", "x"), ("a", None, "x")])
    found = cdc.detect_changes(source, target, ["id", "part"])
    kinds = sorted((str(r.delta_business_key), r.change_type) for r in found.collect())
    assert kinds == [("a|", "no_change"), ("a|1", "no_change"), ("a|2", "insert"), ("|1", "no_change")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_applying_the_difference_gives_the_source(spark, seed):
    old, new, _ = snapshots(spark, seed)
    keys = ["id", "part"]
    found = staged(cdc.detect_changes(new, old, keys))
    applied = cdc.apply_changes(old, found, keys)
    assert rows_of(applied) == rows_of(new)
    assert rows_of(cdc.apply_changes(applied, found, keys)) == rows_of(new)
    assert cdc.change_set(cdc.detect_changes(new, new, keys)).count() == 0


def test_upsert_updates_inserts_and_never_deletes(spark):
    current = frame(spark, [("a", "1", "x"), ("b", "1", "y"), (None, "1", "n")])
    incoming = frame(spark, [("b", "1", "z"), ("c", "1", "w")])
    merged = cdc.upsert(current, incoming, ["id", "part"])
    assert rows_of(merged) == sorted(map(str, [("a", "1", "x"), ("b", "1", "z"), ("c", "1", "w"), (None, "1", "n")]))
    assert rows_of(cdc.upsert(merged, incoming, ["id", "part"])) == rows_of(merged)


def test_small_change_sets_do_not_shuffle_the_current_table(spark):
    current = spark.range(100000).selectExpr("CAST(id AS STRING) AS id", "'1' AS part", "'x' AS value", "'h' AS record_hash")
    changes = cdc.detect_changes(frame(spark, [("1", "1", "y")]), frame(spark, [("1", "1", "z")]), ["id", "part"])
    applied = cdc.apply_changes(current, staged(changes), ["id", "part"])
    assert applied.count() == 100000
    assert "SortMergeJoin" not in applied._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_history_step_by_step_and_rebuilt_agree(spark, seed):
    keys = ["id", "part"]
    a, b, c = snapshots(spark, seed)
    rows = hist.open_history(a, T1)
    rows = hist.apply_scd2(rows, staged(cdc.detect_changes(b, a, keys)), keys, T2)
    rows = staged(hist.apply_scd2(staged(rows), staged(cdc.detect_changes(c, b, keys)), keys, T3))
    rebuilt = hist.history_from_snapshots([(T1, a), (T2, b), (T3, c)], keys)
    columns = [*keys, "value", "record_hash", "effective_from_ts", "effective_to_ts", "is_current"]
    assert sorted(map(str, rows.select(*columns).collect())) == sorted(map(str, rebuilt.select(*columns).collect()))
    assert rows.where("is_current").groupBy(*keys).count().where("count > 1").count() == 0
    assert rows_of(rows.where("is_current")) == rows_of(c)
    closed = rows.where("NOT is_current")
    assert closed.where("effective_to_ts IS NULL OR effective_to_ts <= effective_from_ts").count() == 0
    overlap = rows.alias("x").join(rows.alias("y"), keys).where(
        "x.effective_from_ts < y.effective_from_ts AND coalesce(x.effective_to_ts, TIMESTAMP'9999-01-01') > y.effective_from_ts"
    )
    assert overlap.count() == 0


def test_insert_of_an_open_key_changes_nothing(spark):
    open_rows = hist.open_history(frame(spark, [("a", "1", "x")]), T1)
    changes = frame(spark, [("a", "1", "y")]).withColumn("change_type", F.lit("insert"))
    after = hist.advance_history(open_rows, changes, ["id", "part"], T2).collect()
    assert [(r.value, r.is_current) for r in after] == [("x", True)]
    updates = changes.withColumn("change_type", F.lit("update"))
    again = hist.advance_history(open_rows.where("false"), updates, ["id", "part"], T2).collect()
    assert [(r.value, r.is_current, r.effective_from_ts) for r in again] == [("y", True, T2)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_late_changes_in_any_order_give_the_history_of_the_ordered_ones(spark, seed):
    rng = random.Random(seed)
    moments = [datetime(2026, 1, d) for d in range(1, 20)]
    changes = [(f"k{rng.randrange(6)}", rng.choice("xyz-"), at) for at in moments for _ in range(3)]
    changes = list({(k, at): (k, v, at) for k, v, at in changes}.values())  # one change of a key a moment

    def ordered(rows):
        out = []
        for k in sorted({r[0] for r in rows}):
            state, since = None, None
            for _, v, at in sorted((r for r in rows if r[0] == k), key=lambda r: r[2]):
                v = None if v == "-" else v
                if v != state:
                    if state is not None:
                        out.append((k, state, since, at, False))
                    state, since = v, at
            if state is not None:
                out.append((k, state, since, None, True))
        return sorted(out, key=str)

    rng.shuffle(changes)
    log = spark.createDataFrame([], "id string, value string, at timestamp").withColumn("record_hash", fn.record_hash(["value"]))
    history = hist.history_from_changes(log, ["id"], "at")
    shown = ["id", "value", hist.FROM, hist.TO, hist.CURRENT]
    for n in range(0, len(changes), 14):
        late = spark.createDataFrame(changes[n : n + 14], "id string, value string, at timestamp").withColumn("record_hash", fn.record_hash(["value"]))
        history = staged(hist.splice_late(history, log, late, ["id"], "at", deleted="value = '-'"))
        log = staged(log.unionByName(late))
        assert sorted(map(tuple, history.select(*shown).collect()), key=str) == ordered(changes[: n + 14]), n
    again = hist.splice_late(history, log, late, ["id"], "at", deleted="value = '-'")
    assert sorted(map(tuple, again.select(*shown).collect()), key=str) == ordered(changes)


def test_late_changes_touch_their_keys_only(spark):
    rows = frame(spark, [("a", "1", "x"), ("b", "1", "y"), (None, "1", "z")]).withColumn("at", F.lit(T2))
    history = hist.open_history(rows.drop("at"), T2)
    late = frame(spark, [("a", "1", "w")]).withColumn("at", F.lit(T1))
    found = hist.splice_late(history, rows, late, ["id", "part"], "at")
    assert found.columns == history.columns
    assert sorted(map(str, ((r.id, r.value, r[hist.FROM], r[hist.TO], r[hist.CURRENT]) for r in found.collect()))) == sorted(
        map(str, [("a", "w", T1, T2, False), ("a", "x", T2, None, True), ("b", "y", T2, None, True), (None, "z", T2, None, True)])
    )
