import random
from datetime import datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyline import sources
from tallyline.functions import similarity
from tallyline.operators import metrics
from tallyline.operators.joins import prefixed
from tallyline.operators.match import Dimension, MatchSpec, best_match, near_names, score_pairs, similar_tuples, similar_values
from tallyline.plans import trials
from tests.fixtures import FEEDS, LABELS, land

SPEC = MatchSpec(
    ["sp", "pr", "study"],
    [Dimension("sponsor", "sname", 0.45, "sp"), Dimension("study", "study", 0.25), Dimension("contract", "contract", 0.30)],
)


def _random_rows(rng, n, name):
    word = lambda k: "".join(rng.choice("AB1") for _ in range(rng.randint(0, k)))
    return [
        (f"{name}{i // 2}", rng.choice(["", None, "a", "b", "c"]), rng.choice(["", "p", "q", str(i)]), word(5), word(3), i)
        for i in range(n)
    ]


@pytest.mark.parametrize("seed,block", [(1, 3), (2, 1), (3, 2048)])
def test_best_match_equals_scoring_every_pair(spark, seed, block):
    rng = random.Random(seed)
    left = spark.createDataFrame(_random_rows(rng, 50, "l"), "lid string, sp string, pr string, study string, contract string, n long").drop("n")
    right = spark.createDataFrame(_random_rows(rng, 40, "r"), "rid string, sp string, pr string, study string, contract string, seq long")
    got = best_match(left, right, SPEC, "lid", [-F.col("seq")], block_size=block)
    pairs = prefixed(left, "l_").crossJoin(prefixed(right, "r_"))
    by_all = score_pairs(pairs, SPEC).withColumn(
        "rn",
        F.row_number().over(
            Window.partitionBy("l_lid").orderBy(
                "match_level", F.desc("overall_match_confidence"), F.desc("scored_dims"), F.desc("r_seq")
            )
        ),
    )
    columns = ["l_lid", "r_rid", "r_seq", "match_level", "overall_match_confidence", "scored_dims"]
    expected = sorted(map(tuple, by_all.where("rn = 1").select(*columns).collect()))
    assert sorted(map(tuple, got.select(*columns).collect())) == expected


FUZZY = MatchSpec(["sp", "pr"], [Dimension("sponsor", "sname", 0.45, "sp"), Dimension("study", "study", 0.25), Dimension("contract", "contract", 0.30)], [("sname", 0.8), ("contract", 0.75)])


@pytest.mark.parametrize("seed", [1])
def test_fuzzy_candidates_without_a_key_equal_scoring_every_pair(spark, seed):
    rng = random.Random(seed)

    def rows(n, name):
        word = lambda k: "".join(rng.choice("AB") for _ in range(rng.randint(0, k)))
        return [(f"{name}{i // 2}", rng.choice(["", None, "a", str(i)]), rng.choice(["", "p", None, f"{name}{i}"]), word(8), rng.choice(["", "S", "T"]), word(6)) for i in range(n)]

    schema = "sp string, pr string, sname string, study string, contract string"
    left = spark.createDataFrame(rows(60, "l"), f"lid string, {schema}")
    right = spark.createDataFrame(rows(50, "r"), f"rid string, {schema}").withColumn("seq", F.monotonically_increasing_id())
    left, right = sources.staged(left), sources.staged(right)
    got = best_match(left, right, FUZZY, "lid", [F.col("seq")], stage=sources.staged)
    by_all = score_pairs(prefixed(left, "l_").crossJoin(prefixed(right, "r_")), FUZZY)
    order = Window.partitionBy("l_lid").orderBy("match_level", F.desc("overall_match_confidence"), F.desc("scored_dims"), "r_seq")
    columns = ["l_lid", "r_rid", "r_seq", "match_level", "overall_match_confidence", "scored_dims"]
    expected = sorted(map(tuple, by_all.withColumn("rn", F.row_number().over(order)).where("rn = 1").select(*columns).collect()))
    found = sorted(map(tuple, got.select(*columns).collect()))
    assert found == expected
    assert {1, 2, 3} <= {r[3] for r in found}


@pytest.mark.parametrize("least", [(0.75, 0.75), (0.9, 0.8)])
def test_similar_tuples_miss_nothing(spark, least):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("ABé") for _ in range(rng.randint(0, 9)))
    hot = "THE SAME SPONSOR"
    left = [(rng.choice([hot, word()]), word()) for _ in range(120)] + [(hot, None), (None, "A")]
    right = [(rng.choice([hot, hot[:-1], word()]), word()) for _ in range(120)] + [(a, (b or "") + "A") for a, b in left[:40]]
    left, right = (spark.createDataFrame(x, "a string, b string") for x in (left, right))
    names = ["l_0", "l_1", "r_0", "r_1", "similarity_0", "similarity_1"]
    got = similar_tuples(left, right, least)
    assert got.columns == names
    filled = "a <> '' AND b <> ''"
    every = left.where(filled).distinct().toDF("l_0", "l_1").crossJoin(right.where(filled).distinct().toDF("r_0", "r_1"))
    every = every.select("*", similarity("l_0", "r_0").alias("similarity_0"), similarity("l_1", "r_1").alias("similarity_1"))
    every = every.where((F.col("similarity_0") >= least[0]) & (F.col("similarity_1") >= least[1]))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, every.select(*names).collect())) != []
    with pytest.raises(ValueError):
        similar_tuples(left, right, (0.9, 0.5))


def test_best_match_without_a_nested_loop(spark):
    left = spark.createDataFrame([("l", "a", "p", "S")], "lid string, sp string, pr string, study string")
    right = spark.createDataFrame([("r", "a", "p", "S")], "rid string, sp string, pr string, study string")
    plan = best_match(left, right, SPEC, "lid", [F.col("rid")])._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan


def test_levels_and_fuzzy_rule(spark):
    pairs = spark.createDataFrame(
        [
            ("S1", "S1", "ACME BIO", "OTHER", "C1", "X"),
            ("S1", "S2", "ACME BIOPHARMA", "ACME BIOPHARMB", "MASTER 1", "MASTER 2"),
            ("S1", "S2", "ACME BIOPHARMA", "NORTHWIND", "MASTER 1", "MASTER 2"),
            ("", "", "", "", "K", "K"),
            ("", "", "", "", "", ""),
        ],
        "l_sponsor_external_id_std string, r_sponsor_external_id_std string, l_sponsor_name_std string, "
        "r_sponsor_name_std string, l_contract_name_std string, r_contract_name_std string",
    )
    rows = score_pairs(pairs, trials.MATCHING).collect()
    assert sorted(r.match_level for r in rows) == [1, 3, 5]
    first = [r for r in rows if r.match_level == 1][0]
    assert first.sponsor_match_score == 1.0 and first.study_match_score is None
    # compared as empty strings, two blank names count as equal
    assert score_pairs(pairs, trials.MATCHING, compare_blanks=True).where("match_level = 5").count() == 2


@pytest.mark.parametrize("least", [0.75, 0.85, 0.95])
def test_similar_values_misses_nothing(spark, least):
    rng = random.Random(int(least * 100))
    words = ["".join(rng.choice("ABC") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    near = [w[:-1] + rng.choice("ABX") if w else w for w in words] + [w + "A" for w in words] + ["", "é" * 6]
    left = spark.createDataFrame([(w,) for w in words + ["é" * 5 + "e"]], "a string")
    right = spark.createDataFrame([(w,) for w in near], "b string")
    got = sorted(map(tuple, similar_values(left, right, least).collect()))
    every = left.distinct().crossJoin(right.where("b <> ''").distinct()).select("a", "b", similarity("a", "b").alias("s"))
    assert got == sorted(map(tuple, every.where(F.col("s") >= least).collect()))


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    globs = land(tmp_path_factory.mktemp("landing"))
    return {
        name: sources.add_ingestion_metadata(
            sources.read_batch_csv(spark, globs[name], columns), name, "load-1", datetime(2026, 3, 1)
        )
        for name, (_, columns) in FEEDS.items()
    }


@pytest.fixture(scope="module")
def crosswalk(raw):
    return sources.staged(
        trials.study_contract_crosswalk(raw["studies"], raw["contracts"], raw["invoices"], sources.staged)
    )


def test_best_contracts(crosswalk):
    best = {r.study_id: (r.contract_id, r.sponsor_external_id, r.overall_match_confidence) for r in crosswalk.collect()}
    assert best == {
        "STUDY-1001": ("CNT-9004", "SPN-001", 1.0),
        "STUDY-2200": ("CNT-9002", "SPN-002", 1.0),
        "STUDY-3300": ("CNT-9003", "SPN-003", 1.0),
        "STUDY-4400": ("CNT-9004", "SPN-001", 0.75),
        "STUDY-5500": ("CNT-9010", "SPN-004", 1.0),
    }


def test_linked_invoices(crosswalk):
    linked = {}
    for r in crosswalk.collect():
        linked.setdefault(r.study_id, []).append(r.invoice_id)
    assert {k: sorted(v) for k, v in linked.items()} == {
        "STUDY-1001": ["INV-0001", "INV-0004"],
        "STUDY-2200": ["INV-0002"],
        "STUDY-3300": ["INV-0003", "INV-0005"],
        "STUDY-4400": ["INV-0001", "INV-0004"],
        "STUDY-5500": ["INV-0006"],
    }


def test_labelled_accuracy(spark, crosswalk):
    labels = spark.createDataFrame(LABELS, "study_id string, contract_id string, expected_match string")
    labels = labels.withColumn("expected_match", F.col("expected_match") == "TRUE")
    scored = metrics.score_labels(labels, crosswalk, ["study_id", "contract_id"])
    assert scored.count() == 40
    rates = metrics.labelled_accuracy(scored, threshold=trials.CONFIDENT).first()
    assert (rates.accuracy, rates.precision, rates.recall, rates.f1) == (1.0, 1.0, 1.0, 1.0)
    assert metrics.labelled_accuracy(scored.where("false")).first().accuracy == 0.0


def test_sponsor_and_entity_crosswalk(raw, crosswalk):
    sponsors = trials.sponsor_crosswalk(raw["sponsors"], [raw["studies"], raw["contracts"], raw["invoices"]])
    rows = {r.source_sponsor_external_id: (r.master_sponsor_external_id, r.billing_account_id, r.match_level) for r in sponsors.collect()}
    assert rows == {f"SPN-00{i}": (f"SPN-00{i}", f"BA-{i}001", 1) for i in range(1, 5)}
    entities = trials.entity_crosswalk(sponsors, crosswalk)
    assert entities.count() == 8
    assert {r.overall_match_confidence for r in entities.collect()} == {1.0}
    assert {(r.sponsor_external_id, r.master_sponsor_external_id) for r in entities.collect()} == {
        (f"SPN-00{i}", f"SPN-00{i}") for i in range(1, 5)
    }


def test_sponsors_found_by_name(spark, raw):
    feed = spark.createDataFrame(
        [("X1", "Acme Biopharme"), ("X2", "Somebody Else"), ("SPN 002", "whatever"), ("", "RareCure Biotech ")],
        "sponsor_external_id string, sponsor_name string",
    )
    rows = {r.source_sponsor_external_id: (r.master_sponsor_external_id, r.match_level, r.sponsor_match_score) for r in trials.sponsor_crosswalk(raw["sponsors"], [feed]).collect()}
    assert rows == {"X1": ("SPN-001", 5, 0.9286), "SPN 002": ("SPN-002", 1, 1.0), "": ("SPN-004", 5, 1.0)}


def test_a_right_row_without_a_name_saves_comparing_the_names_of_its_key(spark):
    """It scores by its key alone, which no unequal name can beat, so no left row is left to be compared."""
    left = spark.createDataFrame([(f"L{i}", "s", f"STUDY {i}", f"extra {i}") for i in range(12)], "lid string, sp string, study string, more string")
    rows = [(f"R{i}", "s", f"STDY {i}") for i in range(12)] + [("R3", "s", "STUDY 3"), ("none-b", "s", ""), ("none-a", "s", None)]
    right = spark.createDataFrame(rows, "rid string, sp string, study string")
    spec = MatchSpec(["sp", "study"], [Dimension("sponsor", "sname", 0.45, "sp"), Dimension("study", "study", 0.25)])
    stored = []

    def stage(df):
        stored.append(sources.staged(df))
        return stored[-1]

    got = best_match(left, right, spec, "lid", [F.col("rid")], stage=stage, shown=(["lid"], ["rid"])).collect()
    assert {(r.l_lid, r.r_rid, r.scored_dims) for r in got} == {(f"L{i}", "none-a" if i != 3 else "R3", 1 if i != 3 else 2) for i in range(12)}
    assert "l_more" not in got[0].asDict() and "r_study" not in got[0].asDict()
    states = [r._state for df in stored if "_hit" in df.columns for r in df.select("_hit._state").collect()]
    assert states and set(states) == {0, 1}


def test_rows_that_a_level_meets_ask_no_later_level(spark):
    left = spark.createDataFrame([("A", "s1", "p1", "X 1"), ("B", None, "p2", "X 2"), ("C", "s9", "p9", "X 3"), ("D", "", None, "X 4")], "lid string, sp string, pr string, study string")
    right = spark.createDataFrame([("1", "s1", "p2", "Y"), ("2", "s2", "p1", "X 1"), ("3", "s3", "p3", "X 3"), ("3", "s3", "p3", "X 3")], "rid string, sp string, pr string, study string")
    for stage in (None, sources.staged):
        got = best_match(left, right, SPEC, "lid", [F.col("rid")], stage=stage)
        assert sorted((r.l_lid, r.r_rid, r.match_level) for r in got.collect()) == [("A", "1", 1), ("B", "1", 2), ("C", "3", 3)]


def test_a_crowded_key_is_not_compared_name_by_name(spark):
    rng = random.Random(5)
    word = lambda k: "".join(rng.choice("ABé1") for _ in range(k))
    rights = [f"STUDY MEDIUM {10 ** 6 + 37 * i}" for i in range(600)] + [word(rng.randint(1, 7)) for _ in range(60)]
    near = [x.replace("U", "", 1) for x in rights[:200]] + [x + "77" for x in rights[200:260]] + [word(rng.randint(1, 7)) for _ in range(60)]
    lefts = [*near, "SOMETHING ELSE", "", None]
    left = sources.staged(spark.createDataFrame([(f"l{i}", "a", x) for i, x in enumerate(lefts)], "lid string, sp string, study string"))
    right = sources.staged(spark.createDataFrame([(f"r{i}", "a", x, i % 7) for i, x in enumerate(rights)], "rid string, sp string, study string, seq long"))
    put = []
    got = best_match(left, right, SPEC, "lid", [F.col("seq"), F.col("rid")], block_size=64, stage=lambda df: put.append(sources.staged(df)) or put[-1])
    by_all = score_pairs(prefixed(left, "l_").crossJoin(prefixed(right, "r_")), SPEC)
    order = Window.partitionBy("l_lid").orderBy("match_level", F.desc("overall_match_confidence"), F.desc("scored_dims"), "r_seq", "r_rid")
    columns = ["l_lid", "r_rid", "match_level", "overall_match_confidence", "scored_dims"]
    expected = sorted(map(tuple, by_all.withColumn("rn", F.row_number().over(order)).where("rn = 1").select(*columns).collect()))
    assert sorted(map(tuple, got.select(*columns).collect())) == expected
    # names within two edits are found by what is left of them; only the others are compared with all
    compared = [x for x in put if "_asked" in x.columns and "_n_study" in x.columns and "_right" not in x.columns]
    assert compared and compared[-1].where("_n_study like 'ST%'").count() == 0


@pytest.mark.parametrize("edits", [1, 2])
def test_near_names_miss_nothing(spark, edits):
    rng = random.Random(edits)
    word = lambda: "".join(rng.choice("ABé") for _ in range(rng.randint(0, 6)))
    left, right = (spark.createDataFrame([(rng.choice("xy"), word()) for _ in range(100)], "k string, n string").distinct() for _ in range(2))
    got = near_names(left, right, ["k"], "n", edits).distinct()
    every = left.join(right.withColumnRenamed("n", "_near"), "k").where(f"n <> '' AND _near <> '' AND levenshtein(n, _near) <= {edits}")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, every.select("k", "n", "_near").collect())) != []
