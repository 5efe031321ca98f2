from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyline import sources
from tallyline.operators import quality
from tallyline.operators.conform import conform, normalize_join_keys, split
from tallyline.operators.dedupe import deduplicate_by_key
from tallyline.plans import trials
from tests.fixtures import FEEDS, land


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    globs = land(tmp_path_factory.mktemp("landing"))
    return {
        name: sources.add_ingestion_metadata(
            sources.read_batch_csv(spark, globs[name], columns), name, "load-1", datetime(2026, 3, 1)
        )
        for name, (_, columns) in FEEDS.items()
    }


def test_study_goldens(raw):
    valid, rejected = trials.transform("study", raw["studies"])
    assert valid.count() == 4
    assert [(r.study_id, r.invalid_reason) for r in rejected.collect()] == [("STUDY-4400", "protocol_no_required")]


def test_contract_goldens(raw):
    valid, rejected = trials.transform("contract", raw["contracts"])
    total = valid.agg(F.sum("contract_value_std")).first()[0]
    assert (valid.count(), rejected.count(), total) == (4, 0, 2550000.0)
    kept = {r.contract_id: r.contract_value_std for r in valid.collect()}
    assert kept == {"CNT-9004": 785000.0, "CNT-9002": 540000.0, "CNT-9003": 315000.0, "CNT-9010": 910000.0}


def test_invoice_sponsor_and_site_goldens(raw):
    invoices, rejected = trials.transform("invoice", raw["invoices"])
    sums = invoices.agg(F.sum("invoice_amount_std"), F.sum("paid_amount_std"), F.sum("outstanding_amount_std")).first()
    assert (invoices.count(), rejected.count()) == (6, 0)
    assert tuple(sums) == (345000.0, 160000.0, 185000.0)
    assert trials.transform("sponsor", raw["sponsors"])[0].count() == 4
    assert trials.transform("site", raw["studies"])[0].count() == 5


def test_valid_and_rejected_make_up_the_deduplicated_input(raw):
    for entity, feed in {"study": "studies", "contract": "contracts", "invoice": "invoices", "sponsor": "sponsors", "site": "studies"}.items():
        whole = conform(raw[feed], trials.ENTITIES[entity])
        valid, rejected = split(whole)
        assert valid.unionByName(rejected).exceptAll(whole).count() == 0
        assert whole.count() == whole.select("business_key").distinct().count()


def test_every_record_without_a_key_is_judged(spark):
    blank_rows = [(x, f"name {i}", "p", "b", "n", "Active") for i, x in enumerate([None, "", "  ", "-", None])]
    keyed = [("SPN1", "a", "p", "b", "n", "Active"), ("spn-1", "b", "p", "b", "n", "Active"), ("SPN2", "c", "p", "b", "n", "Active")]
    df = _rows(spark, trials.SPONSOR_COLUMNS, blank_rows + blank_rows + keyed)
    valid, rejected = trials.transform("sponsor", df)
    assert (valid.count(), rejected.count()) == (2, 2 * len(blank_rows))
    assert {r.invalid_reason for r in rejected.collect()} == {"sponsor_external_id_required"}
    assert conform(df.where("false"), trials.SPONSOR).count() == 0


def test_ties_in_time_go_by_content(spark):
    df = spark.createDataFrame([("k", 1, "b"), ("k", 1, "a"), ("k", 0, "0")], "key string, ingestion_timestamp int, v string")
    for shuffled in (df, df.orderBy("v"), df.repartition(3)):
        assert deduplicate_by_key(shuffled, "key").first().v == "a"


def _rows(spark, columns, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def test_several_reasons_are_listed(spark):
    columns = trials.INVOICE_COLUMNS
    df = _rows(spark, columns, [("I1", "N1", "C", "P", "S", "100", "150", "10", "2026-01-01", "Unpaid")])
    reason = trials.transform("invoice", df)[1].first().invalid_reason
    assert reason == "invoice_amount_lt_paid_amount|outstanding_mismatch"


def test_negative_contract_value_and_blank_sponsor(spark):
    df = _rows(spark, trials.CONTRACT_COLUMNS, [("C1", "N", "S", "P", " ", "X", "Active", "-1", "2026-01-01", "0")])
    assert trials.transform("contract", df)[1].first().invalid_reason == (
        "sponsor_external_id_required|contract_value_must_be_positive"
    )


@pytest.mark.parametrize("protocol", ["", None, "  "])
def test_null_and_blank_protocols_are_rejected_alike(spark, protocol):
    df = _rows(spark, trials.STUDY_COLUMNS, [("S", "N", protocol, "SP", "X", "D", "T", "A", "2026-01-01", "bad")])
    row = trials.transform("study", df)[1].first()
    assert row.invalid_reason == "protocol_no_required"
    assert row.end_date_std is None


def test_newest_invalid_row_hides_an_older_valid_one(spark):
    df = _rows(
        spark,
        [*trials.CONTRACT_COLUMNS, "batch_date"],
        [
            ("C1", "N", "S", "P", "SP", "X", "A", "10", "2026-01-01", "0", "2026-01-01"),
            ("C1", "N", "S", "P", "SP", "X", "A", "-5", "2026-01-01", "1", "2026-02-01"),
        ],
    )
    valid, rejected = trials.transform("contract", df)
    assert (valid.count(), rejected.count()) == (0, 1)


def test_dedupe_is_deterministic(spark):
    rows = [("k", "2026-01-01", "b"), ("k", "2026-01-15", "z"), ("k", "2026-01-15", "a"), (None, None, "n")]
    df = _rows(spark, ["key", "batch_date", "record_hash"], rows)
    for shuffled in (df, df.orderBy(F.col("record_hash").desc()), df.repartition(3)):
        kept = deduplicate_by_key(shuffled, "key").collect()
        assert sorted(map(str, ((r.key, r.record_hash) for r in kept))) == ["('k', 'a')", "(None, 'n')"]
    assert deduplicate_by_key(df.select("key", "record_hash").drop("record_hash"), "key").count() == 2


def test_written_halves(spark, raw, tmp_path):
    path = str(tmp_path / "study")
    sources.write_conformed(conform(raw["studies"], trials.STUDY), path)
    assert spark.read.parquet(f"{path}/record_status=valid").count() == 4
    assert spark.read.parquet(f"{path}/record_status=rejected").count() == 1


def test_normalize_join_keys(spark):
    df = _rows(spark, ["protocol_number", "sponsor_name"], [(" p-1001 ", "Acme Bio!"), (None, "x")])
    rows = normalize_join_keys(df, ["protocol_number", "sponsor_name"]).collect()
    assert sorted(map(str, map(tuple, rows))) == ["('P1001', 'ACMEBIO')", "(None, 'X')"]


def test_quality_checks(spark):
    df = _rows(spark, ["protocol", "sponsor"], [("P1", "SPN1"), (" ", "SPN2"), (None, None)])
    assert quality.required_field_violations(df, ["protocol", "sponsor"]).first().asDict() == {"protocol": 2, "sponsor": 1}
    assert quality.required_field_violations(df.where("false"), ["protocol"]).first().protocol == 0
    parent = _rows(spark, ["sponsor"], [("SPN1",), ("SPN1",), (None,)])
    assert quality.referential_integrity_orphans(df, parent, "sponsor").first().orphan_count == 2
    assert {r.protocol for r in quality.orphans(df, parent, "sponsor").collect()} == {" ", None}
    gate = {r.column_name: r.passed for r in quality.completeness(df, ["protocol", "sponsor"], 0.5).collect()}
    assert gate == {"protocol": False, "sponsor": True}


def test_silver_checks_return_the_offending_rows(spark):
    df = spark.createDataFrame(
        [("", "S", 1.0, 2.0, -1.0, 0.0), ("P", None, 3.0, 1.0, 2.0, 5.0), ("P", "S", 3.0, 1.0, 1.0, None)],
        "protocol_no_std string, sponsor_external_id_std string, invoice_amount_std double, paid_amount_std double, "
        "outstanding_amount_std double, contract_value_std double",
    )
    assert quality.study_protocol_required(df).count() == 1
    assert quality.sponsor_external_id_required(df).count() == 1
    assert quality.invoice_amount_gte_paid(df).count() == 1
    assert quality.outstanding_matches_formula(df).count() == 1
    assert quality.contract_value_positive(df).count() == 1
