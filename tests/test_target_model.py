from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tallyline import sources
from tallyline.operators import metrics
from tallyline.plans import trials
from tests.fixtures import FEEDS, land

AT = datetime(2026, 3, 1)


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    globs = land(tmp_path_factory.mktemp("landing"))
    return {
        name: sources.staged(
            sources.add_ingestion_metadata(sources.read_batch_csv(spark, globs[name], columns), name, "load-1", AT)
        )
        for name, (_, columns) in FEEDS.items()
    }


@pytest.fixture(scope="module")
def crosswalk(raw):
    return sources.staged(
        trials.study_contract_crosswalk(raw["studies"], raw["contracts"], raw["invoices"], sources.staged)
    )


@pytest.fixture(scope="module")
def header(raw, crosswalk):
    return sources.staged(trials.invoice_header(trials.transform("invoice", raw["invoices"])[0], crosswalk))


def test_customers(raw):
    sponsors = trials.sponsor_crosswalk(raw["sponsors"], [raw["studies"]])
    customers = {r.customer_external_id: r for r in trials.customer_master(sponsors, raw["sponsors"]).collect()}
    assert sorted(customers) == ["SPN001", "SPN002", "SPN003", "SPN004"]
    assert customers["SPN002"].customer_name == "Northwind Pharma"
    assert customers["SPN002"].billing_account_id == "BA-2001"
    assert customers["SPN001"].customer_external_id_raw == "SPN-001"
    assert customers["SPN004"].customer_status == "Pending"


def test_projects_and_contracts(raw, crosswalk):
    projects = trials.project_master(trials.transform("study", raw["studies"])[0])
    assert sorted(r.project_external_id for r in projects.collect()) == ["STUDY-1001", "STUDY-2200", "STUDY-3300", "STUDY-5500"]
    contracts = trials.contract_master(trials.transform("contract", raw["contracts"])[0], crosswalk)
    links = {r.contract_external_id: r.project_external_id for r in contracts.collect()}
    assert links == {"CNT-9004": "STUDY-1001", "CNT-9002": "STUDY-2200", "CNT-9003": "STUDY-3300", "CNT-9010": "STUDY-5500"}


def test_headers_lines_and_open_items(header):
    links = {r.invoice_external_id: r.project_external_id for r in header.collect()}
    assert links == {
        "INV-0001": "STUDY-1001", "INV-0002": "STUDY-2200", "INV-0003": "STUDY-3300",
        "INV-0004": "STUDY-1001", "INV-0005": "STUDY-3300", "INV-0006": "STUDY-5500",
    }
    lines = trials.invoice_line(header)
    assert lines.count() == 6 and {r.line_number for r in lines.collect()} == {1}
    assert trials.open_ar(header).count() == 5


def test_foreign_keys_meet(raw, header):
    sponsors = trials.sponsor_crosswalk(raw["sponsors"], [raw["invoices"]])
    customers = trials.customer_master(sponsors, raw["sponsors"])
    assert header.join(customers, "customer_external_id", "left_anti").count() == 0


def test_open_ar_with_a_plain_crosswalk(spark):
    invoices = spark.createDataFrame(
        [("INV-1", "1001", "P-1", "SPN1", "2026-01-01", "Unpaid", 100.0, 0.0, 100.0),
         ("INV-2", "1002", "P-2", "SPN2", "2026-01-01", "Paid", 50.0, 50.0, 0.0),
         ("INV-3", "1003", "P-2", "SPN2", "2026-01-01", "Unpaid", 50.0, 50.0, None),
         ("INV-4", "1004", None, "SPN2", "2026-01-01", "Unpaid", 5.0, 0.0, 5.0)],
        "invoice_id string, invoice_number string, protocol_no string, sponsor_external_id_std string, invoice_date_std string, "
        "payment_status string, invoice_amount_std double, paid_amount_std double, outstanding_amount_std double",
    )
    crosswalk = spark.createDataFrame(
        [("INV-1", "ST-1", "C-1", "P-1"), ("INV-2", "ST-2", "C-2", "P-2")],
        "invoice_id string, study_id string, contract_id string, protocol_no string",
    )
    header = trials.invoice_header(invoices, crosswalk)
    assert sorted(r.invoice_external_id for r in trials.open_ar(header).collect()) == ["INV-1", "INV-4"]
    assert {r.invoice_external_id: r.contract_external_id for r in header.collect()}["INV-3"] == "C-2"
    unmapped = trials.invoice_line(header).where("invoice_external_id = 'INV-4'").first()
    assert (unmapped.project_external_id, unmapped.contract_external_id) == ("UNMAPPED", "UNMAPPED")


def values(df):
    return {(r.metric_group, r.metric_name): r.metric_value for r in df.collect()}


def test_reconciliation_goldens(raw, header):
    contracts = trials.transform("contract", raw["contracts"])[0]
    report = metrics.assemble_report(
        metrics.source_vs_target_record_count(raw["invoices"], header, "record_count"),
        metrics.source_vs_target_total(raw["contracts"], "contract_value", contracts, "contract_value_std", "contract_value"),
        metrics.source_vs_target_total(raw["invoices"], "invoice_amount", header, "invoice_total", "invoice_total"),
        metrics.source_vs_target_total(raw["invoices"], "outstanding_amount", trials.open_ar(header), "amount_due", "open_ar"),
        metrics.rejected_record_count(trials.transform("study", raw["studies"])[1]),
        metrics.duplicate_count(raw["invoices"], ["invoice_id"]),
        metrics.runtime_metric(header.sparkSession, AT, datetime(2026, 3, 1, 0, 1)),
        generated_at=AT,
    )
    assert report.columns == ["metric_group", "metric_name", "metric_value", "report_generated_ts"]
    assert values(report) == {
        ("record_count", "source_record_count"): 7.0,
        ("record_count", "target_record_count"): 6.0,
        ("record_count", "record_count_delta"): -1.0,
        ("contract_value", "source_total"): 3800000.0,
        ("contract_value", "target_total"): 2550000.0,
        ("contract_value", "total_delta"): -1250000.0,
        ("invoice_total", "source_total"): 395000.0,
        ("invoice_total", "target_total"): 345000.0,
        ("invoice_total", "total_delta"): -50000.0,
        ("open_ar", "source_total"): 235000.0,
        ("open_ar", "target_total"): 185000.0,
        ("open_ar", "total_delta"): -50000.0,
        ("quality", "rejected_record_count"): 1.0,
        ("quality", "duplicate_count"): 1.0,
        ("runtime", "load_runtime_seconds"): 60.0,
    }


def test_small_metrics(spark):
    source = spark.createDataFrame([(1, 10.0), (2, 20.0), (2, 20.0)], "id int, amount double")
    target = spark.createDataFrame([(1, 10.0)], "id int, amount double")
    assert list(values(metrics.source_vs_target_record_count(source, target, "g")).values()) == [3.0, 1.0, -2.0]
    assert list(values(metrics.duplicate_count(source, ["id"])).values()) == [1.0]
    assert list(values(metrics.duplicate_count(source.where("false"), ["id"])).values()) == [0.0]
    empty = metrics.source_vs_target_total(source.where("false"), "amount", target, "amount", "g")
    assert list(values(empty).values()) == [0.0, 10.0, 10.0]
    changes = spark.createDataFrame([("insert",), ("update",), ("no_change",)], "change_type string")
    assert list(values(metrics.change_type_counts(changes)).values()) == [1.0, 1.0, 0.0, 1.0]
    crosswalk = spark.createDataFrame([(0.97,), (0.5,), (None,), (1.0,)], "overall_match_confidence double")
    assert list(values(metrics.match_accuracy(crosswalk)).values()) == [2.0, 4.0, 0.5]
    assert list(values(metrics.match_accuracy(crosswalk.where("false"))).values()) == [0.0, 0.0, 0.0]


def test_alerts(spark):
    report = spark.createDataFrame([("a", "x", 5.0), ("a", "y", 5.0), ("b", "x", -5.0)], "metric_group string, metric_name string, metric_value double")
    limits = spark.createDataFrame(
        [("a", "x", None, 4.0), ("a", "y", 0.0, 9.0), ("b", "x", -1.0, None)],
        "metric_group string, metric_name string, lowest double, highest double",
    )
    assert sorted((r.metric_group, r.metric_name) for r in metrics.threshold_alerts(report, limits).collect()) == [("a", "x"), ("b", "x")]


def test_ar_reconciliation(spark):
    invoices = spark.createDataFrame([("S", "T", 60.0), ("S", "T", 40.0), ("U", "T", 5.0)], "sponsor_name string, study_name string, invoice_amount double")
    payments = spark.createDataFrame([("S", "T", 40.0), ("V", "T", 3.0)], "sponsor_name string, study_name string, payment_amount double")
    left = {r.sponsor_name: (r.billed_amount, r.paid_amount, r.outstanding_amount) for r in metrics.ar_reconciliation(invoices, payments).collect()}
    assert left == {"S": (100.0, 40.0, 60.0), "U": (5.0, 0.0, 5.0)}
    full = {r.sponsor_name: r.outstanding_amount for r in metrics.ar_reconciliation(invoices, payments, how="full").collect()}
    assert full == {"S": 60.0, "U": 5.0, "V": -3.0}
    export = trials.invoice_export(metrics.ar_reconciliation(invoices, payments))
    assert export.columns == ["customer_name", "project_name", "invoice_total", "amount_paid", "amount_due"]


def test_audit_summary(header):
    audit = metrics.audit_summary({"header": (header, "invoice_total"), "open": (trials.open_ar(header), "amount_due"), "none": (header, None)}, AT)
    assert {r.table_name: (r.record_count, r.amount_total) for r in audit.collect()} == {
        "header": (6, 345000.0), "open": (5, 185000.0), "none": (6, None),
    }
    assert {r.audit_timestamp for r in audit.collect()} == {AT}
    assert audit.select(F.count("*")).first()[0] == 3


def test_only_what_a_header_takes_from_an_invoice_is_stored(spark):
    row = ("INV-1", "1001", "P-1", "SPN1", "2026-01-01", "Unpaid", 100.0, 0.0, 100.0, "2026-01-01", "hash", "Acme")
    invoices = spark.createDataFrame(
        [row],
        "invoice_id string, invoice_number string, protocol_no string, sponsor_external_id_std string, invoice_date_std string, "
        "payment_status string, invoice_amount_std double, paid_amount_std double, outstanding_amount_std double, "
        "batch_date string, record_hash string, contract_name string",
    )
    crosswalk = spark.createDataFrame([("INV-1", "ST-1", "C-1", "P-1")], "invoice_id string, study_id string, contract_id string, protocol_no string")
    stored = []

    def stage(df):
        stored.append(sources.staged(df))
        return stored[-1]

    header = trials.invoice_header(invoices, crosswalk, stage).collect()
    assert [(r.invoice_external_id, r.contract_external_id, r.amount_due) for r in header] == [("INV-1", "C-1", 100.0)]
    assert len(stored) == 1 and not {"record_hash", "batch_date", "contract_name"} & set(stored[0].columns)
