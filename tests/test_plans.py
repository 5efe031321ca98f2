"""Physical plans that matter at scale, and the registered queries against their SQL at the smallest scale."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from check import TABLES, canonical
from tallyline.operators import metrics
from tallyline.operators.conform import conform
from tallyline.operators.dedupe import deduplicate_by_key
from tallyline.plans import catalog, oracle, trials
from tallyline.plans.feeds import study_feed, table

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")

QUICK = [
    "ar_reconciliation", "normalize_texts", "record_hashes", "ingest_csv_batches", "stream_upsert", "required_violations",
    "orphan_rows", "conform_study_rejected", "any_key_pairs", "similar_names", "study_contract_matches",
    "detect_changes", "apply_changes", "scd2_history", "change_export", "canonical_contracts", "recon_totals",
]


@pytest.fixture(autouse=True)
def compiled_stages(spark):
    """Plans and results as in production, with whole stages compiled."""
    spark.conf.set("spark.sql.codegen.wholeStage", "true")
    yield
    spark.conf.set("spark.sql.codegen.wholeStage", "false")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_and_registration(spark):
    result = entry.entry(spark)
    assert result.columns == ["sponsor_name", "study_name", "billed_amount", "paid_amount", "outstanding_amount"]
    assert set(oracle.SQL) == set(catalog.QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    result = con.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(df.columns, df.collect()) == canonical(columns, result.fetchall())


def test_dedupe_cuts_groups_before_the_shuffle(spark):
    events = table(spark, SF, "events")
    plan = plan_of(deduplicate_by_key(events, "user_id", [F.col("ts").desc(), F.col("event_id")]))
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange") == 1


def test_conform_shuffles_once(spark):
    plan = plan_of(conform(study_feed(spark, SF), trials.STUDY))
    assert plan.count("Exchange") == 1 and "Python" not in plan


def test_ar_join_reuses_the_partitioning_of_its_aggregations(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        inv = table(spark, SF, "orders").selectExpr("o_custkey AS sponsor_name", "o_orderpriority AS study_name", "o_totalprice AS invoice_amount")
        pay = table(spark, SF, "orders").selectExpr("o_custkey AS sponsor_name", "o_orderpriority AS study_name", "o_totalprice AS payment_amount")
        plan = plan_of(metrics.ar_reconciliation(inv, pay))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == 2


def test_scans_read_only_the_columns_in_use(spark):
    plan = plan_of(catalog.dedupe_latest(spark, SF))
    assert "props" not in plan.split("ReadSchema")[1]
    pushed = plan_of(catalog.ar_reconciliation(spark, SF))
    assert "EqualTo(l_linestatus,F)" in pushed


def test_no_python_in_any_plan(spark):
    for name in ("detect_changes", "recon_report", "sponsor_crosswalk", "canonical_projects", "rule_check_counts"):
        plan = plan_of(entry.queries()[name](spark, SF))
        assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


def test_checks_of_one_entity_conform_it_once(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(catalog, "staged", lambda df: stored.append(df) or df)
    catalog.rule_check_counts(spark, SF)
    assert [df.columns for df in stored] == [
        ["protocol_no_std", "sponsor_external_id_std"],
        ["invoice_amount_std", "paid_amount_std", "outstanding_amount_std"],
    ]


def test_the_last_history_is_not_stored(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(catalog, "staged", lambda df: stored.append(df.columns) or df)
    columns = catalog.scd2_history(spark, SF).columns
    assert stored.count(columns) == 1 and len(stored) == 3


def test_the_report_stores_what_it_looks_at(spark, monkeypatch):
    stored = []
    monkeypatch.setattr(catalog, "staged", lambda df: stored.append(df.columns) or df)
    catalog.report_alerts(spark, SF)
    lineage = ["batch_date", "ingestion_timestamp", "record_hash"]
    assert sorted(stored, key=len) == [
        ["invoice_amount_std", "outstanding_amount_std"],
        ["contract_name", "protocol_no", "sponsor_external_id", "contract_value", *lineage],
        ["invoice_id", "invoice_number", "sponsor_external_id", "invoice_amount", "paid_amount", "outstanding_amount", *lineage],
    ]
