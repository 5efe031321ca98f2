"""One query per operator over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions import (
    batch_date_from_path,
    business_key,
    currency,
    is_blank,
    join_reasons,
    normalize_text,
    normalize_token,
    outstanding,
    record_hash,
    safe_date,
    similarity,
    weighted_score,
)
from tallyline.operators import changes as cdc
from tallyline.operators import history, metrics, quality
from tallyline.operators.conform import conform, normalize_join_keys, restricted, split
from tallyline.operators.dedupe import deduplicate_by_key, top_per_key
from tallyline.operators.hierarchy import roll_up
from tallyline.operators.joins import any_key_join, link_on_keys, prefixed, priority_join
from tallyline.operators.match import best_match, score_pairs, similar_values
from tallyline.operators.skew import skew_join
from tallyline.plans import trials
from tallyline.plans.lifecycle import FEEDS as LIFECYCLE_FEEDS
from tallyline.plans.lifecycle import Batch, Job, at_once
from tallyline.plans.feeds import contract_feed, invoice_feed, sponsor_feed, study_feed, table
from tallyline.sources import (
    KeyedTable,
    add_ingestion_metadata,
    append_raw,
    completeness_limits,
    completeness_measures,
    export_changes,
    gated_write,
    published,
    read_batch_csv,
    read_checked_csv,
    read_checked_json,
    read_json,
    read_labels,
    read_table,
    shared_dir,
    shuffles_dropped,
    staged,
    staging,
    store,
    write_conformed,
    write_version,
)
from tallyline.sources.keyed import is_there
from tallyline.sources.sinks import delete_folder
from tallyline.streaming import (
    ChangeFeed,
    DriftingFeed,
    classify_stream,
    compact,
    fold_changes,
    ingest_drifting,
    ingest_stream,
    read_changes,
    read_current,
    read_drifted,
    read_stream_csv,
    read_stream_parquet,
    upsert_stream,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FIRST, SECOND, THIRD = "2026-01-01 00:00:00", "2026-02-01 00:00:00", "2026-03-01 00:00:00"
LOADED = datetime(2026, 3, 1)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- text, values, hashes ---------------------------------------------------------------------


@query
def normalize_texts(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    messy = F.concat(F.lit("  "), F.col("p_name"), F.lit(" \t "), F.lower("p_type"), F.lit("\n"))
    return part.select("p_partkey", normalize_text(messy).alias("text_std"), normalize_token(messy).alias("token_std"))


@query
def normalize_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id",
        F.length(normalize_token("text")).cast("long").alias("token_length"),
        F.sha2(normalize_token("text"), 256).alias("token_hash"),
    )


@query
def normalize_null_forms(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    name = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit(" "), "c_name", F.lit("  "), "c_mktsegment"))
    return customer.select(
        "c_custkey",
        normalize_text(name).alias("text_null"),
        normalize_text(name, null_as_blank=True).alias("text_blank"),
        normalize_token(name).alias("token_null"),
        normalize_token(name, null_as_blank=True).alias("token_blank"),
    )


@query
def normalize_keys_in_place(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_partkey", "p_brand", F.concat("p_name", F.lit("/"), "p_type").alias("p_label"))
    return normalize_join_keys(part, ["p_brand", "p_label"])


@query
def standardized_keys(spark: SparkSession, sf: str) -> DataFrame:
    std = trials.with_standardized_keys(
        contract_feed(spark, sf),
        {
            "contract_id": "contract_id_std",
            "contract_name": "contract_name_std",
            "study_name": "study_name_std",
            "sponsor_external_id": "sponsor_external_id_std",
        },
    )
    return std.select("contract_id", "amendment_no", "contract_id_std", "contract_name_std", "study_name_std", "sponsor_external_id_std")


@query
def business_keys(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return customer.select("c_custkey", business_key("c_name", segment, "c_nationkey").alias("business_key"))


@query
def reject_reasons(spark: SparkSession, sf: str) -> DataFrame:
    lineitem = table(spark, sf, "lineitem")
    rules = {
        "quantity_high": F.col("l_quantity") > 45,
        "discounted": F.col("l_discount") > 0.05,
        "returned": F.col("l_returnflag") == "R",
    }
    reasons = lineitem.select(join_reasons(rules).alias("reasons"), "l_quantity")
    return reasons.groupBy("reasons").agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))


@query
def batch_dates(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    path = F.when(
        F.col("o_orderstatus") != "P",
        F.concat(F.lit("landing/orders/batch_date="), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/orders.csv")),
    ).otherwise(F.lit("landing/orders/late/orders.csv"))
    return orders.select(batch_date_from_path(path).alias("batch_date")).groupBy("batch_date").agg(F.count("*").alias("n"))


@query
def name_similarity(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    a, b = normalize_text("p_name"), normalize_text(F.concat("p_type", F.lit(" "), "p_name"))
    return part.select("p_partkey", similarity(a, b).alias("score"), similarity(a, F.lit("")).alias("against_blank"))


@query
def safe_dates(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = F.when(F.col("o_orderstatus") == "P", F.lit("not yet")).when(F.col("o_orderstatus") == "O", day).otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy")
    )
    return orders.select("o_orderkey", safe_date(raw).alias("order_date"))


@query
def safe_amounts(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    number = F.regexp_extract("props", r"(\d+)", 1)
    raw = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.concat(number, F.lit(".125")))
    return events.select("event_id", currency(raw).alias("amount"), F.col("value").alias("value"))


@query
def outstanding_amounts(spark: SparkSession, sf: str) -> DataFrame:
    return invoice_feed(spark, sf).select(
        "record_hash", outstanding(currency("invoice_amount"), currency("paid_amount")).alias("outstanding")
    )


@query
def weighted_scores(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    name = similarity(F.upper("p_name"), F.upper("p_type"))
    brand = F.when(F.col("p_size") > 10, similarity(F.col("p_brand"), F.lit("Brand#12")))
    parts = [("name", 0.45), ("brand", 0.25)]
    return part.select("p_partkey", name.alias("name"), brand.alias("brand")).select(
        "p_partkey", weighted_score(parts).alias("renormalized"), weighted_score(parts, renormalize=False).alias("plain")
    )


@query
def record_hashes(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return customer.select("c_custkey", record_hash(customer.columns).alias("record_hash"))


# --- ingest -----------------------------------------------------------------------------------


def _customer_landing(spark: SparkSession, sf: str) -> DataFrame:
    day = F.when(F.col("c_acctbal") < 0, "2026-01-15").otherwise("2026-01-01")
    return table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", "c_mktsegment", day.alias("batch_date")
    )


_LANDED = ("c_custkey", "c_name", "c_mktsegment")


@query
def ingest_csv_batches(spark: SparkSession, sf: str) -> DataFrame:
    landing = shared_dir(spark, "landing")
    _customer_landing(spark, sf).write.partitionBy("batch_date").option("header", True).csv(landing)
    raw = read_batch_csv(spark, f"{landing}/batch_date=*/*.csv", _LANDED)
    loaded = add_ingestion_metadata(raw, "crm", "load-1", LOADED)
    return loaded.drop("source_file_name", "ingestion_timestamp")


@query
def ingest_json_batches(spark: SparkSession, sf: str) -> DataFrame:
    landing = shared_dir(spark, "landing")
    _customer_landing(spark, sf).write.partitionBy("batch_date").json(landing)
    raw = read_json(spark, f"{landing}/batch_date=*/*.json", _LANDED)
    return add_ingestion_metadata(raw, "crm", "load-1", LOADED).drop("source_file_name", "ingestion_timestamp")


def _spoilt_customers(spark: SparkSession, sf: str, good: Column, spoil: dict[int, Column]) -> DataFrame:
    """A line of text for every customer, spoilt in one way or another by its key."""
    line = good
    for rest, spoilt in spoil.items():
        line = F.when(F.col("c_custkey") % 11 == rest, spoilt).otherwise(line)
    return table(spark, sf, "customer").select(line.alias("line"))


@query
def malformed_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Every line of a file with broken lines: records, and lines with the reason why they are none."""
    path = shared_dir(spark, "landing")
    key, name, segment = F.col("c_custkey").cast("string"), F.col("c_name"), F.col("c_mktsegment")
    spoil = {
        1: F.concat(key, F.lit(","), name),
        2: F.concat(key, F.lit(","), name, F.lit(","), segment, F.lit(",x")),
        3: F.concat(key, F.lit(","), name, F.lit(',"'), segment),
        4: F.concat(key, F.lit(',"'), name, F.lit('" x,'), segment),
    }
    good = F.concat(key, F.lit(',"'), name, F.lit(', Ltd",'), segment)
    lines = _spoilt_customers(spark, sf, good, spoil).withColumnRenamed("line", ",".join(_LANDED))
    lines.write.option("header", True).option("sep", "\u0001").option("quote", "").csv(path)
    return read_checked_csv(spark, path, _LANDED)


@query
def malformed_json(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "landing")
    whole = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in _LANDED]))
    spoil = {1: F.expr("left(to_json(struct(c_custkey, c_name)), 20)"), 2: F.concat(F.lit("["), whole, F.lit("]")), 3: F.col("c_name")}
    _spoilt_customers(spark, sf, whole, spoil).write.text(path)
    return read_checked_json(spark, path, _LANDED)


def _drifting_customers(spark: SparkSession, sf: str, feed: DriftingFeed) -> str:
    """Three landings of customers, one after another: the third lacks a column and brings a new one."""
    root = shared_dir(spark, "stream")
    customer = table(spark, sf, "customer")
    headers = (("c_custkey", "c_name", "c_mktsegment"), ("c_name", "c_mktsegment", "c_custkey"), ("c_custkey", "c_nationkey", "c_name"))
    for n, columns in enumerate(headers):
        customer.where(F.col("c_custkey") % 3 == n).select(*columns).write.option("header", True).csv(f"{root}/landing/{n}")
        ingest_drifting(spark, f"{root}/landing/*", f"{root}/table", f"{root}/checkpoint", feed).awaitTermination()
    return f"{root}/table"


@query
def stream_schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    root = _drifting_customers(spark, sf, DriftingFeed("crm", "load-1", ingested_at=LOADED))
    return read_drifted(spark, root).select("c_custkey", "c_name", "c_mktsegment", "c_nationkey", "schema_version", "source_system", "load_id", "record_hash")


@query
def stream_schema_rescued(spark: SparkSession, sf: str) -> DataFrame:
    """The same with fixed columns: what has no column is kept in a map."""
    root = _drifting_customers(spark, sf, DriftingFeed("crm", "load-1", _LANDED, evolve=False, ingested_at=LOADED))
    rescued = F.concat_ws(";", F.transform(F.map_entries("rescued"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return read_drifted(spark, root).select(*_LANDED, "schema_version", rescued.alias("rescued"))


@query
def raw_append(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "raw")
    feed = study_feed(spark, sf)
    append_raw(feed.where(F.col("batch_date") < "2026-02-01"), path)
    append_raw(feed.where(F.col("batch_date") >= "2026-02-01"), path)
    return (
        read_table(spark, path)
        .groupBy(F.col("batch_date").cast("string").alias("batch_date"))
        .agg(F.count("*").alias("n"), F.countDistinct("record_hash").alias("hashes"))
    )


@query
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "events").schema
    root = shared_dir(spark, "stream")
    stream = read_stream_parquet(spark, sf, schema, "events.parquet").select("event_id", "user_id", "event_type", "props")
    for _ in range(2):  # the second run finds nothing new
        ingest_stream(stream, f"{root}/raw", f"{root}/checkpoint", "events", "load-1", LOADED).awaitTermination()
    return spark.read.parquet(f"{root}/raw").select(
        "event_id", "user_id", "event_type", "props", "source_system", "load_id", "record_hash"
    )


@query
def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "events").schema
    root = shared_dir(spark, "stream")
    order = [F.col("ts").desc(), F.col("event_id").desc()]
    stream = read_stream_parquet(spark, sf, schema, "events.parquet")
    upsert_stream(stream, root, f"{root}/checkpoint", ["user_id"], order).awaitTermination()
    return read_current(spark, root, ["user_id"], order).select("user_id", "event_id", "event_type", "value")


def _land_events(spark: SparkSession, sf: str, root: str, text: bool) -> None:
    """The events as files of their own, dealt by a hash of their id, so that a stream takes several batches."""
    events = table(spark, sf, "events").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    dealt = events.select(*[F.col(c).cast("string") for c in EVENT_COLUMNS]).repartition(4, "event_id")
    (dealt.write.option("header", True).csv if text else dealt.write.parquet)(f"{root}/landing")


EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value")


@query
def stream_csv_ingest(spark: SparkSession, sf: str) -> DataFrame:
    root = shared_dir(spark, "stream")
    _land_events(spark, sf, root, text=True)
    stream = read_stream_csv(spark, f"{root}/landing", EVENT_COLUMNS, files_per_trigger=1)
    ingest_stream(stream, f"{root}/raw", f"{root}/checkpoint", "events", "load-1", LOADED).awaitTermination()
    return spark.read.parquet(f"{root}/raw").select(*EVENT_COLUMNS, "source_system", "load_id", "record_hash")


@query
def stream_upsert_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Several batches with late rows; an ``error`` event deletes its user; the first batches are folded."""
    root = shared_dir(spark, "stream")
    _land_events(spark, sf, root, text=False)
    order = [F.col("ts").desc(), F.col("event_id").cast("long").desc()]
    stream = read_stream_parquet(spark, f"{root}/landing", spark.read.parquet(f"{root}/landing").schema, "*.parquet", 1)
    upsert_stream(stream, root, f"{root}/checkpoint", ["user_id"], order).awaitTermination()
    compact(spark, root, ["user_id"], order, upto=1)
    compact(spark, root, ["user_id"], order, upto=2, compacted_to=1)
    now = read_current(spark, root, ["user_id"], order, compacted_to=2, deleted=F.col("event_type") == "error")
    return now.select("user_id", "event_id", "event_type", "ts")


def _classified_events(spark: SparkSession, sf: str) -> tuple[str, ChangeFeed]:
    """Three loads of events, dealt by their id so that many are late, one after another through one stream.

    An ``error`` deletes its user; the last load also repeats the first one.
    """
    root = shared_dir(spark, "stream")
    events = table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", F.round("value", 0).alias("value"))
    feed = ChangeFeed(["user_id"], ["ts", "event_id"], "event_type = 'error'", ["event_type", "value"])
    for load in range(3):
        arrived = events.where((F.col("event_id") % 3 == load) | ((F.col("event_id") % 3 == 0) if load == 2 else F.lit(False)))
        arrived.write.mode("append").parquet(f"{root}/landing")
        stream = read_stream_parquet(spark, f"{root}/landing", events.schema, "*.parquet")
        classify_stream(stream, root, f"{root}/checkpoint", feed).awaitTermination()
    return root, feed


@query
def stream_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The change set of every load, compared by key and hash with what came before."""
    found = read_changes(spark, _classified_events(spark, sf)[0])
    return found.select("batch_id", "user_id", "change_type", "event_type", "value", "record_hash", "delta_business_key")


@query
def stream_changes_folded(spark: SparkSession, sf: str) -> DataFrame:
    """The table that the change sets make, kept in key-hash parts."""
    root, feed = _classified_events(spark, sf)
    users = KeyedTable(spark, f"{root}/users", feed.keys)
    return users.read(fold_changes(spark, root, users)).select("user_id", "event_type", "value", "record_hash")


@query
def written_versions(spark: SparkSession, sf: str) -> DataFrame:
    """A table, the next version made from it, both written and read back."""
    root = shared_dir(spark, "versions")
    first = spark.read.parquet(write_version(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), root, 1))
    write_version(first.where("o_orderstatus <> 'F'").withColumn("o_orderstatus", F.lower("o_orderstatus")), root, 2)
    both = spark.read.parquet(root)
    return both.select("version", "o_orderkey", "o_custkey", "o_orderstatus")


# --- quality and conformance ------------------------------------------------------------------


@query
def required_violations(spark: SparkSession, sf: str) -> DataFrame:
    return quality.required_field_violations(study_feed(spark, sf), ["study_id", "protocol_no", "sponsor_external_id", "site_code"])


@query
def completeness_gate(spark: SparkSession, sf: str) -> DataFrame:
    gate = quality.completeness(study_feed(spark, sf), ["study_id", "protocol_no", "sponsor_external_id"], 0.95)
    return gate.withColumn("completeness", F.round("completeness", 6))


GATED = ("study_id", "protocol_no", "sponsor_external_id")


@query
def gated_publication(spark: SparkSession, sf: str) -> DataFrame:
    """Three versions of the studies behind a gate: those without a gap, all of them, and the former again without the oldest."""
    root, feed = shared_dir(spark, "studies"), study_feed(spark, sf)
    filled = feed.where(~is_blank("protocol_no") & ~is_blank("sponsor_external_id"))
    audits = None
    for version, rows in (("1", filled), ("2", feed), ("3", filled.where("batch_date > '2026-01-01'"))):
        audit = gated_write(rows, root, version, "study", completeness_measures(GATED), completeness_limits("study", GATED), datetime(2026, 3, int(version)))
        audit = audit.select(
            F.lit(version).alias("version"), "metric_name", F.round("metric_value", 6).alias("metric_value"), "passed",
            F.lit(published(spark, root)).alias("published_then"),
        )
        audits = audit if audits is None else audits.unionByName(audit)
    return audits


def _order_refs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    child = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("custkey")
    )
    parent = table(spark, sf, "customer").where(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("custkey"))
    return child, parent


@query
def orphan_rows(spark: SparkSession, sf: str) -> DataFrame:
    child, parent = _order_refs(spark, sf)
    return quality.orphans(child, parent, "custkey").select("o_orderkey")


@query
def orphan_total(spark: SparkSession, sf: str) -> DataFrame:
    child, parent = _order_refs(spark, sf)
    return quality.referential_integrity_orphans(child, parent, "custkey")


@query
def rule_check_counts(spark: SparkSession, sf: str) -> DataFrame:
    # two checks read the studies and two the invoices: what they look at is stored, so that each is conformed once
    study = staged(conform(study_feed(spark, sf), trials.STUDY).select("protocol_no_std", "sponsor_external_id_std"))
    contract = conform(contract_feed(spark, sf), trials.CONTRACT)
    amounts = ("invoice_amount_std", "paid_amount_std", "outstanding_amount_std")
    invoice = staged(conform(invoice_feed(spark, sf), trials.INVOICE).select(*amounts))
    checks = {
        "study_protocol_required": quality.study_protocol_required(study),
        "sponsor_external_id_required": quality.sponsor_external_id_required(study),
        "invoice_amount_gte_paid": quality.invoice_amount_gte_paid(invoice),
        "outstanding_matches_formula": quality.outstanding_matches_formula(invoice),
        "contract_value_positive": quality.contract_value_positive(contract),
    }
    rows = None
    for name, broken in checks.items():
        row = broken.agg(F.count("*").alias("violations")).select(F.lit(name).alias("rule"), "violations")
        rows = row if rows is None else rows.unionByName(row)
    return rows


@query
def rule_counts_one_pass(spark: SparkSession, sf: str) -> DataFrame:
    lineitem = table(spark, sf, "lineitem")
    return quality.rule_counts(
        lineitem,
        {
            "quantity_high": F.col("l_quantity") > 45,
            "discount_high": F.col("l_discount") > 0.08,
            "flag_blank": is_blank("l_returnflag"),
        },
    )


FEEDS = {"study": study_feed, "contract": contract_feed, "invoice": invoice_feed, "sponsor": sponsor_feed, "site": study_feed}
SHOWN = {
    "study": ["study_id", "study_name_std", "protocol_no_std", "sponsor_external_id_std", "site_code_std", "start_date_std", "end_date_std"],
    "contract": ["contract_id", "contract_name_std", "study_name_std", "sponsor_external_id_std", "effective_date_std", "contract_value_std", "amendment_no"],
    "invoice": ["invoice_id", "contract_name_std", "protocol_no_std", "invoice_date_std", "invoice_amount_std", "paid_amount_std", "outstanding_amount_std"],
    "sponsor": ["sponsor_name_std", "sponsor_external_id_std", "billing_account_id"],
    "site": ["site_code_std", "study_name_std", "protocol_no_std", "sponsor_external_id_std"],
}


def _register_conformance(entity: str) -> None:
    columns = ["business_key", *SHOWN[entity]]

    def valid(spark: SparkSession, sf: str) -> DataFrame:
        return trials.transform(entity, FEEDS[entity](spark, sf))[0].select(*columns)

    def rejected(spark: SparkSession, sf: str) -> DataFrame:
        return trials.transform(entity, FEEDS[entity](spark, sf))[1].select(*columns, "invalid_reason")

    QUERIES[f"conform_{entity}_valid"] = valid
    QUERIES[f"conform_{entity}_rejected"] = rejected


for _entity in SHOWN:
    _register_conformance(_entity)


@query
def conform_written_once(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "conformed")
    write_conformed(conform(study_feed(spark, sf), trials.STUDY), path)
    return spark.read.parquet(path).groupBy("record_status", "invalid_reason").agg(F.count("*").alias("n"))


@query
def dedupe_latest(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events")
    return deduplicate_by_key(events, "user_id", [F.col("ts").desc(), F.col("event_id").desc()]).select(
        "user_id", "event_id", "event_type", "value"
    )


@query
def full_row_distinct(spark: SparkSession, sf: str) -> DataFrame:
    lineitem = table(spark, sf, "lineitem")
    return lineitem.select("l_partkey", "l_returnflag", "l_linestatus").distinct()


@query
def whole_row_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """All columns, over a table in which two thirds of the rows occur twice."""
    lineitem = table(spark, sf, "lineitem")
    return lineitem.union(lineitem.where("l_orderkey % 3 <> 0")).distinct()


# --- joins ------------------------------------------------------------------------------------


@query
def link_studies_to_contracts(spark: SparkSession, sf: str) -> DataFrame:
    keys = ["protocol_no", "sponsor_external_id"]
    studies = normalize_join_keys(study_feed(spark, sf).select("study_id", "study_name", *keys), keys)
    contracts = normalize_join_keys(contract_feed(spark, sf).select("contract_id", "amendment_no", "study_name", *keys), keys)
    return link_on_keys(studies, contracts, keys)


@query
def any_key_pairs(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    crm = customer.select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_custkey").cast("string")).alias("code"),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("balance"),
    )
    erp = customer.select(
        F.concat(F.lit("E"), "c_custkey").alias("erp_id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_mktsegment") != "FURNITURE", F.col("c_custkey").cast("string")).alias("code"),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("balance"),
    )
    return any_key_join(crm, erp, ["code", "name", "balance"]).select("l_c_custkey", "r_erp_id")


@query
def pair_scores(spark: SparkSession, sf: str) -> DataFrame:
    studies = trials.with_standardized_keys(
        study_feed(spark, sf).select("study_id", "study_name", "protocol_no", "sponsor_external_id"),
        {"study_name": "study_name_std", "protocol_no": "protocol_no_std", "sponsor_external_id": "sponsor_external_id_std"},
    )
    contracts = trials.with_standardized_keys(
        contract_feed(spark, sf).select("contract_id", "amendment_no", "study_name", "protocol_no", "sponsor_external_id", "contract_name"),
        {"study_name": "study_name_std", "protocol_no": "protocol_no_std", "sponsor_external_id": "sponsor_external_id_std", "contract_name": "contract_name_std"},
    )
    pairs = any_key_join(studies, contracts, ["protocol_no_std", "study_name_std"])
    scored = score_pairs(pairs, trials.MATCHING)
    plain = score_pairs(pairs, trials.MATCHING, compare_blanks=True).select(
        "l_study_id", "r_contract_id", "r_amendment_no", F.col("overall_match_confidence").alias("plain_confidence")
    )
    on = ["l_study_id", "r_contract_id", "r_amendment_no"]
    return scored.join(plain, on).select(
        *on, "match_level", "sponsor_match_score", "study_match_score", "overall_match_confidence", "plain_confidence"
    )


@query
def similar_names(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    label = F.concat("p_name", F.lit(" "), "p_type")
    typed = F.regexp_replace(F.lower(label), "e", "")
    return similar_values(part.select(typed.alias("v")), part.select(F.lower(label).alias("v")), 0.85)


def _contract_systems(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The parts as contracts of two systems, which by turns share a sponsor, a protocol, a contract or study name, or no key."""
    part = table(spark, sf, "part")
    key, turn = F.col("p_partkey").cast("string"), F.col("p_partkey") % 5
    sponsor = F.upper(F.concat_ws(" ", "p_name", "p_type"))
    contract = F.upper(F.concat_ws(" ", "p_type", "p_name", "p_brand"))
    shared = {
        "sponsor_external_id_std": F.when(turn == 0, F.concat(F.lit("S"), key)),
        "protocol_no_std": F.when(turn == 1, F.concat(F.lit("P"), key)),
        "study_name_std": F.when(turn == 4, F.concat(F.lit("STUDY "), key)),
        "sponsor_name_std": sponsor,
    }
    left = part.select(
        F.concat(F.lit("A-"), key).alias("left_id"), *[c.alias(n) for n, c in shared.items()],
        F.when(turn == 2, contract).when(turn == 3, F.concat(contract, F.lit("Q"))).alias("contract_name_std"),
    )
    right = part.select(
        F.concat(F.lit("B-"), key).alias("right_id"), *[c.alias(n) for n, c in shared.items() if n != "sponsor_name_std"],
        F.when(turn == 2, F.replace(sponsor, F.lit("E"), F.lit("X"))).otherwise(sponsor).alias("sponsor_name_std"), contract.alias("contract_name_std"),
    )
    return left, right


@query
def fuzzy_contract_matches(spark: SparkSession, sf: str) -> DataFrame:
    """The best contract of the other system at every level; without a shared key by names alone."""
    left, right = (staged(x) for x in _contract_systems(spark, sf))
    found = best_match(left, right, trials.MATCHING, "left_id", [F.col("right_id")], stage=staged)
    return found.select(
        "l_left_id", "r_right_id", "match_level", "sponsor_match_score", "study_match_score", "contract_match_score", "scored_dims", "overall_match_confidence"
    )


@query
def priority_lookup(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("S"), "l_suppkey")).alias("code"),
        F.concat(F.lit("N"), F.pmod("l_suppkey", F.lit(25))).alias("region_code"),
    )
    supplier = table(spark, sf, "supplier").select(
        F.when(F.col("s_acctbal") >= 0, F.concat(F.lit("S"), "s_suppkey")).alias("code"),
        F.concat(F.lit("N"), "s_nationkey").alias("region_code"),
        "s_name",
    )
    found = priority_join(lines, supplier, ["code", "region_code"], [F.col("s_name")], ["s_name"])
    return found.groupBy("s_name").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("lines"))


# --- matching ---------------------------------------------------------------------------------


def _sponsors(spark: SparkSession, sf: str) -> DataFrame:
    feeds = [f(spark, sf).select("sponsor_external_id") for f in (study_feed, contract_feed, invoice_feed)]
    return trials.sponsor_crosswalk(sponsor_feed(spark, sf), feeds)


# What several queries of a session read, by session, tables and name: the folder that it is stored in.
_STORED: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf: str, name: str, build: Callable[[trials.Stage], DataFrame]) -> DataFrame:
    """A derived table that the session stores when it is first asked for, as the load job stores its steps.

    What ``build`` stages on the way is removed. It is built again if its folder has been removed (``drop_staged``).
    """
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STORED or not is_there(spark, _STORED[key]):
        path = shared_dir(spark, name)
        with staging(spark) as stage:
            store(build(stage), path)
        _STORED[key] = path
    return spark.read.parquet(_STORED[key])


def _matches(spark: SparkSession, sf: str) -> DataFrame:
    def build(stage: trials.Stage) -> DataFrame:
        studies = study_feed(spark, sf).select("study_id", "study_name", "protocol_no", "sponsor_external_id")
        contracts = contract_feed(spark, sf).select("contract_id", "contract_name", "study_name", "protocol_no", "sponsor_external_id", "batch_date")
        return trials.study_contract_matches(stage(studies), stage(contracts), stage=stage)

    return _once(spark, sf, "matches", build)


# What the steps after the crosswalk read of it.
_LINKED = (
    "study_id", "contract_id", "protocol_no", "sponsor_external_id", "invoice_id", "invoice_number",
    "sponsor_match_score", "study_match_score", "contract_match_score", "overall_match_confidence", "match_level",
)


def _crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    """The stored crosswalk, as the steps after it read it."""
    matches = _matches(spark, sf)

    def build(stage: trials.Stage) -> DataFrame:
        billed = invoice_feed(spark, sf).select("invoice_id", "invoice_number", "contract_name", "protocol_no", "sponsor_external_id")
        return trials.attach_invoices(matches, stage(billed)).select(*_LINKED)

    return _once(spark, sf, "crosswalk", build)


@query
def sponsor_crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    return _sponsors(spark, sf)


@query
def sponsor_crosswalk_by_name(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    label = F.concat("p_name", F.lit(" "), "p_type")
    master = part.groupBy(label.alias("sponsor_name")).agg(F.min("p_partkey").alias("k")).select(
        F.concat(F.lit("M"), "k").alias("sponsor_external_id"), "sponsor_name", F.concat(F.lit("BA"), "k").alias("billing_account_id")
    )
    feed = part.select(
        F.concat(F.lit("F-"), "p_partkey").alias("sponsor_external_id"),
        F.regexp_replace(F.lower(label), "e", "").alias("sponsor_name"),
    )
    return trials.sponsor_crosswalk(master, [feed])


@query
def study_contract_matches(spark: SparkSession, sf: str) -> DataFrame:
    return _matches(spark, sf)


@query
def study_contract_crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    return _crosswalk(spark, sf).select("study_id", "contract_id", "sponsor_external_id", "invoice_id", "invoice_number", "match_level")


@query
def entity_crosswalk(spark: SparkSession, sf: str) -> DataFrame:
    return trials.entity_crosswalk(_sponsors(spark, sf), _crosswalk(spark, sf))


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    """Every study paired with the contract of its own order; true unless the contract is worthless."""
    orders = table(spark, sf, "orders")
    return orders.select(
        F.concat(F.lit("STUDY-"), "o_orderkey").alias("study_id"),
        F.concat(F.lit("CNT-"), "o_orderkey").alias("contract_id"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "4-NOT SPECIFIED"), "FALSE")
        .otherwise("TRUE")
        .alias("expected_match"),
    )


@query
def scored_labels(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_dir(spark, "labels")
    _labels(spark, sf).write.option("header", True).csv(path)
    labels = read_labels(spark, path, ["study_id", "contract_id"])
    return metrics.score_labels(labels, _matches(spark, sf), ["study_id", "contract_id"])


@query
def labelled_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    labels = _labels(spark, sf).withColumn("expected_match", F.col("expected_match") == "TRUE")
    scored = metrics.score_labels(labels, _matches(spark, sf), ["study_id", "contract_id"])
    rates = metrics.labelled_accuracy(scored, threshold=trials.CONFIDENT)
    return rates.select(*[F.round(c, 6).alias(c) for c in rates.columns])


# --- change capture ---------------------------------------------------------------------------

ORDER_FIELDS = ("o_custkey", "o_orderstatus", "price", "o_orderpriority")


def _snapshot(spark: SparkSession, sf: str, number: int) -> DataFrame:
    """Orders as seen at three times: without the newest, without the oldest, all of them.

    In the first, recent finished orders are still open.
    """
    orders = table(spark, sf, "orders")
    status = F.col("o_orderstatus")
    if number == 1:
        orders = orders.where(F.col("o_orderdate") < "2001-01-01")
        status = F.when((F.col("o_orderdate") >= "2000-01-01") & (status == "F"), "O").otherwise(status)
    elif number == 2:
        orders = orders.where(F.col("o_orderdate") >= "1996-01-01")
    return orders.select(
        "o_orderkey",
        "o_custkey",
        status.alias("o_orderstatus"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"),
        "o_orderpriority",
    )


def _hashed_snapshot(spark: SparkSession, sf: str, number: int) -> DataFrame:
    return _snapshot(spark, sf, number).withColumn("record_hash", record_hash(ORDER_FIELDS))


def _detected(spark: SparkSession, sf: str, old: int = 1, new: int = 2) -> DataFrame:
    return cdc.detect_changes(_hashed_snapshot(spark, sf, new), _hashed_snapshot(spark, sf, old), ["o_orderkey"], detected_at=LOADED)


@query
def detect_changes(spark: SparkSession, sf: str) -> DataFrame:
    found = cdc.detect_changes(_snapshot(spark, sf, 2), _snapshot(spark, sf, 1), ["o_orderkey"], detected_at=LOADED)
    return found.drop("delta_detected_at")


@query
def apply_changes(spark: SparkSession, sf: str) -> DataFrame:
    changes = staged(cdc.change_set(_detected(spark, sf)))
    return cdc.apply_changes(_hashed_snapshot(spark, sf, 1), changes, ["o_orderkey"])


@query
def upsert_orders(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.upsert(_hashed_snapshot(spark, sf, 1), _hashed_snapshot(spark, sf, 2), ["o_orderkey"])


def _keyed_orders(spark: SparkSession, sf: str) -> KeyedTable:
    return KeyedTable(spark, shared_dir(spark, "orders"), ["o_orderkey"])


@query
def keyed_versions(spark: SparkSession, sf: str) -> DataFrame:
    """Three versions of a table in key-hash parts, each made from the changes since the one before."""
    orders = _keyed_orders(spark, sf)
    orders.create(_hashed_snapshot(spark, sf, 1), "1")
    for n in (2, 3):
        changes = staged(orders.compare(_hashed_snapshot(spark, sf, n), str(n - 1), detected_at=LOADED))
        orders.apply(str(n - 1), str(n), changes)
    first, second, third = (orders.read(v).withColumn("version", F.lit(v)) for v in ("1", "2", "3"))
    return first.unionByName(second).unionByName(third)


@query
def keyed_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The second snapshot merged into the first in key-hash parts: nothing is deleted."""
    orders = _keyed_orders(spark, sf)
    orders.create(_hashed_snapshot(spark, sf, 1), "1")
    orders.upsert("1", "2", _hashed_snapshot(spark, sf, 2), staged)
    return orders.read("2")


@query
def scd2_history(spark: SparkSession, sf: str) -> DataFrame:
    rows = history.open_history(_hashed_snapshot(spark, sf, 1), FIRST)
    for when, old, new in ((SECOND, 1, 2), (THIRD, 2, 3)):
        changes = staged(cdc.change_set(_detected(spark, sf, old, new)))
        rows = history.apply_scd2(rows, changes, ["o_orderkey"], when)
        if when != THIRD:  # what comes after reads it several times
            rows = staged(rows)
    return rows


@query
def scd2_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    snapshots = [(when, _hashed_snapshot(spark, sf, n)) for n, when in ((1, FIRST), (2, SECOND), (3, THIRD))]
    return history.history_from_snapshots(snapshots, ["o_orderkey"])


@query
def late_history(spark: SparkSession, sf: str) -> DataFrame:
    """The history of the users' events, three loads of them one after another, most of them late; an error is a delete."""
    events = table(spark, sf, "events").select("user_id", "event_type", F.floor("value").alias("value"), "ts", "event_id")
    events = staged(events.withColumn("record_hash", record_hash(["event_type", "value"])).drop("event_id"))
    loads = [events.where(F.pmod(F.xxhash64("user_id", "ts", "record_hash"), F.lit(3)) == n) for n in range(3)]
    deleted, log = "event_type = 'error'", loads[0]
    rows = staged(history.history_from_changes(log, ["user_id"], "ts", deleted=deleted))
    for late in loads[1:]:
        rows = staged(history.splice_late(rows, log, late, ["user_id"], "ts", deleted=deleted))
        log = log.unionByName(late)
    return rows


@query
def change_counts(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.change_type_counts(_detected(spark, sf))


@query
def change_export(spark: SparkSession, sf: str) -> DataFrame:
    found = _detected(spark, sf).drop("delta_detected_at")
    path = export_changes(found, shared_dir(spark, "export"), "orders", "20260301")
    return read_batch_csv(spark, path, found.columns)


# --- target model -----------------------------------------------------------------------------


def _valid(spark: SparkSession, sf: str, entity: str) -> DataFrame:
    return split(conform(FEEDS[entity](spark, sf), trials.ENTITIES[entity]))[0]


# What an invoice header takes from its invoice and what the rules judge.
_HEADED = (
    "invoice_id", "invoice_number", "protocol_no", "sponsor_external_id", "invoice_amount", "paid_amount", "outstanding_amount",
    "invoice_date", "payment_status",
)


def _header(spark: SparkSession, sf: str, stage: trials.Stage = staged) -> DataFrame:
    links = _crosswalk(spark, sf)
    invoices = _reported(invoice_feed(spark, sf), _HEADED)
    return trials.invoice_header(split(conform(invoices, restricted(trials.INVOICE, _HEADED)))[0], links, stage)


@query
def canonical_customers(spark: SparkSession, sf: str) -> DataFrame:
    return trials.customer_master(_sponsors(spark, sf), sponsor_feed(spark, sf))


@query
def canonical_projects(spark: SparkSession, sf: str) -> DataFrame:
    return trials.project_master(_valid(spark, sf, "study"))


@query
def canonical_contracts(spark: SparkSession, sf: str) -> DataFrame:
    return trials.contract_master(_valid(spark, sf, "contract"), _matches(spark, sf))


@query
def canonical_invoice_headers(spark: SparkSession, sf: str) -> DataFrame:
    return _header(spark, sf)


@query
def canonical_invoice_lines(spark: SparkSession, sf: str) -> DataFrame:
    return trials.invoice_line(_header(spark, sf))


@query
def canonical_open_ar(spark: SparkSession, sf: str) -> DataFrame:
    return trials.open_ar(_header(spark, sf))


@query
def audit_summary(spark: SparkSession, sf: str) -> DataFrame:
    links = _crosswalk(spark, sf)
    with staging(spark) as stage:
        header = staged(_header(spark, sf, stage))
    return metrics.audit_summary(
        {
            "customer_master": (trials.customer_master(_sponsors(spark, sf), sponsor_feed(spark, sf)), None),
            "project_master": (trials.project_master(_valid(spark, sf, "study")), None),
            "contract_master": (trials.contract_master(_valid(spark, sf, "contract"), links), None),
            "invoice_header": (header, "invoice_total"),
            "invoice_line": (trials.invoice_line(header), "line_amount"),
            "open_ar": (trials.open_ar(header), "amount_due"),
        },
        LOADED,
    ).drop("audit_timestamp")


# --- reconciliation ---------------------------------------------------------------------------


def _receivables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Orders billed per customer and priority; finished lines paid, also for orders still planned."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.concat(F.lit("C-"), "o_custkey").alias("sponsor_name"),
        F.col("o_orderpriority").alias("study_name"),
        "o_totalprice",
        "o_orderstatus",
    )
    lines = table(spark, sf, "lineitem").where(F.col("l_linestatus") == "F")
    invoices = orders.where(F.col("o_orderstatus") != "P").withColumnRenamed("o_totalprice", "invoice_amount")
    paid = lines.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("payment_amount"))
    payments = skew_join(paid, orders.select("o_orderkey", "sponsor_name", "study_name"), ["o_orderkey"])
    return invoices, payments


@query
def ar_reconciliation(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.ar_reconciliation(*_receivables(spark, sf))


@query
def ar_reconciliation_full(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.ar_reconciliation(*_receivables(spark, sf), how="full")


@query
def invoice_export(spark: SparkSession, sf: str) -> DataFrame:
    return trials.invoice_export(metrics.ar_reconciliation(*_receivables(spark, sf)))


def _invoices(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return invoice_feed(spark, sf), _valid(spark, sf, "invoice")


@query
def recon_counts(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.source_vs_target_record_count(*_invoices(spark, sf), "record_count")


@query
def recon_totals(spark: SparkSession, sf: str) -> DataFrame:
    source, target = _invoices(spark, sf)
    return metrics.source_vs_target_total(source, "invoice_amount", target, "invoice_amount_std", "invoice_total")


@query
def recon_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.rejected_record_count(split(conform(invoice_feed(spark, sf), trials.INVOICE))[1])


@query
def recon_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.duplicate_count(invoice_feed(spark, sf), ["invoice_id"])


@query
def recon_match_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.match_accuracy(_matches(spark, sf), threshold=trials.CONFIDENT)


# What the report looks at in an invoice: its key, its amounts and what its rules judge.
_REPORTED = ("invoice_id", "invoice_number", "sponsor_external_id", "invoice_amount", "paid_amount", "outstanding_amount")
# The same of contracts and studies.
_REPORTED_CONTRACT = ("contract_name", "protocol_no", "sponsor_external_id", "contract_value")
_REPORTED_STUDY = ("study_name", "protocol_no", "site_code", "sponsor_external_id")


def _reported(feed: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Some columns with the lineage; hashes as bytes, which sort as their hex does and take half the room."""
    return feed.select(*columns, "batch_date", "ingestion_timestamp", F.unhex("record_hash").alias("record_hash"))


def _report(spark: SparkSession, sf: str, studies: DataFrame, contracts: DataFrame) -> DataFrame:
    """The report over stored raw and conformed tables, as the load job leaves them; stored are the columns that it looks at."""
    source = staged(_reported(invoice_feed(spark, sf), _REPORTED))
    valid = split(conform(source, restricted(trials.INVOICE, _REPORTED)))[0]
    target = staged(valid.select("invoice_amount_std", "outstanding_amount_std"))
    contracts, studies = staged(_reported(contracts, _REPORTED_CONTRACT)), _reported(studies, _REPORTED_STUDY)
    valid_contracts = split(conform(contracts, restricted(trials.CONTRACT, _REPORTED_CONTRACT)))[0]
    return metrics.assemble_report(
        metrics.source_vs_target_record_count(source, target, "record_count"),
        metrics.source_vs_target_total(contracts, "contract_value", valid_contracts, "contract_value_std", "contract_value"),
        metrics.source_vs_target_total(source, "invoice_amount", target, "invoice_amount_std", "invoice_total"),
        metrics.source_vs_target_total(
            source, "outstanding_amount", target.where(F.col("outstanding_amount_std") > 0), "outstanding_amount_std", "open_ar"
        ),
        metrics.rejected_record_count(split(conform(studies, restricted(trials.STUDY, _REPORTED_STUDY)))[1]),
        metrics.duplicate_count(source, ["invoice_id"]),
        metrics.runtime_metric(spark, datetime(2026, 3, 1), datetime(2026, 3, 1, 0, 5)),
        metrics.change_type_counts(_detected(spark, sf)),
        generated_at=LOADED,
    )


@query
def recon_report(spark: SparkSession, sf: str) -> DataFrame:
    matching = metrics.match_accuracy(_matches(spark, sf), threshold=trials.CONFIDENT)
    report = _report(spark, sf, study_feed(spark, sf), contract_feed(spark, sf)).drop("report_generated_ts").unionByName(matching)
    return report.orderBy("metric_group", "metric_name")


@query
def report_alerts(spark: SparkSession, sf: str) -> DataFrame:
    limits = spark.createDataFrame(
        [
            ("record_count", "record_count_delta", -10.0, 10.0),
            ("delta_load", "delete_count", None, 100000000000.0),
            ("quality", "duplicate_count", None, 0.0),
        ],
        "metric_group string, metric_name string, lowest double, highest double",
    )
    report = _report(spark, sf, study_feed(spark, sf), contract_feed(spark, sf))
    return metrics.threshold_alerts(report, limits).select("metric_group", "metric_name", "metric_value")


# --- the load job -----------------------------------------------------------------------------


def _loaded_job(spark: SparkSession, sf: str) -> Job:
    """Two batches through the whole load job: each feed up to a day, and what came later."""
    root = shared_dir(spark, "lake")
    feeds = {"studies": study_feed, "contracts": contract_feed, "invoices": invoice_feed, "sponsors": sponsor_feed}
    job = Job(spark, f"{root}/lake")
    batches = (Batch("b1", datetime(2026, 1, 20)), Batch("b2", datetime(2026, 3, 1), previous="b1"))

    def deliver(batch: Batch, later: bool, name: str) -> None:
        there = (F.col("batch_date") > ("1997-06-01" if name == "invoices" else "2026-01-14")) == F.lit(later)
        writer = feeds[name](spark, sf).where(there).select(*LIFECYCLE_FEEDS[name][0], "batch_date").write.partitionBy("batch_date").option("header", True)
        with shuffles_dropped(spark):
            writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(f"{root}/landing/{batch.batch_id}/{name}")

    for batch, later in zip(batches, (False, True), strict=True):
        at_once(spark, [partial(deliver, batch, later, name) for name in feeds])
        job.run(batch, {name: f"{root}/landing/{batch.batch_id}/{name}/batch_date=*/*.csv" for name in feeds})
        delete_folder(spark, f"{root}/landing/{batch.batch_id}")  # the raw layer holds all of its lines
    return job


@query
def load_job(spark: SparkSession, sf: str) -> DataFrame:
    """The projects that two batches of the load job leave, changed part by part."""
    return _loaded_job(spark, sf).current("target", "project", "b2").drop("project_external_id_row_hash")


# --- documented extras ------------------------------------------------------------------------


@query
def latest_amendment(spark: SparkSession, sf: str) -> DataFrame:
    newest = top_per_key(contract_feed(spark, sf), ["contract_id"], [F.col("amendment_no").cast("int").desc(), F.col("record_hash")])
    return newest.select("contract_id", "amendment_no", "contract_value")


@query
def parent_rollup(spark: SparkSession, sf: str) -> DataFrame:
    master = _valid(spark, sf, "sponsor").select("sponsor_external_id_std", "sponsor_parent")
    billed = _valid(spark, sf, "invoice").groupBy("sponsor_external_id_std").agg(
        F.sum(F.col("invoice_amount_std").cast("decimal(18,2)")).alias("billed"), F.count("*").alias("invoices")
    )
    joined = billed.join(master, "sponsor_external_id_std", "left")
    return joined.groupBy("sponsor_parent").agg(
        F.sum("billed").cast("double").alias("billed"), F.sum("invoices").alias("invoices"), F.count("*").alias("sponsors")
    )


@query
def parent_rollup_levels(spark: SparkSession, sf: str) -> DataFrame:
    """Balances of customers over nations and regions up to the world."""
    customer, nation, region = (table(spark, sf, t) for t in ("customer", "nation", "region"))

    def node(kind: str, column: str) -> Column:
        return F.concat(F.lit(f"{kind}-"), F.col(column))

    parents = customer.select(node("c", "c_custkey").alias("node"), node("n", "c_nationkey").alias("parent"))
    parents = parents.union(nation.select(node("n", "n_nationkey"), node("r", "n_regionkey")))
    parents = parents.union(region.select(node("r", "r_regionkey"), F.lit("world")))
    found = roll_up(customer.select(node("c", "c_custkey").alias("node"), F.col("c_acctbal").alias("amount")), parents)
    return found.select("node", F.col("amount").cast("double").alias("amount"), "members")


@query
def recon_unparsed(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.unparsed_count(table(spark, sf, "events"), "props", "events").unionByName(
        metrics.unparsed_count(invoice_feed(spark, sf), "invoice_amount", "invoice_total")
    )


@query
def site_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return _valid(spark, sf, "site").groupBy("site_code_std").agg(F.count("*").alias("studies"))


@query
def investigator_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return _valid(spark, sf, "study").groupBy(normalize_text("principal_investigator").alias("investigator")).agg(
        F.countDistinct("site_code_std").alias("sites"), F.count("*").alias("studies")
    )
