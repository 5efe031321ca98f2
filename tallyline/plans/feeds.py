"""The TPC-H tables in the roles of the four feeds, as raw text with the usual disorder.

customer: sponsor master, later partly restated; orders: studies, and contracts with amendments;
lineitem: invoices. Every row of every table is used. Identifiers are spelled differently in each
feed, some are missing, some names carry a typo, some amounts break a rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions import record_hash
from tallyline.operators.skew import skew_join
from tallyline.plans.trials import CONTRACT_COLUMNS, INVOICE_COLUMNS, SPONSOR_COLUMNS, STUDY_COLUMNS

# When the feeds are taken to have been loaded.
LOADED_AT = "2026-03-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _loaded(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return df.select(
        *columns,
        "batch_date",
        F.lit(LOADED_AT).cast("timestamp").alias("ingestion_timestamp"),
        record_hash(columns).alias("record_hash"),
    )


def _amount(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("decimal(18,2)")


def sponsor_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    common = {
        "sponsor_parent": F.concat("c_mktsegment", F.lit(" Group")),
        "billing_account_id": F.concat(F.lit("BA-"), "c_custkey"),
        "netsuite_customer_external_id": F.concat(F.lit("NS-CUST-"), "c_custkey"),
        "sponsor_status": F.when(F.col("c_acctbal") < 0, "Pending").otherwise("Active"),
    }
    first = customer.withColumns(
        {
            **common,
            "sponsor_external_id": F.concat(F.lit("spn-"), "c_custkey"),
            "sponsor_name": F.concat(F.lower("c_name"), F.lit("  "), "c_mktsegment"),
            "batch_date": F.lit("2026-01-01"),
        }
    )
    restated = customer.where(F.col("c_mktsegment") == "BUILDING").withColumns(
        {
            **common,
            "sponsor_external_id": F.when(F.col("c_acctbal") >= -500, F.concat(F.lit("SPN_"), "c_custkey")),
            "sponsor_name": F.concat(F.upper("c_name"), F.lit(" "), "c_mktsegment", F.lit(" Ltd")),
            "batch_date": F.lit("2026-01-15"),
        }
    )
    return _loaded(first.unionByName(restated), SPONSOR_COLUMNS)


def study_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    area = F.substring(priority, 3, 50)
    orders = table(spark, sf_dir, "orders").withColumns(
        {
            "study_id": F.concat(F.lit("STUDY-"), "o_orderkey"),
            "study_name": F.concat(F.lit("Study "), F.lower(area), F.lit("  "), "o_orderkey"),
            "protocol_no": F.when(~((status == "P") & (priority == "5-LOW")), F.concat(F.lit("p-"), "o_orderkey")),
            "sponsor_external_id": F.when((status == "F") & (priority == "1-URGENT"), " ").otherwise(
                F.concat(F.lit("SPN "), "o_custkey")
            ),
            "site_code": F.when((status == "O") & (priority == "3-MEDIUM"), "").otherwise(
                F.concat(F.lit("site-"), F.substring(priority, 1, 1), F.date_format("o_orderdate", "yyyy"))
            ),
            "principal_investigator": F.concat(F.lit("Dr. "), "o_custkey"),
            "therapeutic_area": area,
            "study_status": F.when(status == "O", "Active").when(status == "F", "Closed").otherwise("Planned"),
            "start_date": F.date_format("o_orderdate", "yyyy-MM-dd"),
            "end_date": F.when(status == "P", "open").otherwise(
                F.date_format(F.date_add("o_orderdate", 365), "yyyy-MM-dd")
            ),
            "batch_date": F.when(status == "O", "2026-01-01").when(status == "F", "2026-01-15").otherwise("2026-02-01"),
        }
    )
    return _loaded(orders, STUDY_COLUMNS)


def contract_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    area = F.substring(priority, 3, 50)
    orders = table(spark, sf_dir, "orders")
    common = {
        "contract_id": F.concat(F.lit("CNT-"), "o_orderkey"),
        "study_name": F.when(status == "F", F.concat(F.lit("STUDY  "), F.upper(area), F.lit(" "), "o_orderkey")).when(
            status == "O", F.concat(F.lit("Stdy "), F.lower(area), F.lit(" "), "o_orderkey")
        ),
        "protocol_no": F.concat(F.lit("P_"), "o_orderkey"),
        "sponsor_external_id": F.when(~((status == "O") & (priority == "2-HIGH")), F.concat(F.lit("spn."), "o_custkey")),
        "site_code": F.concat(F.lit("SITE "), F.substring(priority, 1, 1)),
        "contract_status": F.when(status == "F", "Closed").otherwise("Active"),
        "effective_date": F.date_format("o_orderdate", "yyyy-MM-dd"),
    }
    worthless = (status == "P") & (priority == "4-NOT SPECIFIED")
    first = orders.withColumns(
        {
            **common,
            "contract_name": F.concat(F.lit("msa_"), "o_orderkey", F.lit("|master")),
            "contract_value": F.when(worthless, "0").otherwise(_amount("o_totalprice").cast("string")),
            "amendment_no": F.lit("0"),
            "batch_date": F.lit("2026-01-01"),
        }
    )
    amended = orders.where(status == "F").withColumns(
        {
            **common,
            "contract_name": F.concat(F.lit("MSA-"), "o_orderkey", F.lit(" Master")),
            "contract_value": _amount(_amount("o_totalprice") * F.lit("1.05").cast("decimal(3,2)")).cast("string"),
            "amendment_no": F.lit("1"),
            "batch_date": F.lit("2026-02-01"),
        }
    )
    return _loaded(first.unionByName(amended), CONTRACT_COLUMNS)


def invoice_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    owners = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    amount = _amount("l_extendedprice")
    paid = F.when(status == "F", amount).when(flag == "R", _amount(amount + 10)).otherwise(_amount(F.lit(0)))
    wrong = (flag == "N") & (status == "O") & (F.col("l_discount") > 0.08)
    lines = (
        skew_join(table(spark, sf_dir, "lineitem"), owners, ["l_orderkey"], hot=False)
        .withColumns({"_amount": amount, "_paid": paid})
        .withColumns(
            {
                "invoice_id": F.concat(F.lit("INV-"), "l_orderkey", F.lit("-"), "l_linenumber"),
                "invoice_number": F.concat(F.lit("GP"), "l_orderkey", "l_linenumber"),
                "contract_name": F.concat(F.lit("MSA "), "l_orderkey", F.lit(" master")),
                "protocol_no": F.when(flag != "R", F.concat(F.lit("p "), "l_orderkey")),
                "sponsor_external_id": F.when(
                    (flag == "A") & (status == "O") & (F.col("l_linenumber") == 7), ""
                ).otherwise(F.concat(F.lit("SPN-"), "o_custkey")),
                "invoice_amount": F.col("_amount").cast("string"),
                "paid_amount": F.col("_paid").cast("string"),
                "outstanding_amount": _amount(
                    F.col("_amount") - F.col("_paid") + F.when(wrong, 1).otherwise(0)
                ).cast("string"),
                "invoice_date": F.date_format("l_shipdate", "yyyy-MM-dd"),
                "payment_status": F.when(status == "F", "Paid").when(flag == "R", "Overpaid").otherwise("Unpaid"),
                "batch_date": F.date_format("l_shipdate", "yyyy-MM-01"),
            }
        )
    )
    return _loaded(lines, INVOICE_COLUMNS)
