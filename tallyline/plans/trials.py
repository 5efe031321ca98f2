"""Studies, contracts, invoices and sponsors: how they are conformed, matched and mapped to the target model."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import normalize_text, normalize_token, safe_date
from tallyline.operators.canonical import map_entity
from tallyline.operators.conform import ConformSpec, blank, conform, split, standardize
from tallyline.operators.dedupe import newest_first, top_per_key
from tallyline.operators.joins import any_key_join, priority_join
from tallyline.operators.match import Dimension, MatchSpec, best_match, similar_values
from tallyline.operators.skew import skew_join

# Raw columns of the four feeds, in file order (fixed values).
STUDY_COLUMNS = (
    "study_id", "study_name", "protocol_no", "sponsor_external_id", "site_code",
    "principal_investigator", "therapeutic_area", "study_status", "start_date", "end_date",
)
CONTRACT_COLUMNS = (
    "contract_id", "contract_name", "study_name", "protocol_no", "sponsor_external_id", "site_code",
    "contract_status", "contract_value", "effective_date", "amendment_no",
)
INVOICE_COLUMNS = (
    "invoice_id", "invoice_number", "contract_name", "protocol_no", "sponsor_external_id",
    "invoice_amount", "paid_amount", "outstanding_amount", "invoice_date", "payment_status",
)
SPONSOR_COLUMNS = (
    "sponsor_external_id", "sponsor_name", "sponsor_parent", "billing_account_id",
    "netsuite_customer_external_id", "sponsor_status",
)

# Weights of the part scores, thresholds of the fuzzy level and of a confident match.
SPONSOR_WEIGHT, STUDY_WEIGHT, CONTRACT_WEIGHT = 0.45, 0.25, 0.30
FUZZY_SPONSOR, FUZZY_CONTRACT = 0.90, 0.85
CONFIDENT = 0.97

_SPONSOR_REQUIRED = {"sponsor_external_id_required": blank("sponsor_external_id_std")}

STUDY = ConformSpec(
    standard={
        "study_name_std": ("text", "study_name"),
        "protocol_no_std": ("token", "protocol_no"),
        "sponsor_external_id_std": ("token", "sponsor_external_id"),
        "site_code_std": ("token", "site_code"),
        "start_date_std": ("date", "start_date"),
        "end_date_std": ("date", "end_date"),
    },
    key=[("text", "study_name"), ("token", "protocol_no"), ("token", "site_code")],
    rules={"protocol_no_required": blank("protocol_no_std"), **_SPONSOR_REQUIRED},
)
CONTRACT = ConformSpec(
    standard={
        "contract_name_std": ("token", "contract_name"),
        "study_name_std": ("text", "study_name"),
        "protocol_no_std": ("token", "protocol_no"),
        "sponsor_external_id_std": ("token", "sponsor_external_id"),
        "effective_date_std": ("date", "effective_date"),
        "contract_value_std": ("currency", "contract_value"),
    },
    key=[("token", "contract_name"), ("token", "protocol_no"), ("token", "sponsor_external_id")],
    rules={**_SPONSOR_REQUIRED, "contract_value_must_be_positive": "contract_value_std <= 0"},
)
INVOICE = ConformSpec(
    standard={
        "contract_name_std": ("token", "contract_name"),
        "protocol_no_std": ("token", "protocol_no"),
        "sponsor_external_id_std": ("token", "sponsor_external_id"),
        "invoice_date_std": ("date", "invoice_date"),
        "invoice_amount_std": ("currency", "invoice_amount"),
        "paid_amount_std": ("currency", "paid_amount"),
        "outstanding_amount_std": ("currency", "outstanding_amount"),
    },
    key=[("token", "invoice_id"), ("token", "invoice_number")],
    rules={
        **_SPONSOR_REQUIRED,
        "invoice_amount_lt_paid_amount": "invoice_amount_std < paid_amount_std",
        "outstanding_mismatch": "outstanding_amount_std <> round(invoice_amount_std - paid_amount_std, 2)",
    },
)
SPONSOR = ConformSpec(
    standard={
        "sponsor_name_std": ("text", "sponsor_name"),
        "sponsor_external_id_std": ("token", "sponsor_external_id"),
    },
    key=[("token", "sponsor_external_id")],
    rules=_SPONSOR_REQUIRED,
)
SITE = ConformSpec(
    standard={
        "site_code_std": ("token", "site_code"),
        "protocol_no_std": ("token", "protocol_no"),
        "study_name_std": ("text", "study_name"),
        "sponsor_external_id_std": ("token", "sponsor_external_id"),
    },
    key=[("token", "site_code"), ("text", "study_name")],
    rules={"site_code_required": blank("site_code_std"), **_SPONSOR_REQUIRED},
)
ENTITIES = {"study": STUDY, "contract": CONTRACT, "invoice": INVOICE, "sponsor": SPONSOR, "site": SITE}


def transform(entity: str, raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected) records of one entity; sites come from the study feed."""
    return split(conform(raw, ENTITIES[entity]))


Stage = Callable[[DataFrame], DataFrame]


def lazily(df: DataFrame) -> DataFrame:
    return df


# --- matching ---------------------------------------------------------------------------------

MATCHING = MatchSpec(
    levels=("sponsor_external_id_std", "protocol_no_std", "contract_name_std", "study_name_std"),
    dimensions=(
        Dimension("sponsor", "sponsor_name_std", SPONSOR_WEIGHT, exact="sponsor_external_id_std"),
        Dimension("study", "study_name_std", STUDY_WEIGHT),
        Dimension("contract", "contract_name_std", CONTRACT_WEIGHT),
    ),
    fuzzy=(("sponsor_name_std", FUZZY_SPONSOR), ("contract_name_std", FUZZY_CONTRACT)),
)
FUZZY_LEVEL = len(MATCHING.levels) + 1

# The form of every match column.
MATCH_FORMS = {
    "study_id_std": "token",
    "contract_id_std": "token",
    "invoice_id_std": "token",
    "protocol_no_std": "token",
    "sponsor_external_id_std": "token",
    "sponsor_name_std": "text",
    "study_name_std": "text",
    "contract_name_std": "text",
}


def with_standardized_keys(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Add match columns (raw name -> standard name); names take the text form, codes the token form."""
    forms = {std: (MATCH_FORMS.get(std, "token"), raw) for raw, std in mapping.items()}
    return standardize(df, forms, null_as_blank=True)


def _recent(df: DataFrame, identity: Sequence[str]) -> list[Column]:
    """Newest batch first, then by identity; the smaller is preferred."""
    order = []
    if "batch_date" in df.columns:
        order.append(F.coalesce(-F.unix_date(safe_date("batch_date")), F.lit(1 << 30)))
    return order + [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in identity]


def sponsor_crosswalk(master: DataFrame, feeds: Iterable[DataFrame], fuzzy: bool = True) -> DataFrame:
    """Every sponsor id used by a feed with its row in the sponsor master.

    Ids are compared as tokens. A feed that names its sponsors (``sponsor_name``) gets a second
    chance for ids the master does not know: the most similar master name of at least 0.90.
    """
    used = None
    named = False
    for feed in feeds:
        has_name = "sponsor_name" in feed.columns
        named = named or has_name
        name = normalize_text("sponsor_name", null_as_blank=True) if has_name else F.lit("")
        ids = feed.select("sponsor_external_id", name.alias("sponsor_name_std")).distinct()
        used = ids if used is None else used.unionByName(ids)
    used = used.distinct().withColumn("_id", normalize_token("sponsor_external_id", null_as_blank=True))

    masters = master.withColumn("_id", normalize_token("sponsor_external_id", null_as_blank=True))
    newest = top_per_key(masters.where(F.col("_id") != ""), ["_id"], _recent(masters, ["sponsor_external_id", "sponsor_name", "billing_account_id"])).select(
        "_id",
        F.col("sponsor_external_id").alias("master_sponsor_external_id"),
        "billing_account_id",
        normalize_text("sponsor_name", null_as_blank=True).alias("_name"),
    )
    found = used.join(newest.drop("_name"), "_id")

    def shaped(df: DataFrame, score: Column, level: int) -> DataFrame:
        none = F.lit(None).cast("double")
        return df.select(
            F.col("sponsor_external_id").alias("source_sponsor_external_id"),
            "master_sponsor_external_id",
            "billing_account_id",
            score.alias("sponsor_match_score"),
            none.alias("study_match_score"),
            none.alias("contract_match_score"),
            score.alias("overall_match_confidence"),
            F.lit(level).alias("match_level"),
        )

    matched = shaped(found, F.lit(1.0), 1).distinct()
    if not (fuzzy and named):
        return matched
    unknown = used.join(newest.select("_id"), "_id", "left_anti").where(F.col("sponsor_name_std") != "")
    names = similar_values(unknown.select("sponsor_name_std"), newest.select("_name"), FUZZY_SPONSOR)
    by_name = top_per_key(newest.where(F.col("_name") != ""), ["_name"], [F.col("_id")])
    close = (
        unknown.join(names, unknown.sponsor_name_std == names.l_value)
        .join(by_name.drop("_id"), F.col("r_value") == F.col("_name"))
    )
    best = top_per_key(
        close, ["sponsor_external_id"], [F.col("similarity").desc(), F.col("r_value"), F.col("l_value")]
    )
    return matched.unionByName(shaped(best, F.col("similarity"), FUZZY_LEVEL))


def study_contract_matches(studies: DataFrame, contracts: DataFrame, stage: Stage = lazily) -> DataFrame:
    """The best contract of every study: by sponsor, protocol or study name, in that order."""
    left = with_standardized_keys(
        studies.select("study_id", "study_name", "protocol_no", "sponsor_external_id"),
        {
            "study_name": "study_name_std",
            "protocol_no": "protocol_no_std",
            "sponsor_external_id": "sponsor_external_id_std",
        },
    ).drop("sponsor_external_id")
    recency = _recent(contracts, [])
    right = with_standardized_keys(
        contracts.select(
            "contract_id", "contract_name", "study_name", "protocol_no", "sponsor_external_id",
            *[r.alias("recency") for r in recency],
        ),
        {
            "contract_name": "contract_name_std",
            "study_name": "study_name_std",
            "protocol_no": "protocol_no_std",
            "sponsor_external_id": "sponsor_external_id_std",
        },
    ).drop("study_name", "protocol_no")
    # newest batch first, then by the columns shown; rows alike in all of them are one and the same
    order = [F.col(c) for c in right.columns if c == "recency"]
    shown = (["study_id", "study_name", "protocol_no"], ["contract_id", "contract_name", "sponsor_external_id"])
    best = best_match(left, right, MATCHING, "study_id", order, stage=None if stage is lazily else stage, shown=shown)
    return best.select(
        F.col("l_study_id").alias("study_id"),
        F.col("l_study_name").alias("study_name"),
        F.col("l_protocol_no").alias("protocol_no"),
        F.col("r_contract_id").alias("contract_id"),
        F.col("r_contract_name").alias("contract_name"),
        F.col("r_sponsor_external_id").alias("sponsor_external_id"),
        "sponsor_match_score",
        "study_match_score",
        "contract_match_score",
        "scored_dims",
        "overall_match_confidence",
        "match_level",
    )


def attach_invoices(matches: DataFrame, invoices: DataFrame) -> DataFrame:
    """One row per study and invoice of the same sponsor with the study's contract name or protocol."""
    keyed = matches.select(
        "*",
        normalize_token("sponsor_external_id").alias("_sponsor"),
        normalize_token("contract_name").alias("_contract"),
        normalize_token("protocol_no").alias("_protocol"),
    )
    billed = invoices.select(
        "invoice_id",
        "invoice_number",
        normalize_token("sponsor_external_id").alias("_sponsor"),
        normalize_token("contract_name").alias("_contract"),
        normalize_token("protocol_no").alias("_protocol"),
    ).distinct()
    joined = any_key_join(keyed, billed, ["_contract", "_protocol"], ["_sponsor"], left_id="study_id", how="left")
    return joined.select(
        *[F.col(f"l_{c}").alias(c) for c in matches.columns],
        F.col("r_invoice_id").alias("invoice_id"),
        F.col("r_invoice_number").alias("invoice_number"),
    )


def study_contract_crosswalk(
    studies: DataFrame, contracts: DataFrame, invoices: DataFrame, stage: Stage = lazily
) -> DataFrame:
    """Best contract and invoices of every study. ``stage=sources.staged`` stores what is read repeatedly."""
    return attach_invoices(stage(study_contract_matches(studies, contracts, stage)), invoices)


def entity_crosswalk(sponsors: DataFrame, study_contracts: DataFrame) -> DataFrame:
    """Study, contract, invoice and master sponsor in one row, with the higher of the two confidences."""
    lookup = sponsors.select(
        F.col("source_sponsor_external_id").alias("sponsor_external_id"),
        "master_sponsor_external_id",
        F.col("overall_match_confidence").alias("_sponsor_confidence"),
    )
    return skew_join(study_contracts, lookup, ["sponsor_external_id"], "left").select(
        "study_id",
        "contract_id",
        "invoice_id",
        "sponsor_external_id",
        "master_sponsor_external_id",
        F.greatest("overall_match_confidence", "_sponsor_confidence").alias("overall_match_confidence"),
        "sponsor_match_score",
        "study_match_score",
        "contract_match_score",
    )


# --- target model -----------------------------------------------------------------------------


def customer_master(sponsors: DataFrame, master: DataFrame) -> DataFrame:
    """One customer per master sponsor. Ids are tokens, as in every other target table."""
    details = top_per_key(master, ["sponsor_external_id"], newest_first(master.columns) or [F.col("sponsor_name")]).select(
        F.col("sponsor_external_id").alias("master_sponsor_external_id"),
        "sponsor_name",
        "sponsor_parent",
        F.col("billing_account_id").alias("_billing"),
        "netsuite_customer_external_id",
        "sponsor_status",
    )
    best = top_per_key(
        sponsors.select("master_sponsor_external_id", "overall_match_confidence"),
        ["master_sponsor_external_id"],
        [F.col("overall_match_confidence").desc_nulls_last()],
    )
    return map_entity(
        best.join(details, "master_sponsor_external_id", "left"),
        {
            "customer_external_id": normalize_token("master_sponsor_external_id"),
            "customer_external_id_raw": "master_sponsor_external_id",
            "netsuite_customer_external_id": "netsuite_customer_external_id",
            "customer_name": "sponsor_name",
            "parent_customer": "sponsor_parent",
            "billing_account_id": "_billing",
            "customer_status": "sponsor_status",
            "match_confidence": "overall_match_confidence",
        },
        key="customer_external_id",
    )


def project_master(studies: DataFrame) -> DataFrame:
    return map_entity(
        studies,
        {
            "project_external_id": "study_id",
            "project_name": "study_name_std",
            "protocol_no": "protocol_no_std",
            "customer_external_id": "sponsor_external_id_std",
            "primary_site_code": "site_code_std",
            "project_start_date": "start_date_std",
            "project_end_date": "end_date_std",
            "project_status": "study_status",
        },
        key="project_external_id",
    )


def _best_link(crosswalk: DataFrame, key: str, extra: Sequence[str]) -> DataFrame:
    """One crosswalk row per ``key``, so that joining it cannot multiply records."""
    return top_per_key(
        crosswalk.where(F.col(key).isNotNull()).select(key, *extra, *_confidence(crosswalk)), [key], _link_order(crosswalk, extra)
    ).select(key, *extra)


def _confidence(crosswalk: DataFrame) -> list[str]:
    return [c for c in ("overall_match_confidence",) if c in crosswalk.columns]


def _link_order(crosswalk: DataFrame, extra: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in _confidence(crosswalk)] + [F.col(c).asc_nulls_last() for c in extra]


def contract_master(contracts: DataFrame, crosswalk: DataFrame) -> DataFrame:
    links = _best_link(crosswalk, "contract_id", ["study_id"])
    one = top_per_key(contracts, ["contract_id"], newest_first(contracts.columns) or [F.col("contract_name_std")])
    return map_entity(
        one.join(links, "contract_id", "left"),
        {
            "contract_external_id": "contract_id",
            "contract_name": "contract_name_std",
            "customer_external_id": "sponsor_external_id_std",
            "project_external_id": "study_id",
            "protocol_no": "protocol_no_std",
            "contract_status": "contract_status",
            "contract_value": "contract_value_std",
            "effective_date": "effective_date_std",
            "amendment_no": "amendment_no",
        },
    )


# What an invoice header takes from its invoice.
_BILLED = (
    "invoice_id", "invoice_number", "protocol_no", "sponsor_external_id_std", "invoice_date_std",
    "payment_status", "invoice_amount_std", "paid_amount_std", "outstanding_amount_std",
)


def invoice_header(invoices: DataFrame, crosswalk: DataFrame, stage: Stage = lazily) -> DataFrame:
    """Invoices with the contract and project found by invoice id, else by protocol. ``stage`` stores the invoices, which are read twice."""
    order = newest_first(invoices.columns) or [F.col("invoice_number")]
    linked = priority_join(
        stage(top_per_key(invoices, ["invoice_id"], order).select(*_BILLED)),
        crosswalk,
        ["invoice_id", "protocol_no"],
        _link_order(crosswalk, ["study_id", "contract_id"]),
        ["contract_id", "study_id"],
        unique=["invoice_id"],
    )
    return map_entity(
        linked,
        {
            "invoice_external_id": "invoice_id",
            "invoice_number": "invoice_number",
            "contract_external_id": "contract_id",
            "project_external_id": "study_id",
            "customer_external_id": "sponsor_external_id_std",
            "invoice_date": "invoice_date_std",
            "payment_status": "payment_status",
            "invoice_total": "invoice_amount_std",
            "amount_paid": "paid_amount_std",
            "amount_due": "outstanding_amount_std",
        },
    )


def invoice_line(header: DataFrame) -> DataFrame:
    """One line per invoice header."""
    return map_entity(
        header,
        {
            "invoice_external_id": "invoice_external_id",
            "line_number": F.lit(1),
            "project_external_id": F.coalesce("project_external_id", F.lit("UNMAPPED")),
            "contract_external_id": F.coalesce("contract_external_id", F.lit("UNMAPPED")),
            "line_amount": "invoice_total",
            "line_description": F.lit("Clinical Trial Billing"),
        },
    )


def open_ar(header: DataFrame) -> DataFrame:
    """Invoices with an amount due; an unknown amount is not open."""
    return header.where(F.col("amount_due") > 0).select(
        "invoice_external_id",
        "invoice_number",
        "customer_external_id",
        "project_external_id",
        "contract_external_id",
        "invoice_date",
        "amount_due",
        "payment_status",
    )


def invoice_export(reconciliation: DataFrame) -> DataFrame:
    return map_entity(
        reconciliation,
        {
            "customer_name": "sponsor_name",
            "project_name": "study_name",
            "invoice_total": "billed_amount",
            "amount_paid": "paid_amount",
            "amount_due": "outstanding_amount",
        },
    )
