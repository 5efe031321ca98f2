"""The registered queries as SQL, written independently of the operators over the same tables."""

from __future__ import annotations


def text(c: str) -> str:
    return rf"upper(trim(regexp_replace(CAST({c} AS VARCHAR), '\s+', ' ', 'g')))"


def token(c: str) -> str:
    return f"regexp_replace(upper(CAST({c} AS VARCHAR)), '[^A-Z0-9]', '', 'g')"


def blank(c: str) -> str:
    return f"coalesce(trim({c}), '') = ''"


def hashed(columns) -> str:
    return "sha256(concat_ws('||', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns) + "))"


def similar(a: str, b: str) -> str:
    longer = f"greatest(length({a}), length({b}))"
    return f"CASE WHEN {longer} = 0 THEN 1.0::DOUBLE ELSE round(1 - levenshtein({a}, {b})::DOUBLE / {longer}, 4) END"


STUDY = "study_id study_name protocol_no sponsor_external_id site_code principal_investigator therapeutic_area study_status start_date end_date".split()
CONTRACT = "contract_id contract_name study_name protocol_no sponsor_external_id site_code contract_status contract_value effective_date amendment_no".split()
INVOICE = "invoice_id invoice_number contract_name protocol_no sponsor_external_id invoice_amount paid_amount outstanding_amount invoice_date payment_status".split()
SPONSOR = "sponsor_external_id sponsor_name sponsor_parent billing_account_id netsuite_customer_external_id sponsor_status".split()

DAY = "'%Y-%m-%d'"
# name -> (sql, names it reads)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *needs: str) -> None:
    CTES[name] = (sql, needs)


def query(body: str, *needs: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for n in CTES[name][1]:
            visit(n)
        if name not in ordered:
            ordered.append(name)

    for n in needs:
        visit(n)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in ordered) + "\n" + body


def _feed(name: str, sql: str, columns: list[str]) -> None:
    cte(name + "_raw", sql)
    cte(name + "_feed", f"SELECT *, {hashed(columns)} AS record_hash FROM {name}_raw", name + "_raw")


_SPONSOR_COMMON = """c_mktsegment || ' Group' AS sponsor_parent, 'BA-' || c_custkey AS billing_account_id,
  'NS-CUST-' || c_custkey AS netsuite_customer_external_id,
  CASE WHEN c_acctbal < 0 THEN 'Pending' ELSE 'Active' END AS sponsor_status"""
_feed(
    "sponsor",
    f"""SELECT 'spn-' || c_custkey AS sponsor_external_id, lower(c_name) || '  ' || c_mktsegment AS sponsor_name,
  {_SPONSOR_COMMON}, '2026-01-01' AS batch_date FROM customer
UNION ALL
SELECT CASE WHEN c_acctbal >= -500 THEN 'SPN_' || c_custkey END, upper(c_name) || ' ' || c_mktsegment || ' Ltd',
  {_SPONSOR_COMMON}, '2026-01-15' FROM customer WHERE c_mktsegment = 'BUILDING'""",
    SPONSOR,
)
_feed(
    "study",
    f"""SELECT 'STUDY-' || o_orderkey AS study_id,
  'Study ' || lower(substr(o_orderpriority, 3)) || '  ' || o_orderkey AS study_name,
  CASE WHEN NOT (o_orderstatus = 'P' AND o_orderpriority = '5-LOW') THEN 'p-' || o_orderkey END AS protocol_no,
  CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN ' ' ELSE 'SPN ' || o_custkey END AS sponsor_external_id,
  CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '3-MEDIUM' THEN ''
       ELSE 'site-' || substr(o_orderpriority, 1, 1) || strftime(o_orderdate, '%Y') END AS site_code,
  'Dr. ' || o_custkey AS principal_investigator, substr(o_orderpriority, 3) AS therapeutic_area,
  CASE o_orderstatus WHEN 'O' THEN 'Active' WHEN 'F' THEN 'Closed' ELSE 'Planned' END AS study_status,
  strftime(o_orderdate, {DAY}) AS start_date,
  CASE WHEN o_orderstatus = 'P' THEN 'open' ELSE strftime(o_orderdate + INTERVAL 365 DAY, {DAY}) END AS end_date,
  CASE o_orderstatus WHEN 'O' THEN '2026-01-01' WHEN 'F' THEN '2026-01-15' ELSE '2026-02-01' END AS batch_date
FROM orders""",
    STUDY,
)
_CONTRACT_MIDDLE = """CASE o_orderstatus WHEN 'F' THEN 'STUDY  ' || upper(substr(o_orderpriority, 3)) || ' ' || o_orderkey
    WHEN 'O' THEN 'Stdy ' || lower(substr(o_orderpriority, 3)) || ' ' || o_orderkey END AS study_name,
  'P_' || o_orderkey AS protocol_no,
  CASE WHEN NOT (o_orderstatus = 'O' AND o_orderpriority = '2-HIGH') THEN 'spn.' || o_custkey END AS sponsor_external_id,
  'SITE ' || substr(o_orderpriority, 1, 1) AS site_code,
  CASE WHEN o_orderstatus = 'F' THEN 'Closed' ELSE 'Active' END AS contract_status"""
_feed(
    "contract",
    f"""SELECT 'CNT-' || o_orderkey AS contract_id, 'msa_' || o_orderkey || '|master' AS contract_name,
  {_CONTRACT_MIDDLE},
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN '0'
       ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS contract_value,
  strftime(o_orderdate, {DAY}) AS effective_date, '0' AS amendment_no, '2026-01-01' AS batch_date FROM orders
UNION ALL
SELECT 'CNT-' || o_orderkey, 'MSA-' || o_orderkey || ' Master', {_CONTRACT_MIDDLE},
  CAST(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(1.05 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS VARCHAR),
  strftime(o_orderdate, {DAY}), '1', '2026-02-01' FROM orders WHERE o_orderstatus = 'F'""",
    CONTRACT,
)
_feed(
    "invoice",
    f"""SELECT 'INV-' || l_orderkey || '-' || l_linenumber AS invoice_id, 'GP' || l_orderkey || l_linenumber AS invoice_number,
  'MSA ' || l_orderkey || ' master' AS contract_name,
  CASE WHEN l_returnflag <> 'R' THEN 'p ' || l_orderkey END AS protocol_no,
  CASE WHEN l_returnflag = 'A' AND l_linestatus = 'O' AND l_linenumber = 7 THEN '' ELSE 'SPN-' || o_custkey END AS sponsor_external_id,
  CAST(amount AS VARCHAR) AS invoice_amount, CAST(paid AS VARCHAR) AS paid_amount,
  CAST(CAST(amount - paid + CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' AND l_discount > 0.08 THEN 1 ELSE 0 END
       AS DECIMAL(18,2)) AS VARCHAR) AS outstanding_amount,
  strftime(l_shipdate, {DAY}) AS invoice_date,
  CASE WHEN l_linestatus = 'F' THEN 'Paid' WHEN l_returnflag = 'R' THEN 'Overpaid' ELSE 'Unpaid' END AS payment_status,
  strftime(l_shipdate, '%Y-%m-01') AS batch_date
FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount,
        CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS DECIMAL(18,2))
             WHEN l_returnflag = 'R' THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) + 10 AS DECIMAL(18,2))
             ELSE CAST(0 AS DECIMAL(18,2)) END AS paid
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    INVOICE,
)


def _date(c: str) -> str:
    return f"CAST(try_strptime({c}, {DAY}) AS DATE)"


def _money(c: str) -> str:
    return f"round(TRY_CAST({c} AS DOUBLE), 2)"


def _conformed(entity: str, feed: str, key: str, std: dict[str, str], rules: dict[str, str]) -> None:
    """Deduplicate on the key, rows without any key apart, then standardize and judge."""
    standard = ", ".join(f"{sql} AS {name}" for name, sql in std.items())
    reasons = ", ".join(f"CASE WHEN {rule} THEN '{code}' END" for code, rule in rules.items())
    cte(
        f"{entity}_newest",
        f"""SELECT * FROM (SELECT *, {key} AS business_key FROM {feed})
QUALIFY replace(business_key, '|', '') = ''
  OR row_number() OVER (PARTITION BY business_key ORDER BY batch_date DESC, record_hash) = 1""",
        feed,
    )
    cte(f"{entity}_std", f"SELECT *, {standard} FROM {entity}_newest", f"{entity}_newest")
    cte(f"{entity}_conformed", f"SELECT *, concat_ws('|', {reasons}) AS invalid_reason FROM {entity}_std", f"{entity}_std")
    cte(f"{entity}_valid", f"SELECT * FROM {entity}_conformed WHERE invalid_reason = ''", f"{entity}_conformed")


def key(*parts: str) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce({p}, '')" for p in parts) + ")"


_NEED_SPONSOR = {"sponsor_external_id_required": blank("sponsor_external_id_std")}
_conformed(
    "study",
    "study_feed",
    key(text("study_name"), token("protocol_no"), token("site_code")),
    {
        "study_name_std": text("study_name"),
        "protocol_no_std": token("protocol_no"),
        "sponsor_external_id_std": token("sponsor_external_id"),
        "site_code_std": token("site_code"),
        "start_date_std": _date("start_date"),
        "end_date_std": _date("end_date"),
    },
    {"protocol_no_required": blank("protocol_no_std"), **_NEED_SPONSOR},
)
_conformed(
    "contract",
    "contract_feed",
    key(token("contract_name"), token("protocol_no"), token("sponsor_external_id")),
    {
        "contract_name_std": token("contract_name"),
        "study_name_std": text("study_name"),
        "protocol_no_std": token("protocol_no"),
        "sponsor_external_id_std": token("sponsor_external_id"),
        "effective_date_std": _date("effective_date"),
        "contract_value_std": _money("contract_value"),
    },
    {**_NEED_SPONSOR, "contract_value_must_be_positive": "contract_value_std <= 0"},
)
_conformed(
    "invoice",
    "invoice_feed",
    key(token("invoice_id"), token("invoice_number")),
    {
        "contract_name_std": token("contract_name"),
        "protocol_no_std": token("protocol_no"),
        "sponsor_external_id_std": token("sponsor_external_id"),
        "invoice_date_std": _date("invoice_date"),
        "invoice_amount_std": _money("invoice_amount"),
        "paid_amount_std": _money("paid_amount"),
        "outstanding_amount_std": _money("outstanding_amount"),
    },
    {
        **_NEED_SPONSOR,
        "invoice_amount_lt_paid_amount": "invoice_amount_std < paid_amount_std",
        "outstanding_mismatch": "outstanding_amount_std <> round(invoice_amount_std - paid_amount_std, 2)",
    },
)
_conformed(
    "sponsor",
    "sponsor_feed",
    key(token("sponsor_external_id")),
    {"sponsor_name_std": text("sponsor_name"), "sponsor_external_id_std": token("sponsor_external_id")},
    _NEED_SPONSOR,
)
_conformed(
    "site",
    "study_feed",
    key(token("site_code"), text("study_name")),
    {
        "site_code_std": token("site_code"),
        "protocol_no_std": token("protocol_no"),
        "study_name_std": text("study_name"),
        "sponsor_external_id_std": token("sponsor_external_id"),
    },
    {"site_code_required": blank("site_code_std"), **_NEED_SPONSOR},
)

# --- matching ---------------------------------------------------------------------------------

cte(
    "sponsor_xwalk",
    f"""SELECT u.sponsor_external_id AS source_sponsor_external_id, m.sponsor_external_id AS master_sponsor_external_id,
  m.billing_account_id, 1.0::DOUBLE AS sponsor_match_score, NULL::DOUBLE AS study_match_score,
  NULL::DOUBLE AS contract_match_score, 1.0::DOUBLE AS overall_match_confidence, 1 AS match_level
FROM (SELECT sponsor_external_id FROM study_feed UNION SELECT sponsor_external_id FROM contract_feed
      UNION SELECT sponsor_external_id FROM invoice_feed) u
JOIN (SELECT * FROM sponsor_feed WHERE {token('sponsor_external_id')} <> ''
      QUALIFY row_number() OVER (PARTITION BY {token('sponsor_external_id')} ORDER BY batch_date DESC, sponsor_external_id, sponsor_name, billing_account_id) = 1) m
  ON {token('u.sponsor_external_id')} = {token('m.sponsor_external_id')}""",
    "study_feed",
    "contract_feed",
    "invoice_feed",
    "sponsor_feed",
)
cte(
    "match_left",
    f"""SELECT DISTINCT study_id, study_name, protocol_no, coalesce({text('study_name')}, '') AS n,
  coalesce({token('protocol_no')}, '') AS p, coalesce({token('sponsor_external_id')}, '') AS s FROM study_feed""",
    "study_feed",
)
cte(
    "match_right",
    f"""SELECT contract_id, contract_name, sponsor_external_id, batch_date, coalesce({text('study_name')}, '') AS n,
  coalesce({token('protocol_no')}, '') AS p, coalesce({token('sponsor_external_id')}, '') AS s FROM contract_feed""",
    "contract_feed",
)
cte(
    "match_pairs",
    """SELECT l.*, r.contract_id, r.contract_name, r.sponsor_external_id, r.batch_date, r.n AS rn, r.p AS rp, r.s AS rs
FROM match_left l JOIN match_right r ON l.s = r.s AND l.s <> ''
UNION SELECT l.*, r.contract_id, r.contract_name, r.sponsor_external_id, r.batch_date, r.n, r.p, r.s
FROM match_left l JOIN match_right r ON l.p = r.p AND l.p <> ''
UNION SELECT l.*, r.contract_id, r.contract_name, r.sponsor_external_id, r.batch_date, r.n, r.p, r.s
FROM match_left l JOIN match_right r ON l.n = r.n AND l.n <> ''""",
    "match_left",
    "match_right",
)
cte(
    "match_scored",
    f"""SELECT *, CASE WHEN s <> '' AND s = rs THEN 1 WHEN p <> '' AND p = rp THEN 2 WHEN n <> '' AND n = rn THEN 4 END AS match_level,
  CASE WHEN s <> '' AND s = rs THEN 1.0::DOUBLE END AS sponsor_match_score,
  CASE WHEN n <> '' AND n = rn THEN 1.0::DOUBLE WHEN n <> '' AND rn <> '' THEN {similar('n', 'rn')} END AS study_match_score
FROM match_pairs""",
    "match_pairs",
)
cte(
    "match_best",
    """SELECT *, CAST((sponsor_match_score IS NOT NULL) AS INT) + CAST((study_match_score IS NOT NULL) AS INT) AS scored_dims,
  CASE WHEN sponsor_match_score IS NULL AND study_match_score IS NULL THEN 0.0::DOUBLE ELSE round(
    (coalesce(sponsor_match_score * 0.45::DOUBLE, 0) + coalesce(study_match_score * 0.25::DOUBLE, 0))
    / (CASE WHEN sponsor_match_score IS NULL THEN 0::DOUBLE ELSE 0.45::DOUBLE END
       + CASE WHEN study_match_score IS NULL THEN 0::DOUBLE ELSE 0.25::DOUBLE END), 4) END AS overall_match_confidence
FROM match_scored
QUALIFY row_number() OVER (PARTITION BY study_id ORDER BY match_level, overall_match_confidence DESC, scored_dims DESC,
  batch_date DESC, contract_id, contract_name, sponsor_external_id) = 1""",
    "match_scored",
)
MATCH_COLUMNS = """study_id, study_name, protocol_no, contract_id, contract_name, sponsor_external_id, sponsor_match_score,
  study_match_score, CAST(NULL AS DOUBLE) AS contract_match_score, scored_dims, overall_match_confidence, match_level"""
cte("match_final", f"SELECT {MATCH_COLUMNS} FROM match_best", "match_best")
cte(
    "study_xwalk",
    f"""SELECT c.*, g.invoice_id, g.invoice_number FROM match_final c LEFT JOIN (
  SELECT DISTINCT invoice_id, invoice_number, {token('sponsor_external_id')} AS s, {token('contract_name')} AS c,
    {token('protocol_no')} AS p FROM invoice_feed) g
ON {token('c.sponsor_external_id')} = g.s AND g.s <> '' AND (
  ({token('c.contract_name')} = g.c AND g.c <> '') OR ({token('c.protocol_no')} = g.p AND g.p <> ''))""",
    "match_final",
    "invoice_feed",
)
cte(
    "entity_xwalk",
    """SELECT sc.study_id, sc.contract_id, sc.invoice_id, sc.sponsor_external_id, sp.master_sponsor_external_id,
  greatest(sc.overall_match_confidence, sp.overall_match_confidence) AS overall_match_confidence,
  sc.sponsor_match_score, sc.study_match_score, sc.contract_match_score
FROM study_xwalk sc LEFT JOIN sponsor_xwalk sp ON sc.sponsor_external_id = sp.source_sponsor_external_id""",
    "study_xwalk",
    "sponsor_xwalk",
)

# --- target model -----------------------------------------------------------------------------

cte(
    "customers",
    f"""SELECT {token('x.id')} AS customer_external_id, x.id AS customer_external_id_raw, m.netsuite_customer_external_id,
  m.sponsor_name AS customer_name, m.sponsor_parent AS parent_customer, m.billing_account_id,
  m.sponsor_status AS customer_status, x.conf AS match_confidence
FROM (SELECT master_sponsor_external_id AS id, max(overall_match_confidence) AS conf FROM sponsor_xwalk GROUP BY 1) x
LEFT JOIN (SELECT * FROM sponsor_feed QUALIFY row_number() OVER (PARTITION BY sponsor_external_id ORDER BY batch_date DESC, record_hash) = 1) m
  ON x.id = m.sponsor_external_id
QUALIFY row_number() OVER (PARTITION BY customer_external_id ORDER BY x.id) = 1""",
    "sponsor_xwalk",
    "sponsor_feed",
)
cte(
    "projects",
    """SELECT study_id AS project_external_id, study_name_std AS project_name, protocol_no_std AS protocol_no,
  sponsor_external_id_std AS customer_external_id, site_code_std AS primary_site_code, start_date_std AS project_start_date,
  end_date_std AS project_end_date, study_status AS project_status
FROM study_valid QUALIFY row_number() OVER (PARTITION BY study_id ORDER BY batch_date DESC, record_hash) = 1""",
    "study_valid",
)
cte(
    "contracts",
    """SELECT c.contract_id AS contract_external_id, contract_name_std AS contract_name,
  sponsor_external_id_std AS customer_external_id, x.study_id AS project_external_id, protocol_no_std AS protocol_no,
  contract_status, contract_value_std AS contract_value, effective_date_std AS effective_date, amendment_no
FROM (SELECT * FROM contract_valid QUALIFY row_number() OVER (PARTITION BY contract_id ORDER BY batch_date DESC, record_hash) = 1) c
LEFT JOIN (SELECT contract_id, study_id FROM match_final
  QUALIFY row_number() OVER (PARTITION BY contract_id ORDER BY overall_match_confidence DESC, study_id) = 1) x
  ON c.contract_id = x.contract_id""",
    "contract_valid",
    "match_final",
)
cte(
    "link_invoice",
    """SELECT invoice_id, contract_id, study_id FROM study_xwalk WHERE invoice_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY invoice_id ORDER BY overall_match_confidence DESC, study_id, contract_id) = 1""",
    "study_xwalk",
)
cte(
    "link_protocol",
    """SELECT protocol_no, contract_id, study_id FROM study_xwalk WHERE coalesce(trim(protocol_no), '') <> ''
QUALIFY row_number() OVER (PARTITION BY protocol_no ORDER BY overall_match_confidence DESC, study_id, contract_id) = 1""",
    "study_xwalk",
)
cte(
    "headers",
    """SELECT i.invoice_id AS invoice_external_id, i.invoice_number,
  CASE WHEN a.invoice_id IS NOT NULL THEN a.contract_id ELSE b.contract_id END AS contract_external_id,
  CASE WHEN a.invoice_id IS NOT NULL THEN a.study_id ELSE b.study_id END AS project_external_id,
  i.sponsor_external_id_std AS customer_external_id, i.invoice_date_std AS invoice_date, i.payment_status,
  i.invoice_amount_std AS invoice_total, i.paid_amount_std AS amount_paid, i.outstanding_amount_std AS amount_due
FROM (SELECT * FROM invoice_valid QUALIFY row_number() OVER (PARTITION BY invoice_id ORDER BY batch_date DESC, record_hash) = 1) i
LEFT JOIN link_invoice a ON i.invoice_id = a.invoice_id LEFT JOIN link_protocol b ON i.protocol_no = b.protocol_no""",
    "invoice_valid",
    "link_invoice",
    "link_protocol",
)
cte(
    "lines",
    """SELECT invoice_external_id, 1 AS line_number, coalesce(project_external_id, 'UNMAPPED') AS project_external_id,
  coalesce(contract_external_id, 'UNMAPPED') AS contract_external_id, invoice_total AS line_amount,
  'Clinical Trial Billing' AS line_description FROM headers""",
    "headers",
)
cte(
    "open_items",
    """SELECT invoice_external_id, invoice_number, customer_external_id, project_external_id, contract_external_id,
  invoice_date, amount_due, payment_status FROM headers WHERE amount_due > 0""",
    "headers",
)

# --- snapshots --------------------------------------------------------------------------------

_FIELDS = ("o_custkey", "o_orderstatus", "price", "o_orderpriority")


def _snapshot(name: str, status: str, where: str) -> None:
    cte(
        name,
        f"""SELECT *, {hashed(_FIELDS)} AS record_hash FROM (
  SELECT o_orderkey, o_custkey, {status} AS o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
    o_orderpriority FROM orders WHERE {where})""",
    )


_snapshot(
    "snap1",
    "CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderstatus = 'F' THEN 'O' ELSE o_orderstatus END",
    "o_orderdate < TIMESTAMP '2001-01-01'",
)
_snapshot("snap2", "o_orderstatus", "o_orderdate >= TIMESTAMP '1996-01-01'")
_snapshot("snap3", "o_orderstatus", "true")
cte(
    "detected",
    """SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey, s.o_custkey, s.o_orderstatus, s.price, s.o_orderpriority,
  coalesce(s.record_hash, t.record_hash) AS record_hash,
  CASE WHEN t.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'delete'
       WHEN s.record_hash <> t.record_hash THEN 'update' ELSE 'no_change' END AS change_type,
  CAST(coalesce(s.o_orderkey, t.o_orderkey) AS VARCHAR) AS delta_business_key
FROM snap2 s FULL JOIN snap1 t ON s.o_orderkey = t.o_orderkey""",
    "snap1",
    "snap2",
)
cte(
    "stacked",
    """SELECT 1 AS n, TIMESTAMP '2026-01-01' AS t, TIMESTAMP '2026-02-01' AS nxt, * FROM snap1
UNION ALL SELECT 2, TIMESTAMP '2026-02-01', TIMESTAMP '2026-03-01', * FROM snap2
UNION ALL SELECT 3, TIMESTAMP '2026-03-01', NULL, * FROM snap3""",
    "snap1",
    "snap2",
    "snap3",
)
cte(
    "islands",
    """SELECT *, n - row_number() OVER (PARTITION BY o_orderkey, record_hash ORDER BY n) AS island FROM stacked""",
    "stacked",
)
_SCD2 = """SELECT o_orderkey, min(o_custkey) AS o_custkey, min(o_orderstatus) AS o_orderstatus, min(price) AS price,
  min(o_orderpriority) AS o_orderpriority, record_hash, min(t) AS effective_from_ts,
  arg_max(nxt_or_end, n) AS effective_to_ts, max(n) = 3 AS is_current
FROM (SELECT *, CASE WHEN nxt IS NULL THEN NULL ELSE nxt END AS nxt_or_end FROM islands)
GROUP BY o_orderkey, record_hash, island"""
# arg_max skips NULL ends, so the open version is set by hand
_SCD2 = _SCD2.replace("arg_max(nxt_or_end, n)", "CASE WHEN max(n) = 3 THEN NULL ELSE max(nxt_or_end) END")

# --- receivables ------------------------------------------------------------------------------

cte(
    "billed",
    """SELECT 'C-' || o_custkey AS sponsor_name, o_orderpriority AS study_name, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS v
FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2""",
)
cte(
    "paid",
    """SELECT 'C-' || o_custkey AS sponsor_name, o_orderpriority AS study_name, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'F' GROUP BY 1, 2""",
)
_AR = """SELECT sponsor_name, study_name, CAST({b} AS DOUBLE) AS billed_amount, CAST(coalesce(p.v, 0) AS DOUBLE) AS paid_amount,
  CAST({b} - coalesce(p.v, 0) AS DOUBLE) AS outstanding_amount FROM billed b {how} JOIN paid p USING (sponsor_name, study_name)"""

SQL: dict[str, str] = {}

_MESSY = r"'  ' || p_name || ' ' || chr(9) || ' ' || lower(p_type) || chr(10)"
SQL["normalize_texts"] = f"SELECT p_partkey, {text(_MESSY)} AS text_std, {token(_MESSY)} AS token_std FROM part"
# Unicode upper case of a sharp s is SS
_TEXT = token("replace(text, 'ß', 'SS')")
SQL["normalize_documents"] = (
    f"SELECT doc_id, CAST(length({_TEXT}) AS BIGINT) AS token_length, sha256({_TEXT}) AS token_hash FROM documents"
)
_NAME = "CASE WHEN c_acctbal >= 0 THEN ' ' || c_name || '  ' || c_mktsegment END"
SQL["normalize_null_forms"] = f"""SELECT c_custkey, {text(_NAME)} AS text_null, coalesce({text(_NAME)}, '') AS text_blank,
  {token(_NAME)} AS token_null, coalesce({token(_NAME)}, '') AS token_blank FROM customer"""
_LABEL = "p_name || '/' || p_type"
SQL["normalize_keys_in_place"] = f"SELECT p_partkey, {token('p_brand')} AS p_brand, {token(_LABEL)} AS p_label FROM part"
SQL["standardized_keys"] = query(
    f"""SELECT contract_id, amendment_no, {token('contract_id')} AS contract_id_std, {text('contract_name')} AS contract_name_std,
  coalesce({text('study_name')}, '') AS study_name_std, coalesce({token('sponsor_external_id')}, '') AS sponsor_external_id_std
FROM contract_feed""",
    "contract_feed",
)
SQL["business_keys"] = """SELECT c_custkey, concat_ws('|', c_name, CASE WHEN c_acctbal >= 0 THEN c_mktsegment ELSE '' END,
  CAST(c_nationkey AS VARCHAR)) AS business_key FROM customer"""
SQL["reject_reasons"] = """SELECT concat_ws('|', CASE WHEN l_quantity > 45 THEN 'quantity_high' END,
  CASE WHEN l_discount > 0.05::DOUBLE THEN 'discounted' END, CASE WHEN l_returnflag = 'R' THEN 'returned' END) AS reasons,
  count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity FROM lineitem GROUP BY 1"""
SQL["batch_dates"] = """SELECT CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE '' END AS batch_date,
  count(*) AS n FROM orders GROUP BY 1"""
SQL["name_similarity"] = f"""SELECT p_partkey, {similar('a', 'b')} AS score, {similar('a', "''")} AS against_blank
FROM (SELECT p_partkey, {text('p_name')} AS a, {text("p_type || ' ' || p_name")} AS b FROM part)"""
SQL["safe_dates"] = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN CAST(o_orderdate AS DATE) END AS order_date FROM orders"""
SQL["safe_amounts"] = r"""SELECT event_id, CASE WHEN event_type <> 'error'
  THEN CAST(regexp_extract(props, '(\d+)', 1) AS DOUBLE) + 0.13 END AS amount, value FROM events"""
SQL["outstanding_amounts"] = query(
    """SELECT record_hash, CAST(CAST(invoice_amount AS DECIMAL(18,2)) - CAST(paid_amount AS DECIMAL(18,2)) AS DOUBLE) AS outstanding
FROM invoice_feed""",
    "invoice_feed",
)
SQL["weighted_scores"] = f"""SELECT p_partkey,
  round((a * 0.45::DOUBLE + coalesce(b * 0.25::DOUBLE, 0)) / (0.45::DOUBLE + CASE WHEN b IS NULL THEN 0 ELSE 0.25::DOUBLE END), 4) AS renormalized,
  round(a * 0.45::DOUBLE + coalesce(b * 0.25::DOUBLE, 0), 4) AS plain
FROM (SELECT p_partkey, {similar('upper(p_name)', 'upper(p_type)')} AS a,
  CASE WHEN p_size > 10 THEN {similar('p_brand', "'Brand#12'")} END AS b FROM part)"""
SQL["record_hashes"] = f"SELECT c_custkey, {hashed(('c_custkey', 'c_name', 'c_nationkey', 'c_mktsegment'))} AS record_hash FROM customer"

_LANDED = f"""SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment,
  CASE WHEN c_acctbal < 0 THEN '2026-01-15' ELSE '2026-01-01' END AS batch_date, 'crm' AS source_system, 'load-1' AS load_id,
  {hashed(('c_custkey', 'c_name', 'c_mktsegment'))} AS record_hash FROM customer"""
SQL["ingest_csv_batches"] = SQL["ingest_json_batches"] = _LANDED
_SPOILT = """SELECT c_custkey % 11 AS r, CAST(c_custkey AS VARCHAR) AS k, c_name AS n, c_mktsegment AS s FROM customer"""
SQL["malformed_csv"] = f"""SELECT CASE WHEN e IS NULL THEN k END AS c_custkey, CASE WHEN e IS NULL THEN n || ', Ltd' END AS c_name,
  CASE WHEN e IS NULL THEN s END AS c_mktsegment, e AS parse_error,
  CASE r WHEN 1 THEN k || ',' || n WHEN 2 THEN k || ',' || n || ',' || s || ',x' WHEN 3 THEN k || ',' || n || ',"' || s
    WHEN 4 THEN k || ',"' || n || '" x,' || s END AS raw_line
FROM (SELECT *, CASE r WHEN 1 THEN 'too_few_fields' WHEN 2 THEN 'too_many_fields' WHEN 3 THEN 'bad_quote' WHEN 4 THEN 'bad_quote' END AS e FROM ({_SPOILT}))"""
SQL["malformed_json"] = f"""SELECT CASE WHEN e IS NULL THEN k END AS c_custkey, CASE WHEN e IS NULL THEN n END AS c_name,
  CASE WHEN e IS NULL THEN s END AS c_mktsegment, e AS parse_error,
  CASE r WHEN 1 THEN left('{{"c_custkey":' || k || ',"c_name":"' || n || '"}}', 20)
    WHEN 2 THEN '[{{"c_custkey":"' || k || '","c_name":"' || n || '","c_mktsegment":"' || s || '"}}]' WHEN 3 THEN n END AS raw_line
FROM (SELECT *, CASE WHEN r IN (1, 2, 3) THEN 'not_a_json_object' END AS e FROM ({_SPOILT}))"""
_DRIFTED = """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CASE WHEN c_custkey % 3 < 2 THEN c_mktsegment END AS c_mktsegment,
  CASE WHEN c_custkey % 3 = 2 THEN CAST(c_nationkey AS VARCHAR) END AS c_nationkey FROM customer"""
SQL["stream_schema_drift"] = f"""SELECT *, CAST(CASE WHEN c_nationkey IS NULL THEN 1 ELSE 2 END AS INTEGER) AS schema_version,
  'crm' AS source_system, 'load-1' AS load_id,
  CASE WHEN c_nationkey IS NULL THEN {hashed(("c_custkey", "c_name", "c_mktsegment"))} ELSE {hashed(("c_custkey", "c_name", "c_nationkey"))} END AS record_hash
FROM ({_DRIFTED})"""
SQL["stream_schema_rescued"] = f"""SELECT c_custkey, c_name, c_mktsegment, CAST(1 AS INTEGER) AS schema_version,
  coalesce('c_nationkey=' || c_nationkey, '') AS rescued FROM ({_DRIFTED})"""
SQL["raw_append"] = query(
    "SELECT batch_date, count(*) AS n, count(DISTINCT record_hash) AS hashes FROM study_feed GROUP BY 1", "study_feed"
)
SQL["stream_ingest"] = f"""SELECT event_id, user_id, event_type, props, 'events' AS source_system, 'load-1' AS load_id,
  {hashed(('event_id', 'user_id', 'event_type', 'props'))} AS record_hash FROM events"""
SQL["stream_upsert"] = SQL["dedupe_latest"] = """SELECT user_id, event_id, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""

_EVENT = "CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(value AS VARCHAR) AS value"
SQL["stream_csv_ingest"] = f"""SELECT *, 'events' AS source_system, 'load-1' AS load_id,
  {hashed(('event_id', 'ts', 'user_id', 'event_type', 'value'))} AS record_hash FROM (SELECT {_EVENT} FROM events)"""
SQL["stream_upsert_batches"] = f"""SELECT user_id, event_id, event_type, ts FROM (SELECT {_EVENT} FROM events
  QUALIFY row_number() OVER (PARTITION BY events.user_id ORDER BY events.ts DESC, events.event_id DESC) = 1)
WHERE event_type <> 'error'"""
cte(
    "user_states",
    f"""SELECT n, user_id, event_type, value, {hashed(("event_type", "value"))} AS record_hash, event_type = 'error' AS gone FROM (
  SELECT n, user_id, event_type, round(value, 0) AS value FROM events, range(3) loads(n) WHERE event_id % 3 <= n
  QUALIFY row_number() OVER (PARTITION BY n, user_id ORDER BY ts DESC, event_id DESC) = 1)""",
)
cte(
    "user_changes",
    """SELECT now.n, now.user_id, now.event_type, now.value, now.record_hash, old.record_hash AS old_hash,
  CASE WHEN now.gone THEN CASE WHEN old.gone = false THEN 'delete' END WHEN old.gone IS NULL OR old.gone THEN 'insert'
       WHEN now.record_hash <> old.record_hash THEN 'update' END AS change_type
FROM user_states now LEFT JOIN user_states old ON old.user_id = now.user_id AND old.n = now.n - 1""",
    "user_states",
)
SQL["stream_changes"] = query(
    """SELECT CAST(n AS INTEGER) AS batch_id, user_id, change_type, CASE WHEN change_type <> 'delete' THEN event_type END AS event_type,
  CASE WHEN change_type <> 'delete' THEN value END AS value, CASE WHEN change_type = 'delete' THEN old_hash ELSE record_hash END AS record_hash,
  CAST(user_id AS VARCHAR) AS delta_business_key
FROM user_changes WHERE change_type IS NOT NULL""",
    "user_changes",
)
SQL["stream_changes_folded"] = query("SELECT user_id, event_type, value, record_hash FROM user_states WHERE n = 2 AND NOT gone", "user_states")
SQL["written_versions"] = """SELECT CAST(1 AS INTEGER) AS version, o_orderkey, o_custkey, o_orderstatus FROM orders
UNION ALL SELECT 2, o_orderkey, o_custkey, lower(o_orderstatus) FROM orders WHERE o_orderstatus <> 'F'"""
SQL["whole_row_distinct"] = "SELECT DISTINCT * FROM lineitem"
SQL["parent_rollup_levels"] = """SELECT node, CAST(sum(amount) AS DOUBLE) AS amount, count(*) AS members FROM (
  SELECT unnest(['c-' || c_custkey, 'n-' || c_nationkey, 'r-' || n_regionkey, 'world']) AS node, CAST(c_acctbal AS DECIMAL(38,2)) AS amount
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) GROUP BY node"""
SQL["recon_unparsed"] = query(
    """SELECT 'events' AS metric_group, 'unparsed_count' AS metric_name, CAST(count(*) FILTER (trim(props) <> ''
    AND TRY_CAST(props AS DECIMAL(18,2)) IS NULL) AS DOUBLE) AS metric_value FROM events
UNION ALL SELECT 'invoice_total', 'unparsed_count', CAST(count(*) FILTER (trim(invoice_amount) <> ''
    AND TRY_CAST(invoice_amount AS DECIMAL(18,2)) IS NULL) AS DOUBLE) FROM invoice_feed""",
    "invoice_feed",
)

_COUNT_BLANK = ", ".join(f"count(*) FILTER ({blank(c)}) AS {c}" for c in ("study_id", "protocol_no", "sponsor_external_id", "site_code"))
SQL["required_violations"] = query(f"SELECT {_COUNT_BLANK} FROM study_feed", "study_feed")
SQL["completeness_gate"] = query(
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, round(avg(CASE WHEN {blank(c)} THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END), 6) AS completeness,
  avg(CASE WHEN {blank(c)} THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END) >= 0.95 AS passed FROM study_feed"""
        for c in ("study_id", "protocol_no", "sponsor_external_id")
    ),
    "study_feed",
)
_GATED = ("study_id", "protocol_no", "sponsor_external_id")
_FILLED = f"NOT {blank('protocol_no')} AND NOT {blank('sponsor_external_id')}"
_VERSIONS = {"1": _FILLED, "2": "true", "3": f"{_FILLED} AND batch_date > '2026-01-01'"}
SQL["gated_publication"] = query(
    "SELECT *, coalesce(max(version) FILTER (held = 0) OVER (ORDER BY version RANGE UNBOUNDED PRECEDING), NULL) AS published_then FROM (SELECT *, sum(CASE WHEN passed THEN 0 ELSE 1 END) OVER (PARTITION BY version) AS held FROM ("
    + " UNION ALL ".join(
        f"SELECT '{v}' AS version, 'completeness_{c}' AS metric_name, round(avg(CASE WHEN {blank(c)} THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END), 6) AS metric_value, "
        f"coalesce(avg(CASE WHEN {blank(c)} THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END) >= 0.98, true) AS passed FROM study_feed WHERE {there}"
        for v, there in _VERSIONS.items()
        for c in _GATED
    )
    + "))",
    "study_feed",
)
SQL["gated_publication"] = SQL["gated_publication"].replace("SELECT *, coalesce(max", "SELECT version, metric_name, metric_value, passed, coalesce(max", 1)
_ORPHAN = """FROM orders o WHERE o_orderpriority = '5-LOW' OR NOT EXISTS (
  SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal >= 0)"""
SQL["orphan_rows"] = "SELECT o_orderkey " + _ORPHAN
SQL["orphan_total"] = "SELECT count(*) AS orphan_count " + _ORPHAN
SQL["rule_check_counts"] = query(
    f"""SELECT 'study_protocol_required' AS rule, count(*) AS violations FROM study_conformed WHERE {blank('protocol_no_std')}
UNION ALL SELECT 'sponsor_external_id_required', count(*) FROM study_conformed WHERE {blank('sponsor_external_id_std')}
UNION ALL SELECT 'invoice_amount_gte_paid', count(*) FROM invoice_conformed WHERE invoice_amount_std < paid_amount_std
UNION ALL SELECT 'outstanding_matches_formula', count(*) FROM invoice_conformed
  WHERE round(invoice_amount_std - paid_amount_std, 2) <> outstanding_amount_std
UNION ALL SELECT 'contract_value_positive', count(*) FROM contract_conformed WHERE contract_value_std <= 0""",
    "study_conformed",
    "invoice_conformed",
    "contract_conformed",
)
SQL["rule_counts_one_pass"] = f"""SELECT 'quantity_high' AS rule, count(*) AS violations FROM lineitem WHERE l_quantity > 45
UNION ALL SELECT 'discount_high', count(*) FROM lineitem WHERE l_discount > 0.08::DOUBLE
UNION ALL SELECT 'flag_blank', count(*) FROM lineitem WHERE {blank('l_returnflag')}"""

_SHOWN = {
    "study": "study_id, study_name_std, protocol_no_std, sponsor_external_id_std, site_code_std, start_date_std, end_date_std",
    "contract": "contract_id, contract_name_std, study_name_std, sponsor_external_id_std, effective_date_std, contract_value_std, amendment_no",
    "invoice": "invoice_id, contract_name_std, protocol_no_std, invoice_date_std, invoice_amount_std, paid_amount_std, outstanding_amount_std",
    "sponsor": "sponsor_name_std, sponsor_external_id_std, billing_account_id",
    "site": "site_code_std, study_name_std, protocol_no_std, sponsor_external_id_std",
}
for _entity, _columns in _SHOWN.items():
    _from = f"{_entity}_conformed"
    SQL[f"conform_{_entity}_valid"] = query(f"SELECT business_key, {_columns} FROM {_from} WHERE invalid_reason = ''", _from)
    SQL[f"conform_{_entity}_rejected"] = query(
        f"SELECT business_key, {_columns}, invalid_reason FROM {_from} WHERE invalid_reason <> ''", _from
    )
SQL["conform_written_once"] = query(
    """SELECT CASE WHEN invalid_reason = '' THEN 'valid' ELSE 'rejected' END AS record_status, invalid_reason, count(*) AS n
FROM study_conformed GROUP BY 1, 2""",
    "study_conformed",
)
SQL["full_row_distinct"] = "SELECT DISTINCT l_partkey, l_returnflag, l_linestatus FROM lineitem"

SQL["link_studies_to_contracts"] = query(
    f"""SELECT {token('s.protocol_no')} AS protocol_no, {token('s.sponsor_external_id')} AS sponsor_external_id, s.study_id, s.study_name,
  c.contract_id, c.amendment_no, c.study_name AS study_name_right
FROM study_feed s LEFT JOIN contract_feed c ON {token('s.protocol_no')} = {token('c.protocol_no')}
  AND {token('s.sponsor_external_id')} = {token('c.sponsor_external_id')}""",
    "study_feed",
    "contract_feed",
)
SQL["any_key_pairs"] = """WITH l AS (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name END AS name,
  CASE WHEN c_acctbal >= 0 THEN c_custkey END AS code, CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer),
r AS (SELECT 'E' || c_custkey AS erp_id, c_name AS name, CASE WHEN c_mktsegment <> 'FURNITURE' THEN c_custkey END AS code,
  CAST(c_acctbal AS DECIMAL(18,2)) AS balance FROM customer)
SELECT l.c_custkey AS l_c_custkey, r.erp_id AS r_erp_id FROM l JOIN r ON l.code = r.code OR l.name = r.name OR l.balance = r.balance"""
_PAIRS = f"""(SELECT l.study_id, r.contract_id, r.amendment_no, l.n, l.p, l.s, r.n AS rn, r.p AS rp, r.s AS rs, r.c AS rc
  FROM match_left l JOIN (SELECT contract_id, amendment_no, coalesce({text('study_name')}, '') AS n, coalesce({token('protocol_no')}, '') AS p,
    coalesce({token('sponsor_external_id')}, '') AS s, {text('contract_name')} AS c FROM contract_feed) r
  ON (l.p = r.p AND l.p <> '')
UNION SELECT l.study_id, r.contract_id, r.amendment_no, l.n, l.p, l.s, r.n, r.p, r.s, r.c
  FROM match_left l JOIN (SELECT contract_id, amendment_no, coalesce({text('study_name')}, '') AS n, coalesce({token('protocol_no')}, '') AS p,
    coalesce({token('sponsor_external_id')}, '') AS s, {text('contract_name')} AS c FROM contract_feed) r
  ON (l.n = r.n AND l.n <> ''))"""
SQL["pair_scores"] = query(
    f"""SELECT study_id AS l_study_id, contract_id AS r_contract_id, amendment_no AS r_amendment_no,
  CASE WHEN s <> '' AND s = rs THEN 1 WHEN p <> '' AND p = rp THEN 2 ELSE 4 END AS match_level,
  sp AS sponsor_match_score, st AS study_match_score,
  CASE WHEN sp IS NULL AND st IS NULL THEN 0.0::DOUBLE ELSE round((coalesce(sp * 0.45::DOUBLE, 0) + coalesce(st * 0.25::DOUBLE, 0))
    / (CASE WHEN sp IS NULL THEN 0::DOUBLE ELSE 0.45::DOUBLE END + CASE WHEN st IS NULL THEN 0::DOUBLE ELSE 0.25::DOUBLE END), 4) END
    AS overall_match_confidence,
  round(1.0::DOUBLE * 0.45::DOUBLE + {similar('n', 'rn')} * 0.25::DOUBLE + {similar("''", 'rc')} * 0.30::DOUBLE, 4) AS plain_confidence
FROM (SELECT *, CASE WHEN s <> '' AND s = rs THEN 1.0::DOUBLE END AS sp,
  CASE WHEN n <> '' AND rn <> '' THEN {similar('n', 'rn')} END AS st FROM {_PAIRS})""",
    "match_left",
    "contract_feed",
)
_LABELS = "lower(p_name || ' ' || p_type)"
SQL["similar_names"] = f"""SELECT * FROM (SELECT l_value, r_value, {similar('l_value', 'r_value')} AS similarity
  FROM (SELECT DISTINCT replace({_LABELS}, 'e', '') AS l_value FROM part), (SELECT DISTINCT {_LABELS} AS r_value FROM part))
WHERE similarity >= 0.85"""
_SYSTEMS = """SELECT p_partkey % 5 AS turn, CAST(p_partkey AS VARCHAR) AS k, upper(p_name || ' ' || p_type) AS sname,
  upper(p_type || ' ' || p_name || ' ' || p_brand) AS cname,
  CASE WHEN p_partkey % 5 = 0 THEN 'S' || p_partkey END AS sid, CASE WHEN p_partkey % 5 = 1 THEN 'P' || p_partkey END AS pid,
  CASE WHEN p_partkey % 5 = 4 THEN 'STUDY ' || p_partkey END AS study FROM part"""
_SHORTER = "least(length(a.sname), length(b.sname)) >= 0.9 * greatest(length(a.sname), length(b.sname))"
SQL["fuzzy_contract_matches"] = f"""WITH parts AS ({_SYSTEMS}),
a AS (SELECT 'A-' || k AS id, sid, pid, study, sname, CASE turn WHEN 2 THEN cname WHEN 3 THEN cname || 'Q' END AS cname FROM parts),
b AS (SELECT 'B-' || k AS id, sid, pid, study, CASE turn WHEN 2 THEN replace(sname, 'E', 'X') ELSE sname END AS sname, cname FROM parts),
keyed AS (
  SELECT a.id AS l, b.id AS r, 1 AS level FROM a JOIN b ON a.sid = b.sid UNION ALL SELECT a.id, b.id, 2 FROM a JOIN b ON a.pid = b.pid
  UNION ALL SELECT a.id, b.id, 3 FROM a JOIN b ON a.cname = b.cname UNION ALL SELECT a.id, b.id, 4 FROM a JOIN b ON a.study = b.study
  UNION ALL SELECT a.id, b.id, 5 FROM a JOIN b ON a.sid IS NULL AND a.pid IS NULL AND a.study IS NULL AND {_SHORTER}
    AND {similar('a.sname', 'b.sname')} >= 0.9 AND {similar('a.cname', 'b.cname')} >= 0.85
), levels AS (SELECT l, r, min(level) AS match_level FROM keyed GROUP BY l, r),
nearest AS (SELECT * FROM levels QUALIFY match_level = min(match_level) OVER (PARTITION BY l)),
scored AS (
  SELECT l, r, match_level, CASE WHEN match_level = 1 THEN 1.0::DOUBLE ELSE {similar('a.sname', 'b.sname')} END AS s,
    CASE WHEN a.study IS NOT NULL AND b.study IS NOT NULL THEN {similar('a.study', 'b.study')} END AS t,
    CASE WHEN a.cname IS NOT NULL THEN {similar('a.cname', 'b.cname')} END AS c
  FROM nearest JOIN a ON a.id = l JOIN b ON b.id = r
), summed AS (
  SELECT *, CAST(1 + CASE WHEN t IS NULL THEN 0 ELSE 1 END + CASE WHEN c IS NULL THEN 0 ELSE 1 END AS INTEGER) AS n,
    round((s * 0.45::DOUBLE + coalesce(t * 0.25::DOUBLE, 0) + coalesce(c * 0.3::DOUBLE, 0))
      / (0.45::DOUBLE + CASE WHEN t IS NULL THEN 0 ELSE 0.25::DOUBLE END + CASE WHEN c IS NULL THEN 0 ELSE 0.3::DOUBLE END), 4) AS conf
  FROM scored
)
SELECT l AS l_left_id, r AS r_right_id, match_level, s AS sponsor_match_score, t AS study_match_score, c AS contract_match_score,
  n AS scored_dims, conf AS overall_match_confidence
FROM summed QUALIFY row_number() OVER (PARTITION BY l ORDER BY conf DESC, n DESC, r) = 1"""
SQL["priority_lookup"] = """WITH s AS (SELECT CASE WHEN s_acctbal >= 0 THEN s_suppkey END AS code, s_nationkey AS nation, s_name FROM supplier),
a AS (SELECT code, min(s_name) AS s_name FROM s WHERE code IS NOT NULL GROUP BY 1),
b AS (SELECT nation, min(s_name) AS s_name FROM s GROUP BY 1)
SELECT coalesce(a.s_name, b.s_name) AS s_name, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines
FROM lineitem LEFT JOIN a ON l_returnflag = 'R' AND a.code = l_suppkey LEFT JOIN b ON b.nation = l_suppkey % 25 GROUP BY 1"""

SQL["sponsor_crosswalk"] = query("SELECT * FROM sponsor_xwalk", "sponsor_xwalk")
SQL["sponsor_crosswalk_by_name"] = f"""WITH m AS (SELECT 'M' || min(p_partkey) AS id, 'BA' || min(p_partkey) AS ba,
  {text("p_name || ' ' || p_type")} AS name FROM part GROUP BY p_name || ' ' || p_type),
f AS (SELECT 'F-' || p_partkey AS id, {text("replace(" + _LABELS + ", 'e', '')")} AS name FROM part)
SELECT source_sponsor_external_id, master_sponsor_external_id, billing_account_id, score AS sponsor_match_score,
  CAST(NULL AS DOUBLE) AS study_match_score, CAST(NULL AS DOUBLE) AS contract_match_score, score AS overall_match_confidence, 5 AS match_level
FROM (SELECT f.id AS source_sponsor_external_id, m.id AS master_sponsor_external_id, m.ba AS billing_account_id, m.name AS name, p.score
  FROM f JOIN (SELECT a.name AS fname, b.name AS mname, {similar('a.name', 'b.name')} AS score
    FROM (SELECT DISTINCT name FROM f) a, (SELECT DISTINCT name FROM m) b) p ON p.fname = f.name AND p.score >= 0.9
  JOIN m ON m.name = p.mname)
QUALIFY row_number() OVER (PARTITION BY source_sponsor_external_id ORDER BY score DESC, name) = 1"""
SQL["study_contract_matches"] = query("SELECT * FROM match_final", "match_final")
SQL["study_contract_crosswalk"] = query(
    "SELECT study_id, contract_id, sponsor_external_id, invoice_id, invoice_number, match_level FROM study_xwalk", "study_xwalk"
)
SQL["entity_crosswalk"] = query("SELECT * FROM entity_xwalk", "entity_xwalk")
_SCORED = """SELECT study_id, contract_id, expected_match, coalesce(m.overall_match_confidence, 0.0) AS overall_match_confidence
FROM (SELECT 'STUDY-' || o_orderkey AS study_id, 'CNT-' || o_orderkey AS contract_id,
  NOT (o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED') AS expected_match FROM orders)
LEFT JOIN match_final m USING (study_id, contract_id)"""
SQL["scored_labels"] = query(_SCORED, "match_final")
SQL["labelled_accuracy"] = query(
    f"""SELECT round(avg(CASE WHEN p = e THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS accuracy,
  round(count(*) FILTER (p AND e)::DOUBLE / count(*) FILTER (p), 6) AS precision,
  round(count(*) FILTER (p AND e)::DOUBLE / count(*) FILTER (e), 6) AS recall,
  round(2.0::DOUBLE * count(*) FILTER (p AND e) / (count(*) FILTER (p) + count(*) FILTER (e)), 6) AS f1
FROM (SELECT expected_match AS e, overall_match_confidence >= 0.97 AS p FROM ({_SCORED}))""",
    "match_final",
)

SQL["detect_changes"] = query("SELECT * FROM detected", "detected")
SQL["apply_changes"] = query("SELECT * FROM snap2", "snap2")
SQL["upsert_orders"] = query(
    "SELECT * FROM snap2 UNION ALL SELECT * FROM snap1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM snap2)", "snap1", "snap2"
)
SQL["keyed_versions"] = query(
    "SELECT *, '1' AS version FROM snap1 UNION ALL SELECT *, '2' FROM snap2 UNION ALL SELECT *, '3' FROM snap3", "snap1", "snap2", "snap3"
)
SQL["keyed_upsert"] = query(
    "SELECT * FROM snap2 UNION ALL SELECT * FROM snap1 WHERE o_orderkey NOT IN (SELECT o_orderkey FROM snap2)", "snap1", "snap2"
)
SQL["late_history"] = f"""WITH changes AS (
  SELECT *, {hashed(("event_type", "value"))} AS record_hash, event_type = 'error' AS gone
  FROM (SELECT user_id, event_type, CAST(floor(value) AS BIGINT) AS value, ts FROM events)
), counted AS (SELECT * FROM changes QUALIFY row_number() OVER (PARTITION BY user_id, ts ORDER BY gone DESC, record_hash) = 1),
turns AS (
  SELECT * FROM counted WINDOW w AS (PARTITION BY user_id ORDER BY ts)
  QUALIFY NOT coalesce(lag(gone) OVER w = gone AND (gone OR lag(record_hash) OVER w = record_hash), false)
), ended AS (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS effective_to_ts FROM turns)
SELECT user_id, event_type, value, record_hash, ts AS effective_from_ts, effective_to_ts, effective_to_ts IS NULL AS is_current
FROM ended WHERE NOT gone"""
SQL["scd2_history"] = SQL["scd2_rebuild"] = query(_SCD2, "islands")
SQL["change_counts"] = query(
    " UNION ALL ".join(
        f"SELECT 'delta_load' AS metric_group, '{k}_count' AS metric_name, CAST(count(*) AS DOUBLE) AS metric_value FROM detected WHERE change_type = '{k}'"
        for k in ("insert", "update", "delete", "no_change")
    ),
    "detected",
)
SQL["change_export"] = query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, price, o_orderpriority,
  record_hash, change_type, delta_business_key FROM detected WHERE change_type <> 'no_change'""",
    "detected",
)

for _key, _name in {
    "canonical_customers": "customers",
    "canonical_projects": "projects",
    "canonical_contracts": "contracts",
    "canonical_invoice_headers": "headers",
    "canonical_invoice_lines": "lines",
    "canonical_open_ar": "open_items",
}.items():
    SQL[_key] = query(f"SELECT * FROM {_name}", _name)


def _audit(name: str, source: str, amount: str | None) -> str:
    total = "CAST(NULL AS DOUBLE)" if amount is None else f"CAST(coalesce(sum(CAST({amount} AS DECIMAL(18,2))), 0) AS DOUBLE)"
    return f"SELECT '{name}' AS table_name, count(*) AS record_count, {total} AS amount_total FROM {source}"


SQL["audit_summary"] = query(
    " UNION ALL ".join(
        [
            _audit("customer_master", "customers", None),
            _audit("project_master", "projects", None),
            _audit("contract_master", "contracts", None),
            _audit("invoice_header", "headers", "invoice_total"),
            _audit("invoice_line", "lines", "line_amount"),
            _audit("open_ar", "open_items", "amount_due"),
        ]
    ),
    "customers",
    "projects",
    "contracts",
    "headers",
    "lines",
    "open_items",
)

SQL["ar_reconciliation"] = query(_AR.format(b="b.v", how="LEFT"), "billed", "paid")
SQL["ar_reconciliation_full"] = query(_AR.format(b="coalesce(b.v, 0)", how="FULL"), "billed", "paid")
SQL["invoice_export"] = query(
    "SELECT sponsor_name AS customer_name, study_name AS project_name, billed_amount AS invoice_total, paid_amount AS amount_paid, "
    f"outstanding_amount AS amount_due FROM ({_AR.format(b='b.v', how='LEFT')})",
    "billed",
    "paid",
)


def _metric(group: str, name: str, value: str) -> str:
    return f"SELECT '{group}' AS metric_group, '{name}' AS metric_name, CAST({value} AS DOUBLE) AS metric_value"


def _compared(group: str, names: tuple[str, str, str], s: str, t: str) -> list[str]:
    return [_metric(group, names[0], f"({s})"), _metric(group, names[1], f"({t})"), _metric(group, names[2], f"({t}) - ({s})")]


def _sum(c: str, source: str) -> str:
    return f"SELECT coalesce(sum(CAST({c} AS DECIMAL(18,2))), 0) FROM {source}"


_COUNT_NAMES = ("source_record_count", "target_record_count", "record_count_delta")
_TOTAL_NAMES = ("source_total", "target_total", "total_delta")
_counts = _compared("record_count", _COUNT_NAMES, "SELECT count(*) FROM invoice_feed", "SELECT count(*) FROM invoice_valid")
_totals = _compared("invoice_total", _TOTAL_NAMES, _sum("invoice_amount", "invoice_feed"), _sum("invoice_amount_std", "invoice_valid"))
_duplicates = [
    _metric("quality", "duplicate_count", "(SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM invoice_feed GROUP BY invoice_id))")
]
SQL["recon_counts"] = query(" UNION ALL ".join(_counts), "invoice_feed", "invoice_valid")
SQL["recon_totals"] = query(" UNION ALL ".join(_totals), "invoice_feed", "invoice_valid")
SQL["recon_rejected"] = query(
    _metric("quality", "rejected_record_count", "(SELECT count(*) FROM invoice_conformed WHERE invalid_reason <> '')"), "invoice_conformed"
)
SQL["recon_duplicates"] = query(_duplicates[0], "invoice_feed")
_MATCHED = " UNION ALL ".join(
    _metric("entity_resolution", name, f"(SELECT {value} FROM match_final)")
    for name, value in {
        "high_confidence_match_count": "count(*) FILTER (overall_match_confidence >= 0.97)",
        "total_match_count": "count(*)",
        "match_accuracy": "count(*) FILTER (overall_match_confidence >= 0.97) / count(*)",
    }.items()
)
SQL["recon_match_accuracy"] = query(_MATCHED, "match_final")
_REPORT = " UNION ALL ".join(
    [
        *_counts,
        *_compared("contract_value", _TOTAL_NAMES, _sum("contract_value", "contract_feed"), _sum("contract_value_std", "contract_valid")),
        *_totals,
        *_compared(
            "open_ar",
            _TOTAL_NAMES,
            _sum("outstanding_amount", "invoice_feed"),
            _sum("outstanding_amount_std", "invoice_valid WHERE outstanding_amount_std > 0"),
        ),
        _metric("quality", "rejected_record_count", "(SELECT count(*) FROM study_conformed WHERE invalid_reason <> '')"),
        *_duplicates,
        _metric("runtime", "load_runtime_seconds", "300"),
        *[
            _metric("delta_load", f"{k}_count", f"(SELECT count(*) FROM detected WHERE change_type = '{k}')")
            for k in ("insert", "update", "delete", "no_change")
        ],
    ]
)
_REPORT_NEEDS = ("invoice_feed", "invoice_valid", "contract_feed", "contract_valid", "study_conformed", "detected")
SQL["recon_report"] = query(f"{_REPORT} UNION ALL {_MATCHED}", *_REPORT_NEEDS, "match_final")
SQL["report_alerts"] = query(
    f"""SELECT * FROM ({_REPORT}) WHERE (metric_name = 'record_count_delta' AND (metric_value < -10 OR metric_value > 10))
  OR (metric_name = 'delete_count' AND metric_value > 100000000000) OR (metric_name = 'duplicate_count' AND metric_value > 0)""",
    *_REPORT_NEEDS,
)

SQL["latest_amendment"] = query(
    """SELECT contract_id, amendment_no, contract_value FROM contract_feed
QUALIFY row_number() OVER (PARTITION BY contract_id ORDER BY CAST(amendment_no AS INT) DESC, record_hash) = 1""",
    "contract_feed",
)
SQL["parent_rollup"] = query(
    """SELECT m.sponsor_parent, CAST(sum(b.billed) AS DOUBLE) AS billed, CAST(sum(b.invoices) AS BIGINT) AS invoices, count(*) AS sponsors
FROM (SELECT sponsor_external_id_std, sum(CAST(invoice_amount_std AS DECIMAL(18,2))) AS billed, count(*) AS invoices
  FROM invoice_valid GROUP BY 1) b LEFT JOIN sponsor_valid m USING (sponsor_external_id_std) GROUP BY 1""",
    "invoice_valid",
    "sponsor_valid",
)
SQL["site_dimension"] = query("SELECT site_code_std, count(*) AS studies FROM site_valid GROUP BY 1", "site_valid")
SQL["investigator_dimension"] = query(
    f"""SELECT {text('principal_investigator')} AS investigator, count(DISTINCT site_code_std) AS sites, count(*) AS studies
FROM study_valid GROUP BY 1""",
    "study_valid",
)
# two batches of the load job leave what one pass over all rows gives; an empty field of a file is read as NULL
SQL["load_job"] = f"SELECT * REPLACE (nullif(primary_site_code, '') AS primary_site_code) FROM ({SQL['canonical_projects']})"
