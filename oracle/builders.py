"""DuckDB CTEs repeating the domain-table builders (plans/builders.py) in plain SQL."""

from __future__ import annotations

from millrace import config as C


def lst(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def pick(values, idx: str) -> str:
    return f"({lst(values)})[(({idx}) % {len(values)}) + 1]"


def d(x) -> str:
    return f"DATE '{x.isoformat()}'"


def ts(x) -> str:
    return f"TIMESTAMP '{x.isoformat()} 00:00:00'"


NL = "chr(10)"
WH_LOC = [loc for _, loc in C.WAREHOUSES]

CTES: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def cte(name, deps=()):
    def deco(sql):
        CTES[name] = sql
        DEPS[name] = list(deps)
        return sql
    return deco


cte("suppliers")(f"""
SELECT printf('SUP%04d', s_suppkey + 1) AS supplier_id, s_name AS supplier_name,
  'Contact ' || CAST(s_suppkey + 1 AS VARCHAR) AS contact_name,
  'orders' || CAST(s_suppkey + 1 AS VARCHAR) || '@supplier.example' AS contact_email,
  printf('+1-555-%04d', s_suppkey % 10000) AS contact_phone,
  CAST(s_suppkey + 1 AS VARCHAR) || ' Industrial Way' AS address,
  n_name AS city, n_name AS country,
  CAST((s_suppkey * 7) % 21 + 30 AS DOUBLE) / 10.0 AS rating,
  CAST((s_suppkey * 11) % 28 + 3 AS INTEGER) AS lead_time_days,
  {pick(C.SUPPLIER_PAYMENT_TERMS, 's_suppkey')} AS payment_terms,
  CASE WHEN s_suppkey % 10 = 9 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status,
  {d(C.AS_OF_SHIPPING)} - CAST((s_suppkey * 37) % 730 + 400 AS INTEGER) AS created_date,
  {d(C.AS_OF_SHIPPING)} - CAST((s_suppkey * 13) % 180 AS INTEGER) AS last_order_date
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""")

_wh_rows = " UNION ALL ".join(f"SELECT {i} AS w_idx, '{w}' AS warehouse_id, '{loc}' AS warehouse_location"
                              for i, (w, loc) in enumerate(C.WAREHOUSES))
cte("inventory")(f"""
SELECT printf('PART%05d', p_partkey + 1) || '-' || warehouse_id AS inventory_id,
  printf('PART%05d', p_partkey + 1) AS part_id, p_name AS part_name, warehouse_id, warehouse_location,
  CAST((p_partkey * 37 + w_idx * 101) % 1001 AS INTEGER) AS current_quantity,
  CAST((p_partkey * 13 + w_idx * 7) % 151 + 50 AS INTEGER) AS reorder_level,
  CAST(((p_partkey * 13 + w_idx * 7) % 151 + 50) * 3 AS INTEGER) AS reorder_quantity,
  p_retailprice AS unit_cost,
  {ts(C.AS_OF_SHIPPING)} - to_hours(CAST((p_partkey * 7 + w_idx * 3) % 72 AS BIGINT)) AS last_updated,
  {pick(C.PART_CATEGORIES, 'p_partkey')} AS category,
  CASE WHEN (SELECT count(*) FROM supplier) > 0 THEN printf('SUP%04d', (p_partkey * 31 + w_idx) % (SELECT count(*) FROM supplier) + 1) ELSE 'DEFAULT_SUP' END AS supplier_id
FROM part, ({_wh_rows}) w""")

cte("shipments")(f"""
SELECT printf('SHP%d-%d', l_orderkey, l_linenumber) AS shipment_id,
  printf('ORD%06d', l_orderkey) AS order_id,
  printf('PART%05d', l_partkey + 1) AS part_id, p_name AS part_name,
  CAST(l_quantity AS INTEGER) AS quantity,
  printf('SUP%04d', l_suppkey + 1) AS supplier_id, s_name AS supplier_name,
  n_name AS origin_location,
  {pick(WH_LOC, 'l_orderkey + l_linenumber')} AS destination_location,
  CAST(l_shipdate AS DATE) AS shipment_date,
  CAST(l_shipdate AS DATE) + CAST((l_orderkey * 7 + l_linenumber) % 14 + 1 AS INTEGER) AS expected_delivery,
  CASE WHEN {pick(C.SHIPMENT_STATUSES, 'l_orderkey * 3 + l_linenumber')} = 'DELIVERED'
       THEN CAST(l_shipdate AS DATE) + CAST((l_orderkey * 7 + l_linenumber) % 14 + 1 AS INTEGER)
            + CAST(l_partkey % 6 - 2 AS INTEGER) END AS actual_delivery,
  {pick(C.SHIPMENT_STATUSES, 'l_orderkey * 3 + l_linenumber')} AS status,
  {pick(C.CARRIERS, 'l_orderkey + l_suppkey')} AS carrier,
  printf('TRK%010d', l_orderkey * 10 + l_linenumber) AS tracking_number,
  CAST(l_quantity * 10 + 50 AS DOUBLE) AS cost
FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey""")

cte("customers")(f"""
SELECT printf('CUST%05d', c_custkey + 1) AS customer_id, c_name AS customer_name,
  'Buyer ' || CAST(c_custkey + 1 AS VARCHAR) AS contact_name,
  'buyer' || CAST(c_custkey + 1 AS VARCHAR) || '@customer.example' AS email,
  printf('+1-555-%07d', c_custkey) AS phone,
  c_mktsegment AS industry, {pick(C.SEGMENTS, 'c_custkey')} AS segment,
  CAST(c_custkey + 1 AS VARCHAR) || ' Market Street' AS address, n_name AS city, n_name AS country,
  {d(C.AS_OF_SALES)} - CAST((c_custkey * 17) % 1460 + 2400 AS INTEGER) AS created_date,
  CASE WHEN o.last_purchase IS NULL OR {d(C.AS_OF_SALES)} - o.last_purchase > 180
       THEN CASE WHEN c_custkey % 2 = 0 THEN 'INACTIVE' ELSE 'CHURNED' END ELSE 'ACTIVE' END AS status,
  CAST(coalesce(o.n_orders, 0) AS INTEGER) AS total_orders,
  CAST(coalesce(o.spent, 0) AS DOUBLE) AS total_spent,
  o.last_purchase AS last_purchase_date,
  CAST((c_custkey * 997) % 490000 + 10000 AS DOUBLE) AS credit_limit,
  {pick(C.CUSTOMER_PAYMENT_TERMS, 'c_custkey // 3')} AS payment_terms
FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spent,
                  max(CAST(o_orderdate AS DATE)) AS last_purchase FROM orders GROUP BY o_custkey) o
  ON c_custkey = o.o_custkey
LEFT JOIN nation ON c_nationkey = n_nationkey""")

cte("transactions")(f"""
SELECT printf('TXN%d-%d', l_orderkey, l_linenumber) AS transaction_id,
  printf('ORD%06d', l_orderkey) AS order_id,
  CASE WHEN o_custkey IS NOT NULL THEN printf('CUST%05d', o_custkey + 1) END AS customer_id, c_name AS customer_name,
  o_orderdate AS transaction_date,
  printf('PART%05d', l_partkey + 1) AS product_id, p_name AS product_name,
  CAST(l_quantity AS INTEGER) AS quantity, p_retailprice AS unit_price,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS total_amount,
  CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(6,4)) AS DECIMAL(18,2)) AS DOUBLE) AS discount_amount,
  CAST(CAST((CAST(l_extendedprice AS DECIMAL(18,2))
        - CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(6,4)) AS DECIMAL(18,2)))
        * CAST(0.08 AS DECIMAL(4,2)) AS DECIMAL(18,2)) AS DOUBLE) AS tax_amount,
  {pick(C.PAYMENT_METHODS, 'l_orderkey')} AS payment_method,
  printf('SR%03d', l_orderkey % 20 + 1) AS sales_rep_id,
  'Rep ' || CAST(l_orderkey % 20 + 1 AS VARCHAR) AS sales_rep_name,
  r_name AS region,
  CASE WHEN l_orderkey % 10 = 9 THEN 'PENDING' ELSE 'COMPLETED' END AS status
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN (SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey) g ON c_nationkey = g.n_nationkey""")

cte("telemetry")(f"""
SELECT 'R' || CAST(event_id AS VARCHAR) AS reading_id,
  printf('DEV%04d', user_id + 1) AS device_id,
  {pick(C.DEVICE_TYPES, 'user_id')} AS device_type,
  {pick(C.DEVICE_LOCATIONS, 'user_id')} AS location_id,
  ts AS "timestamp",
  CAST((event_id * 7) % 100 + 200 AS DOUBLE) / 10.0 AS temperature,
  CASE WHEN user_id % 5 <> 1 THEN CAST((event_id * 11) % 200 + 400 AS DOUBLE) / 10.0 END AS humidity,
  CASE WHEN user_id % 5 <> 0 THEN CAST((event_id * 13) % 400 + 800 AS DOUBLE) / 10.0 END AS pressure,
  CASE WHEN user_id % 5 >= 2 THEN CAST((event_id * 3) % 100 AS DOUBLE) / 10.0 END AS vibration,
  value AS power_consumption,
  CASE WHEN event_type <> 'error' OR event_type IS NULL THEN 'NORMAL' WHEN event_id % 4 = 0 THEN 'WARNING' ELSE 'ERROR' END AS operational_status,
  CASE WHEN event_type = 'error' THEN 'E' || CAST(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) + 100 AS VARCHAR) END AS error_code,
  (event_type = 'error' AND TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 = 0) AS maintenance_required,
  CAST(ts AS DATE) AS reading_date
FROM events""")

_tpl_case = "CASE " + " ".join(
    f"WHEN o_orderkey % {len(C.TICKET_TEMPLATES)} = {i} THEN printf('{tpl}', "
    f"{'o_orderkey' if '%06d' in tpl else 'o_orderkey % 10 + 1'}, o_orderkey % 900 + 100)"
    for i, tpl in enumerate(C.TICKET_TEMPLATES)) + " END"
_old = f"({d(C.AS_OF_SALES)} - CAST(o_orderdate AS DATE) > 7)"
cte("tickets")(f"""
SELECT printf('TKT%08d', o_orderkey) AS ticket_id,
  CASE WHEN o_custkey IS NOT NULL THEN printf('CUST%05d', o_custkey + 1) END AS customer_id, c_name AS customer_name,
  o_orderdate AS created_date,
  {pick(C.TICKET_CATEGORIES, 'o_orderkey')} AS category,
  CASE WHEN starts_with(o_orderpriority, '1') THEN 'CRITICAL' WHEN starts_with(o_orderpriority, '2') THEN 'HIGH'
       WHEN starts_with(o_orderpriority, '3') THEN 'MEDIUM' ELSE 'LOW' END AS priority,
  {pick(C.TICKET_SUBJECTS, 'o_orderkey')} AS subject,
  {_tpl_case} AS description,
  CASE WHEN {_old} THEN {pick(['RESOLVED', 'CLOSED'], 'o_orderkey')}
       ELSE {pick(['OPEN', 'IN_PROGRESS', 'ESCALATED'], 'o_orderkey')} END AS status,
  'Agent ' || CAST(o_orderkey % 10 + 1 AS VARCHAR) AS assigned_to,
  CASE WHEN {_old} THEN o_orderdate + to_hours(CAST((o_orderkey * 17) % 168 + 1 AS BIGINT)) END AS resolved_date,
  CASE WHEN {_old} THEN CAST((o_orderkey * 17) % 168 + 1 AS DOUBLE) END AS resolution_time_hours,
  CASE WHEN {_old} THEN CAST({pick(C.SATISFACTION_SCORES, 'o_orderkey')} AS INTEGER) END AS satisfaction_score,
  list_slice({lst(C.TICKET_TAGS)}, o_orderkey % 3 + 1, o_orderkey % 3 + o_orderkey % 4) AS tags
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")

cte("support_tickets", ["tickets"])(f"""
SELECT 'ST-' || ticket_id AS id, ticket_id, customer_id, customer_name,
  concat_ws({NL} || {NL}, subject, description) AS ticket_content,
  description AS problem_description,
  'Status: ' || status || '. Assigned to: ' || assigned_to AS resolution,
  category, '{C.SUPPORT_PRODUCT}' AS product_affected, created_date, resolved_date, priority,
  coalesce(tags, []) AS tags
FROM tickets""")


def _line(i):
    return f"coalesce(lines[{i}], '')"


def _docs(kind):
    return f"(SELECT doc_id, text, string_split(text, {NL}) AS lines FROM documents WHERE doc_id % 3 = {kind})"


cte("standard_operating_procedures")(f"""
SELECT 'SOP-' || CAST(doc_id AS VARCHAR) AS id,
  {pick(C.SOP_NAMES, 'doc_id')} || ' - Rev ' || CAST(doc_id % 5 + 1 AS VARCHAR) AS procedure_name,
  {_line(1)} || {NL} || {NL} || 'Prerequisites:' || {NL}
    || array_to_string(list_transform(list_slice(lines, 2, 3), lambda x: '- ' || x), {NL})
    || {NL} || {NL} || 'Procedure Steps:' || {NL}
    || array_to_string(list_transform(list_slice(lines, 4, 2147483647), lambda x, i: CAST(i AS VARCHAR) || '. ' || x), {NL})
    || {NL} || {NL} || 'Safety Considerations:' || {NL}
    || array_to_string(list_transform(list_slice(lines, greatest(len(lines) - 1, 1), len(lines)), lambda x: '- ' || x), {NL})
    AS procedure_text,
  {pick(C.SOP_CATEGORIES, 'doc_id // 3')} AS category,
  {pick(C.SOP_DEPARTMENTS, 'doc_id // 7')} AS department,
  CAST(doc_id % 3 + 1 AS VARCHAR) || '.' || CAST(doc_id % 10 AS VARCHAR) AS version,
  {d(C.AS_OF_SHIPPING)} - CAST((doc_id * 13) % 540 + 200 AS INTEGER) AS effective_date,
  {d(C.AS_OF_SHIPPING)} - CAST((doc_id * 13) % 540 + 200 AS INTEGER) + CAST(doc_id % 151 + 30 AS INTEGER) AS last_reviewed,
  {d(C.AS_OF_SHIPPING)} + CAST(doc_id % 336 + 30 AS INTEGER) AS next_review,
  'Author ' || CAST(doc_id % 25 + 1 AS VARCHAR) AS created_by,
  list_slice({lst(C.SOP_TAGS)}, doc_id % 3 + 1, doc_id % 3 + (doc_id // 3) % 3 + 2) AS tags
FROM {_docs(0)}""")

cte("incident_reports")(f"""
SELECT 'INC-' || CAST(doc_id AS VARCHAR) AS id,
  {pick(C.INCIDENT_TITLES, 'doc_id // 3')} AS incident_title,
  {_line(1)} || {NL} || {NL} || 'Initial Detection: ' || {_line(2)} || {NL} || 'Immediate Impact: ' || {_line(3)}
    || {NL} || 'Actions Taken:' || {NL} || array_to_string(list_transform(list_slice(lines, 4, 2147483647), lambda x: '- ' || x), {NL}) AS incident_description,
  {ts(C.AS_OF_SHIPPING)} - to_hours(CAST((doc_id * 7919) % 8760 + 24 AS BIGINT)) AS incident_date,
  CASE WHEN (doc_id // 3) % 10 < 4 THEN 'LOW' WHEN (doc_id // 3) % 10 < 7 THEN 'MEDIUM'
       WHEN (doc_id // 3) % 10 < 9 THEN 'HIGH' ELSE 'CRITICAL' END AS severity,
  {pick(C.INCIDENT_CATEGORIES, 'doc_id // 3')} AS category,
  list_slice({lst(C.AFFECTED_SYSTEMS)}, doc_id % 3 + 1, doc_id % 3 + (doc_id // 3) % 3 + 1) AS affected_systems,
  'Immediate Response:' || {NL} || array_to_string(list_transform(list_slice(lines, 5, 2147483647), lambda x: '- ' || x), {NL})
    || {NL} || {NL} || 'Permanent Fix: ' || coalesce(lines[-1], '') AS resolution,
  CAST((doc_id * 37) % 716 + 5 AS DOUBLE) / 10.0 AS resolution_time_hours,
  coalesce(lines[-1], '') AS root_cause,
  {_line(1)} AS preventive_measures,
  'Reporter ' || CAST(doc_id % 30 + 1 AS VARCHAR) AS reported_by,
  'Engineer ' || CAST(doc_id % 12 + 1 AS VARCHAR) AS resolved_by
FROM {_docs(1)}""")

_age = "((doc_id * 11) % 365)"
_status = (f"CASE WHEN {_age} > 60 THEN {pick(['WON', 'LOST', 'LOST'], 'doc_id // 3')} "
           f"WHEN {_age} > 30 THEN {pick(['UNDER_REVIEW', 'SENT'], 'doc_id // 3')} "
           f"ELSE {pick(['DRAFT', 'SENT'], 'doc_id // 3')} END")
_summary = (f"'Proposal for ' || {pick(C.PROPOSAL_PRODUCTS, 'doc_id')} || ' implementation at ' || coalesce(c_name, '')"
            f" || '. ' || {_line(1)}")
cte("sales_proposals")(f"""
SELECT 'PRP-' || CAST(doc_id AS VARCHAR) AS id, printf('PROP%06d', doc_id) AS proposal_id,
  printf('CUST%05d', dd.doc_id % (SELECT count(*) FROM customer) + 1) AS customer_id, c_name AS customer_name,
  {d(C.AS_OF_SALES)} - CAST({_age} AS INTEGER) AS proposal_date,
  'EXECUTIVE SUMMARY:' || {NL} || {_summary} || {NL} || {NL} || 'BUSINESS CASE:' || {NL} || {_line(2)}
    || {NL} || {NL} || 'PROPOSED SOLUTION:' || {NL} || {_line(3)} || {NL} || {NL} || 'IMPLEMENTATION TIMELINE:' || {NL}
    || array_to_string(list_transform(list_slice(lines, 4, 2147483647), lambda x, i: 'Phase ' || CAST(i AS VARCHAR) || ': ' || x), {NL})
    || {NL} || {NL} || 'INVESTMENT SUMMARY:' || {NL} || coalesce(lines[-1], '')
    AS proposal_content,
  {_summary} AS executive_summary,
  CAST((doc_id * 7907) % 1950000 + 50000 AS DOUBLE) AS proposal_value,
  list_slice({lst(C.PROPOSAL_PRODUCTS)}, doc_id % 4 + 1, doc_id % 4 + (doc_id // 3) % 3 + 1) AS products,
  {_status} AS status,
  {d(C.AS_OF_SALES)} - CAST({_age} AS INTEGER) + 90 AS valid_until,
  'Rep ' || CAST((doc_id // 3) % 20 + 1 AS VARCHAR) AS created_by,
  CASE WHEN {_status} IN ('SENT', 'UNDER_REVIEW') THEN CAST(doc_id % 81 + 10 AS DOUBLE) / 100.0 END AS win_probability,
  CASE WHEN (doc_id // 3) % 2 = 0 THEN 'Competitor ' || CAST(doc_id % 7 AS VARCHAR) END AS competitor_info,
  CASE WHEN (doc_id // 3) % 10 >= 7 THEN {_line(2)} END AS notes
FROM {_docs(2)} dd LEFT JOIN customer ON dd.doc_id % (SELECT count(*) FROM customer) = c_custkey""")


def with_ctes(body: str, *names: str) -> str:
    """Prefix ``body`` with the named CTEs and their dependencies, in dependency order."""
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for dep in DEPS.get(n, []):
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body.lstrip().lstrip(",").lstrip()
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + "\n" + body
