"""Oracle SQL for C03–C06, C08–C11, K01–K03."""

from millrace import config as C

from .builders import CTES, DEPS, d
from .queries import ORACLE, with_ctes

CTES["order_requests"] = """
SELECT s.inventory_id AS request_id, i.supplier_id, s.part_id, s.suggested_order_quantity AS quantity,
  CASE s.risk_level WHEN 'CRITICAL' THEN 'URGENT' WHEN 'HIGH' THEN 'HIGH' WHEN 'MEDIUM' THEN 'NORMAL' ELSE 'ROUTINE' END AS priority
FROM shortage s JOIN inventory i ON s.inventory_id = i.inventory_id
WHERE s.current_quantity <= i.reorder_level"""
DEPS["order_requests"] = ["shortage", "inventory"]
CTES["part_terms"] = """
SELECT DISTINCT part_id, part_name, unit_cost,
  CASE WHEN category IN ('Fasteners', 'Consumables') THEN 10 ELSE 1 END AS min_qty FROM inventory"""
DEPS["part_terms"] = ["inventory"]
CTES["on_time"] = """
SELECT supplier_id, count_if(actual_delivery <= expected_delivery) / count(*) AS on_time_rate
FROM shipments WHERE status = 'DELIVERED' GROUP BY supplier_id"""
DEPS["on_time"] = ["shipments"]

_prio = "CASE WHEN r.priority IN ('NORMAL', 'HIGH', 'URGENT') THEN r.priority ELSE 'NORMAL' END"
_err = """CASE WHEN r.quantity <= 0 THEN 'Quantity must be greater than zero'
  WHEN s.supplier_id IS NULL THEN 'Invalid supplier ID: ' || r.supplier_id
  WHEN p.part_id IS NULL THEN 'Invalid part ID: ' || r.part_id
  WHEN r.quantity < p.min_qty THEN 'Quantity ' || CAST(r.quantity AS VARCHAR) || ' below minimum order quantity ' || CAST(p.min_qty AS VARCHAR)
  END"""
_pct = f"CASE {_prio} WHEN 'URGENT' THEN CAST(0.20 AS DECIMAL(4,2)) WHEN 'HIGH' THEN CAST(0.10 AS DECIMAL(4,2)) ELSE CAST(0.00 AS DECIMAL(4,2)) END"
_adj = f"CASE {_prio} WHEN 'URGENT' THEN -3 WHEN 'HIGH' THEN -1 ELSE 0 END"
_sub = "CAST(CAST(p.unit_cost AS DECIMAL(18,2)) * r.quantity AS DECIMAL(18,2))"
_rush = f"CAST({_sub} * {_pct} AS DECIMAL(18,2))"
_days = f"greatest(1, s.lead_time_days + {_adj})"
_ok = f"({_err}) IS NULL"
ORACLE["create_purchase_orders"] = with_ctes(f"""
SELECT r.request_id,
  CASE WHEN {_ok} THEN 'PO-' || upper(sha256(r.request_id)) END AS order_id,
  CASE WHEN {_ok} THEN 'PENDING' ELSE 'FAILED' END AS status,
  {_err} AS error,
  r.supplier_id, r.part_id, r.quantity, {_prio} AS priority,
  CASE WHEN {_ok} THEN s.supplier_name END AS supplier_name,
  CASE WHEN {_ok} THEN o.on_time_rate END AS reliability_score,
  CASE WHEN {_ok} THEN p.part_name END AS part_name,
  CASE WHEN {_ok} THEN p.unit_cost END AS unit_cost,
  CASE WHEN {_ok} THEN CAST({_sub} AS DOUBLE) END AS subtotal,
  CASE WHEN {_ok} THEN CAST({_rush} AS DOUBLE) END AS rush_fee,
  CASE WHEN {_ok} THEN CAST({_pct} * 100 AS DOUBLE) END AS rush_fee_percent,
  CASE WHEN {_ok} THEN CAST({_sub} + {_rush} AS DOUBLE) END AS total_cost,
  CASE WHEN {_ok} THEN {_days} END AS estimated_days,
  CASE WHEN {_ok} THEN {d(C.AS_OF_SHIPPING)} + {_days} END AS estimated_delivery_date
FROM order_requests r LEFT JOIN suppliers s ON r.supplier_id = s.supplier_id
  LEFT JOIN on_time o ON r.supplier_id = o.supplier_id
  LEFT JOIN part_terms p ON r.part_id = p.part_id""", "order_requests", "suppliers", "on_time", "part_terms")

ORACLE["lookup_customer"] = with_ctes("""
, q AS (SELECT DISTINCT regexp_extract(customer_name, '([1-9][0-9]*)$', 1) AS name_query FROM tickets
        WHERE status = 'ESCALATED' AND length(regexp_extract(customer_name, '([1-9][0-9]*)$', 1)) > 0),
m AS (SELECT q.name_query, c.*, row_number() OVER (PARTITION BY q.name_query
        ORDER BY c.last_purchase_date DESC NULLS LAST, c.customer_id) AS rn
      FROM q JOIN customers c ON contains(c.customer_name, q.name_query))
SELECT q.name_query, m.customer_id, m.customer_name,
  'Customer ID: ' || m.customer_id || ', Email: ' || m.email || ', Total Orders: ' || CAST(m.total_orders AS VARCHAR)
  || ', Total Spent: $' || CAST(CAST(m.total_spent AS DECIMAL(18,2)) AS VARCHAR)
  || ', Last Purchase: ' || CAST(m.last_purchase_date AS VARCHAR) || ', Status: ' || m.status AS summary
FROM q LEFT JOIN m ON q.name_query = m.name_query AND m.rn = 1""", "tickets", "customers")

_st = ("CASE WHEN {q} <= {l} THEN 'REORDER REQUIRED' WHEN {q} <= {l} * 1.5 THEN 'LOW STOCK' ELSE 'ADEQUATE' END")
ORACLE["inventory_status"] = with_ctes(f"""
, q AS (SELECT DISTINCT string_split(p_name, ' ')[-1] AS part_query FROM part),
m AS (SELECT q.part_query, i.*, row_number() OVER (PARTITION BY q.part_query
        ORDER BY i.current_quantity, i.inventory_id) AS rn
      FROM q JOIN inventory i ON contains(i.part_name, q.part_query))
SELECT q.part_query, m.inventory_id, m.part_id, m.warehouse_id,
  {_st.format(q='m.current_quantity', l='m.reorder_level')} AS stock_status,
  'Part: ' || m.part_name || ' (' || m.part_id || '), Stock: ' || CAST(m.current_quantity AS VARCHAR)
  || ' units, Location: ' || m.warehouse_location || ', Reorder Level: ' || CAST(m.reorder_level AS VARCHAR)
  || ', Status: ' || {_st.format(q='m.current_quantity', l='m.reorder_level')} AS summary
FROM q LEFT JOIN m ON q.part_query = m.part_query AND m.rn = 1""", "inventory")

ORACLE["track_shipments"] = with_ctes(f"""
, p AS (SELECT unnest([7, 30, 90]) AS days_back),
a AS (SELECT p.days_back, count(s.status) AS total_shipments,
        count_if(s.status = 'DELIVERED') AS delivered, count_if(s.status = 'IN_TRANSIT') AS in_transit,
        count_if(s.status = 'DELAYED') AS delayed
      FROM p LEFT JOIN shipments s ON s.shipment_date >= {d(C.AS_OF_SHIPPING)} - p.days_back
      GROUP BY p.days_back)
SELECT CAST(days_back AS INTEGER) AS days_back, CAST(total_shipments AS BIGINT) AS total_shipments,
  CAST(delivered AS BIGINT) AS delivered,
  round(CASE WHEN total_shipments > 0 THEN delivered * 100.0 / total_shipments END, 1) AS delivered_pct,
  CAST(in_transit AS BIGINT) AS in_transit, CAST(delayed AS BIGINT) AS delayed FROM a""", "shipments")

ORACLE["reorder_list"] = with_ctes(f"""
SELECT inventory_id, part_id, warehouse_id, supplier_id, current_quantity, reorder_level,
  {_st.format(q='current_quantity', l='reorder_level')} AS stock_status,
  reorder_quantity AS order_quantity,
  CAST(CAST(CAST(unit_cost AS DECIMAL(18,2)) * reorder_quantity AS DECIMAL(18,2)) AS DOUBLE) AS order_cost
FROM inventory WHERE {_st.format(q='current_quantity', l='reorder_level')} <> 'ADEQUATE'""", "inventory")

ORACLE["equipment_status"] = with_ctes("""
SELECT device_id,
  max("timestamp") AS last_reading_ts,
  arg_max(operational_status, ("timestamp", reading_id)) AS latest_status,
  arg_max(error_code, ("timestamp", reading_id)) FILTER (WHERE operational_status = 'ERROR') AS last_error_code,
  max("timestamp") FILTER (WHERE operational_status = 'ERROR') AS last_error_ts,
  count(*) AS readings, count_if(operational_status = 'ERROR') AS error_count,
  coalesce(list_sort(list_distinct(list(error_code) FILTER (WHERE maintenance_required))), []) AS open_error_codes
FROM telemetry GROUP BY device_id""", "telemetry")

ORACLE["churn_activity"] = with_ctes(f"""
, tx AS (SELECT customer_id, count_if(recent) AS orders_recent, count_if(NOT recent) AS orders_prior FROM (
          SELECT DISTINCT customer_id, order_id, transaction_date >= CAST({d(C.AS_OF_SALES)} - 90 AS TIMESTAMP) AS recent
          FROM transactions WHERE transaction_date >= CAST({d(C.AS_OF_SALES)} - 180 AS TIMESTAMP)
            AND transaction_date < CAST({d(C.AS_OF_SALES)} AS TIMESTAMP)) GROUP BY customer_id),
tk AS (SELECT customer_id, count(*) AS tickets_recent FROM tickets
       WHERE created_date >= CAST({d(C.AS_OF_SALES)} - 90 AS TIMESTAMP) AND created_date < CAST({d(C.AS_OF_SALES)} AS TIMESTAMP)
       GROUP BY customer_id)
SELECT coalesce(tx.customer_id, tk.customer_id) AS customer_id,
  CAST(coalesce(orders_recent, 0) AS BIGINT) AS orders_recent, CAST(coalesce(orders_prior, 0) AS BIGINT) AS orders_prior,
  CASE WHEN coalesce(orders_prior, 0) <> 0 THEN (coalesce(orders_prior, 0) - coalesce(orders_recent, 0)) * 100.0 / coalesce(orders_prior, 0) END AS order_drop_pct,
  CAST(coalesce(tickets_recent, 0) AS BIGINT) AS tickets_recent
FROM tx FULL OUTER JOIN tk ON tx.customer_id = tk.customer_id""", "transactions", "tickets")

ORACLE["safe_apply"] = """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
  CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) <> 0 THEN value / TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) END AS result,
  CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL THEN 'missing_or_bad_field'
       WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) = 0 THEN 'division_by_zero' END AS error
FROM events"""

ORACLE["register_sql_functions"] = with_ctes(f"""
SELECT inventory_id AS subject_id, days_until_shortage,
  greatest(1, CAST(trunc(q / {C.MIN_DAILY_USAGE}) AS INTEGER)) AS days_at_default_usage, risk_score, risk_level,
  {_st.format(q='q', l='reorder_level')} AS stock_status
FROM shortage JOIN (SELECT inventory_id AS iid, reorder_level, current_quantity AS q FROM inventory) ON inventory_id = iid
UNION ALL
SELECT customer_id, CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), churn_probability, risk_level, CAST(NULL AS VARCHAR) FROM churn""", "shortage", "inventory", "churn")

ORACLE["python_function_column"] = with_ctes(
    "SELECT customer_id, churn_probability AS churn_probability_py, true AS agrees FROM churn", "churn")

ORACLE["apply_function_table"] = with_ctes("""
SELECT inventory_id AS call_id, 'predict_shortage' AS function_name, risk_level AS level, risk_score AS score FROM shortage
UNION ALL
SELECT customer_id, 'predict_churn', risk_level, churn_probability FROM churn""", "shortage", "churn")
