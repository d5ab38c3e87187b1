"""Oracle SQL for G01–G20."""

from millrace import config as C

from .builders import CTES, DEPS, d
from .queries import ORACLE, with_ctes

MONEY = "CAST(sum(CAST({} AS DECIMAL(18,2))) AS DOUBLE)".format
OPEN_SHIP = "('PENDING', 'IN_TRANSIT', 'DELAYED')"
OPEN_TK = "('OPEN', 'IN_PROGRESS', 'ESCALATED')"
OPEN_PR = "('SENT', 'UNDER_REVIEW')"

ORACLE["inventory_by_warehouse"] = with_ctes("""
SELECT warehouse_id, category, count(*) AS parts, CAST(sum(current_quantity) AS BIGINT) AS total_units,
  CAST(sum(CAST(CAST(unit_cost AS DECIMAL(18,2)) * current_quantity AS DECIMAL(18,2))) AS DOUBLE) AS stock_value,
  count_if(current_quantity <= reorder_level) AS parts_below_reorder
FROM inventory GROUP BY warehouse_id, category""", "inventory")

ORACLE["supplier_scorecard"] = with_ctes(f"""
, s AS (SELECT supplier_id, count(*) AS shipments, count_if(status = 'DELIVERED') AS delivered,
        count_if(status = 'DELIVERED' AND actual_delivery <= expected_delivery) AS on_time,
        avg(CASE WHEN status = 'DELIVERED' THEN actual_delivery - expected_delivery END) AS avg_delay_days,
        {MONEY('cost')} AS total_cost FROM shipments GROUP BY supplier_id)
SELECT p.supplier_id, supplier_name, rating, lead_time_days, coalesce(shipments, 0) AS shipments,
  coalesce(delivered, 0) AS delivered, CASE WHEN delivered > 0 THEN on_time / delivered END AS on_time_rate,
  avg_delay_days, coalesce(total_cost, 0.0) AS total_cost
FROM suppliers p LEFT JOIN s ON p.supplier_id = s.supplier_id""", "shipments", "suppliers")

ORACLE["lane_performance"] = with_ctes(f"""
SELECT origin_location, destination_location, carrier, count(*) AS shipments, CAST(sum(quantity) AS BIGINT) AS total_quantity,
  {MONEY('cost')} AS total_cost, avg(coalesce(actual_delivery, expected_delivery) - shipment_date) AS avg_transit_days,
  count_if(status = 'DELAYED') AS delayed
FROM shipments GROUP BY origin_location, destination_location, carrier""", "shipments")

LATE = f"""SELECT shipment_id, part_id, supplier_id, status, expected_delivery,
  CAST({d(C.AS_OF_SHIPPING)} - expected_delivery AS INTEGER) AS days_late
FROM shipments WHERE status IN {OPEN_SHIP} AND expected_delivery < {d(C.AS_OF_SHIPPING)}"""
CTES["late"] = LATE
DEPS["late"] = ["shipments"]
ORACLE["late_shipments"] = with_ctes("SELECT * FROM late", "late")

_net = "CAST(total_amount AS DECIMAL(18,2)) - CAST(discount_amount AS DECIMAL(18,2))"
ORACLE["sales_kpis"] = with_ctes(f"""
SELECT region, sales_rep_id, strftime(transaction_date, '%Y-%m') AS month, count(*) AS lines,
  CAST(sum({_net}) AS DOUBLE) AS revenue, {MONEY('discount_amount')} AS discount, {MONEY('tax_amount')} AS tax,
  CAST(GROUPING(region, sales_rep_id, strftime(transaction_date, '%Y-%m')) AS BIGINT) AS grouping_level
FROM transactions GROUP BY ROLLUP (region, sales_rep_id, strftime(transaction_date, '%Y-%m'))""", "transactions")

ORACLE["kpi_trends"] = with_ctes(f"""
, m AS (SELECT region, strftime(transaction_date, '%Y-%m') AS month, year(transaction_date) * 12 + month(transaction_date) AS i, sum({_net}) AS rev
        FROM transactions GROUP BY ALL),
p AS (SELECT a.region, a.month, CAST(a.rev AS DOUBLE) AS rev, CAST(b.rev AS DOUBLE) AS prev,
        (SELECT CAST(sum(c.rev) AS DOUBLE) / count(*) FROM m c WHERE c.region IS NOT DISTINCT FROM a.region AND c.i BETWEEN a.i - 2 AND a.i) AS mov
      FROM m a LEFT JOIN m b ON b.region IS NOT DISTINCT FROM a.region AND b.i = a.i - 1)
SELECT region, month, rev AS revenue, CASE WHEN prev <> 0 THEN (rev - prev) * 100.0 / prev END AS mom_change_pct, mov AS moving_avg_3m FROM p""", "transactions")

C360 = f"""SELECT c.customer_id, customer_name, segment, industry, status, total_orders, total_spent, last_purchase_date,
  coalesce(txn_lines, 0) AS txn_lines, coalesce(txn_revenue, 0.0) AS txn_revenue, last_transaction,
  coalesce(tickets, 0) AS tickets, coalesce(open_tickets, 0) AS open_tickets, avg_satisfaction,
  coalesce(proposals, 0) AS proposals, coalesce(open_proposal_value, 0.0) AS open_proposal_value
FROM customers c
LEFT JOIN (SELECT customer_id, count(*) AS txn_lines, {MONEY('total_amount')} AS txn_revenue,
           max(transaction_date) AS last_transaction FROM transactions GROUP BY customer_id) t ON c.customer_id = t.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS tickets, count_if(status IN {OPEN_TK}) AS open_tickets,
           avg(satisfaction_score) AS avg_satisfaction FROM tickets GROUP BY customer_id) k ON c.customer_id = k.customer_id
LEFT JOIN (SELECT customer_id, count(*) AS proposals,
           {MONEY(f"CASE WHEN status IN {OPEN_PR} THEN proposal_value END")} AS open_proposal_value
           FROM sales_proposals GROUP BY customer_id) p ON c.customer_id = p.customer_id"""
CTES["c360"] = C360
DEPS["c360"] = ["customers", "transactions", "tickets", "sales_proposals"]
ORACLE["customer_360"] = with_ctes("SELECT * FROM c360", "c360")

ORACLE["churn_heatmap"] = with_ctes("""
SELECT segment, industry, CAST(sum(CAST(CAST(churn_probability * 1000 AS DECIMAL(10,0)) AS BIGINT)) AS DOUBLE) / count(*) / 1000.0 AS mean_churn_probability
FROM churn GROUP BY segment, industry""", "churn")

ORACLE["proposal_pipeline"] = with_ctes(f"""
SELECT created_by, count(*) AS proposals, count_if(status = 'WON') AS won, count_if(status = 'LOST') AS lost,
  CASE WHEN count_if(status IN ('WON', 'LOST')) > 0 THEN count_if(status = 'WON') / count_if(status IN ('WON', 'LOST')) END AS win_rate,
  {MONEY(f"CASE WHEN status IN {OPEN_PR} THEN proposal_value END")} AS open_pipeline_value,
  CAST(sum(CASE WHEN status IN {OPEN_PR} THEN CAST(proposal_value AS DECIMAL(18,2)) * CAST(win_probability AS DECIMAL(4,2)) END) AS DOUBLE) AS weighted_pipeline,
  max(CASE WHEN status IN {OPEN_PR} THEN round(win_probability * value_rank, 9) END) AS best_lead_score
FROM (SELECT *, percent_rank() OVER (ORDER BY proposal_value) AS value_rank FROM sales_proposals) GROUP BY created_by""", "sales_proposals")

ORACLE["ticket_sla"] = with_ctes(f"""
SELECT priority, count(*) AS tickets, count(resolved_date) AS resolved, avg(resolution_time_hours) AS mean_resolution_hours,
  quantile_cont(resolution_time_hours, 0.95) AS p95_resolution_hours, avg(satisfaction_score) AS avg_satisfaction,
  count_if(status IN {OPEN_TK}) AS backlog
FROM tickets GROUP BY priority""", "tickets")

ORACLE["incident_mttr"] = with_ctes("""
SELECT system, severity, count(*) AS incidents, CAST(sum(t) AS DOUBLE) / count(*) / 10.0 AS mttr_hours FROM (
  SELECT unnest(affected_systems) AS system, severity, CAST(round(resolution_time_hours * 10) AS BIGINT) AS t
  FROM incident_reports) GROUP BY system, severity""", "incident_reports")

ORACLE["tag_facets"] = with_ctes("""
SELECT source, tag, count(*) AS n FROM (
  SELECT 'ticket' AS source, unnest(tags) AS tag FROM tickets
  UNION ALL SELECT 'sop', unnest(tags) FROM standard_operating_procedures) GROUP BY source, tag""",
    "tickets", "standard_operating_procedures")

CTES["equip"] = """SELECT device_id, arg_max(operational_status, ("timestamp", reading_id)) AS latest_status,
  arg_max(error_code, ("timestamp", reading_id)) FILTER (WHERE operational_status = 'ERROR') AS last_error_code
FROM telemetry GROUP BY device_id"""
DEPS["equip"] = ["telemetry"]
ORACLE["alerts_panel"] = with_ctes("""
, feed AS (
  SELECT 'SHORTAGE' AS alert_type, inventory_id AS entity_id, risk_level AS severity, recommendation AS detail
  FROM shortage WHERE risk_level IN ('CRITICAL', 'HIGH')
  UNION ALL SELECT 'LATE_SHIPMENT', shipment_id, CASE WHEN days_late > 30 THEN 'HIGH' ELSE 'MEDIUM' END,
    'Late by ' || CAST(days_late AS VARCHAR) || ' days' FROM late
  UNION ALL SELECT 'DEVICE_ERROR', device_id, 'CRITICAL', 'Last fault ' || coalesce(last_error_code, 'unknown')
  FROM equip WHERE latest_status = 'ERROR'),
f2 AS (SELECT *, CASE severity WHEN 'CRITICAL' THEN 1 WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 9 END AS priority FROM feed)
SELECT alert_type, entity_id, severity, detail, priority, CAST(dense_rank() OVER (ORDER BY priority) AS INTEGER) AS alert_rank FROM f2""",
    "shortage", "late", "equip")

ORACLE["device_anomalies"] = with_ctes("""
, st AS (SELECT device_id, count(*) AS readings, count_if(operational_status = 'ERROR') AS errors,
         avg(power_consumption) AS mean_power, stddev_samp(power_consumption) AS std_power FROM telemetry GROUP BY device_id),
o AS (SELECT t.device_id, count(*) AS outliers FROM telemetry t JOIN st ON t.device_id = st.device_id
      WHERE abs(t.power_consumption - st.mean_power) > 3.0 * st.std_power GROUP BY t.device_id)
SELECT st.device_id, readings, errors, errors / readings AS error_rate, round(mean_power, 4) AS mean_power,
  round(std_power, 4) AS std_power, coalesce(outliers, 0) AS outliers
FROM st LEFT JOIN o ON st.device_id = o.device_id""", "telemetry")

ORACLE["reallocate_stock"] = with_ctes("""
, need AS (SELECT part_id, warehouse_id AS to_warehouse, reorder_level - current_quantity AS amt FROM inventory
           WHERE reorder_level - current_quantity > 0),
have AS (SELECT part_id, warehouse_id AS from_warehouse, current_quantity - 2 * reorder_level AS amt FROM inventory
         WHERE current_quantity - 2 * reorder_level > 0),
n AS (SELECT part_id, to_warehouse, sum(amt) OVER (PARTITION BY part_id ORDER BY amt DESC, to_warehouse ROWS UNBOUNDED PRECEDING) - amt AS lo,
        sum(amt) OVER (PARTITION BY part_id ORDER BY amt DESC, to_warehouse ROWS UNBOUNDED PRECEDING) AS hi FROM need),
h AS (SELECT part_id, from_warehouse, sum(amt) OVER (PARTITION BY part_id ORDER BY amt DESC, from_warehouse ROWS UNBOUNDED PRECEDING) - amt AS lo,
        sum(amt) OVER (PARTITION BY part_id ORDER BY amt DESC, from_warehouse ROWS UNBOUNDED PRECEDING) AS hi FROM have)
SELECT n.part_id, from_warehouse, to_warehouse, CAST(least(n.hi, h.hi) - greatest(n.lo, h.lo) AS INTEGER) AS transfer_qty
FROM n JOIN h ON n.part_id = h.part_id AND n.lo < h.hi AND h.lo < n.hi""", "inventory")

ORACLE["expedite_orders"] = with_ctes("""
SELECT * FROM late WHERE status = 'DELAYED'
  AND part_id IN (SELECT part_id FROM inventory WHERE current_quantity <= reorder_level)""", "late", "inventory")

ORACLE["maintenance_tickets"] = with_ctes("""
SELECT 'MT-' || device_id AS ticket_id, device_id,
  arg_max(reading_id, ("timestamp", reading_id)) AS reading_id, arg_max(error_code, ("timestamp", reading_id)) AS error_code,
  max("timestamp") AS fault_ts, arg_max(location_id, ("timestamp", reading_id)) AS location_id, 'HIGH' AS priority
FROM telemetry WHERE maintenance_required AND device_id NOT IN (
  SELECT printf('DEV%04d', CAST(substr(ticket_id, 4) AS BIGINT) % 150 + 1) FROM tickets WHERE status IN ('OPEN', 'IN_PROGRESS', 'ESCALATED'))
GROUP BY device_id""", "telemetry", "tickets")

ORACLE["next_best_action"] = with_ctes("""
SELECT c.customer_id, h.risk_level, h.churn_probability, c.open_tickets, c.open_proposal_value,
  CASE WHEN h.risk_level = 'HIGH' AND c.open_tickets > 0 THEN 'Escalate support and call'
       WHEN h.risk_level = 'HIGH' THEN 'Send re-engagement offer'
       WHEN c.open_proposal_value > 0 THEN 'Follow up on open proposal'
       WHEN h.risk_level = 'MEDIUM' THEN 'Send targeted recommendations' ELSE 'Offer upsell' END AS next_best_action
FROM c360 c JOIN churn h ON c.customer_id = h.customer_id""", "c360", "churn")

_hi, _mid, _lo = (f"CAST({d(C.AS_OF_SALES)} - {n} AS TIMESTAMP)" for n in (0, 182, 364))
ORACLE["upsell_score"] = with_ctes(f"""
SELECT customer_id, coalesce(recent, 0.0) AS recent_spend, coalesce(prior, 0.0) AS prior_spend,
  CASE WHEN coalesce(prior, 0.0) <> 0 THEN (coalesce(recent, 0.0) - coalesce(prior, 0.0)) / coalesce(prior, 0.0) END AS growth
FROM (SELECT customer_id,
        CAST(sum(CASE WHEN transaction_date >= {_mid} THEN CAST(total_amount AS DECIMAL(18,2)) END) AS DOUBLE) AS recent,
        CAST(sum(CASE WHEN transaction_date < {_mid} THEN CAST(total_amount AS DECIMAL(18,2)) END) AS DOUBLE) AS prior
      FROM transactions WHERE transaction_date >= {_lo} AND transaction_date < {_hi} GROUP BY customer_id)""", "transactions")

ORACLE["asof_stock_at_order"] = with_ctes("""
, sd AS (SELECT part_id, shipment_date, max(shipment_id) AS shipment_id FROM shipments GROUP BY part_id, shipment_date),
tx AS (SELECT transaction_id, product_id, transaction_date, CAST(transaction_date AS DATE) AS day FROM transactions)
SELECT tx.transaction_id, tx.product_id, tx.transaction_date, sd.shipment_id AS last_shipment_id,
  sd.shipment_date AS last_shipment_date, CAST(tx.day - sd.shipment_date AS INTEGER) AS days_since_shipment
FROM tx ASOF LEFT JOIN sd ON tx.product_id = sd.part_id AND tx.day >= sd.shipment_date""", "transactions", "shipments")
