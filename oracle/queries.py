"""Oracle SQL per query key (DuckDB dialect), built on the builder CTEs."""

from __future__ import annotations

from millrace import config as C

from .builders import CTES, DEPS, d, lst, ts, with_ctes  # noqa: F401

ORACLE: dict[str, str] = {}


def oracle(key, *ctes, extra=None):
    def deco(body):
        ORACLE[key] = with_ctes(body, *ctes) if extra is None else with_ctes(body, *ctes)
        return body
    return deco


for _name, _key in [("suppliers", "build_suppliers"), ("inventory", "build_inventory"),
                    ("shipments", "build_shipments"), ("customers", "build_customers"),
                    ("transactions", "build_transactions"), ("telemetry", "build_telemetry"),
                    ("tickets", "build_tickets"), ("standard_operating_procedures", "build_sops"),
                    ("incident_reports", "build_incidents"), ("sales_proposals", "build_proposals"),
                    ("support_tickets", "build_support_tickets")]:
    ORACLE[_key] = with_ctes(f"SELECT * FROM {_name}", _name)

DBL = "CAST({} AS DOUBLE)".format

# ---- §2.3 scoring -------------------------------------------------------------------------
USAGE_SQL = f"""
SELECT product_id AS part_id, sum(quantity)::BIGINT AS units_sold,
  CAST(20.0 AS DOUBLE) * CAST(sum(quantity) AS DOUBLE) / CAST(365 AS DOUBLE) AS usage_rate
FROM transactions
WHERE transaction_date >= CAST({d(C.AS_OF_SALES)} - 365 AS TIMESTAMP)
  AND transaction_date < CAST({d(C.AS_OF_SALES)} AS TIMESTAMP)
GROUP BY product_id"""
CTES["usage"] = USAGE_SQL
DEPS["usage"] = ["transactions"]

oracle("part_usage_rate", "usage")("SELECT * FROM usage")

_daily = "greatest(coalesce(u.usage_rate, CAST(0.0 AS DOUBLE)), CAST(0.1 AS DOUBLE))"
_days = f"greatest(1, CAST(trunc(i.current_quantity / {_daily}) AS INTEGER))"
_risk = f"least(CAST(1.0 AS DOUBLE), greatest(CAST(0.0 AS DOUBLE), CAST(14 - {_days} AS DOUBLE) / CAST(14.0 AS DOUBLE)))"
SHORTAGE_SQL = f"""
SELECT i.inventory_id, i.part_id, i.warehouse_id, i.current_quantity,
  {_daily} AS daily_usage_rate,
  {_days} AS days_until_shortage,
  round({_risk}, 3) AS risk_score,
  CASE WHEN {_risk} > 0.8 THEN 'CRITICAL' WHEN {_risk} > 0.5 THEN 'HIGH' WHEN {_risk} > 0.2 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
  CASE WHEN {_risk} > 0.8 THEN 'URGENT: Order immediately. Critical shortage in ' || CAST({_days} AS VARCHAR) || ' days.'
       WHEN {_risk} > 0.5 THEN 'HIGH: Schedule order soon. Shortage expected in ' || CAST({_days} AS VARCHAR) || ' days.'
       WHEN {_risk} > 0.2 THEN 'MEDIUM: Monitor closely. ' || CAST({_days} AS VARCHAR) || ' days of inventory remaining.'
       ELSE 'LOW: Inventory adequate. ' || CAST({_days} AS VARCHAR) || ' days remaining.' END AS recommendation,
  CAST(trunc({_daily} * 30) AS INTEGER) AS suggested_order_quantity,
  {d(C.AS_OF_SHIPPING)} + {_days} AS predicted_shortage_date
FROM inventory i LEFT JOIN usage u ON i.part_id = u.part_id"""
CTES["shortage"] = SHORTAGE_SQL
DEPS["shortage"] = ["inventory", "usage"]
oracle("predict_shortage", "shortage")("SELECT * FROM shortage")

_cd = f"CAST({d(C.AS_OF_SALES)} - last_purchase_date AS INTEGER)"
_avg = "CASE WHEN total_orders > 0 THEN total_spent / total_orders ELSE CAST(0.0 AS DOUBLE) END"
_p = (f"(least(CAST(1.0 AS DOUBLE), {_cd} / CAST(90.0 AS DOUBLE)) * CAST(0.5 AS DOUBLE)"
      f" + greatest(CAST(0.0 AS DOUBLE), CAST(1.0 AS DOUBLE) - total_orders / CAST(20.0 AS DOUBLE)) * CAST(0.3 AS DOUBLE)"
      f" + greatest(CAST(0.0 AS DOUBLE), CAST(1.0 AS DOUBLE) - ({_avg}) / CAST(1000.0 AS DOUBLE)) * CAST(0.2 AS DOUBLE))")
_lvl = f"CASE WHEN {_p} > 0.7 THEN 'HIGH' WHEN {_p} > 0.4 THEN 'MEDIUM' ELSE 'LOW' END"
CHURN_SQL = f"""
SELECT customer_id, segment, industry, {_cd} AS days_since_last_purchase, total_orders AS total_purchases,
  {_avg} AS avg_order_value,
  round({_p}, 3) AS churn_probability,
  {_lvl} AS risk_level,
  list_filter([CASE WHEN {_cd} > 60 THEN 'No purchases in ' || CAST({_cd} AS VARCHAR) || ' days' END,
               CASE WHEN total_orders < 5 THEN 'Low purchase frequency' END,
               CASE WHEN {_avg} < 200 THEN 'Low average order value' END], lambda x: x IS NOT NULL) AS risk_factors,
  CASE WHEN {_lvl} = 'HIGH' THEN ['Send immediate re-engagement campaign', 'Offer personalized discount or incentive', 'Schedule customer success call']
       WHEN {_lvl} = 'MEDIUM' THEN ['Monitor customer activity closely', 'Send targeted product recommendations', 'Consider loyalty program enrollment']
       ELSE ['Continue current engagement strategy'] END AS recommendations
FROM customers"""
CTES["churn"] = CHURN_SQL
DEPS["churn"] = ["customers"]
oracle("predict_churn", "churn")("SELECT * FROM churn")
