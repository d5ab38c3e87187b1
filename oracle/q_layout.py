"""Oracle SQL for A02–A13 (A01 create_tables is rows-only: catalog metadata)."""

from .queries import ORACLE, with_ctes

ORACLE["typed_ingest"] = """
SELECT event_id, TRY_CAST(json_extract(props, '$.k') AS INTEGER) AS k, NOT coalesce(json_valid(props), false) AS quarantined
FROM events"""
ORACLE["conform_to_schema"] = """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, TRY_CAST(l_quantity AS INTEGER) AS l_quantity,
  TRY_CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice, TRY_CAST(l_discount AS DECIMAL(4,2)) AS l_discount,
  TRY_CAST(l_tax AS DECIMAL(4,2)) AS l_tax, l_returnflag, l_linestatus, TRY_CAST(l_shipdate AS DATE) AS l_shipdate
FROM lineitem"""
ORACLE["overwrite_table"] = with_ctes("SELECT * FROM suppliers", "suppliers")
ORACLE["insert_overwrite"] = with_ctes("""
SELECT * REPLACE (maintenance_required OR day(reading_date) % 2 = 0 AS maintenance_required) FROM telemetry""", "telemetry")
ORACLE["partitioned_write"] = with_ctes("SELECT * FROM telemetry", "telemetry")
ORACLE["compact_files"] = with_ctes("SELECT * FROM shipments", "shipments")
ORACLE["scan_table"] = "SELECT * FROM lineitem"
ORACLE["evolving_write"] = with_ctes("""
SELECT *, CAST(NULL AS DOUBLE) AS on_time_rate FROM suppliers WHERE status = 'ACTIVE'
UNION ALL
SELECT s.*, o.on_time_rate FROM suppliers s LEFT JOIN on_time o ON s.supplier_id = o.supplier_id WHERE s.status = 'INACTIVE'""",
    "suppliers", "on_time")

_bits, _cols = 31, ["part_no", "warehouse_no"]
_scaled = {c: f"CAST(CASE WHEN (SELECT max({c}) FROM k) = (SELECT min({c}) FROM k) THEN 0 ELSE floor(({c} - (SELECT min({c}) FROM k)) * 2147483647 / "
              f"((SELECT max({c}) FROM k) - (SELECT min({c}) FROM k))) END AS BIGINT)" for c in _cols}
_z = " | ".join(f"(((({_scaled[c]}) >> {b}) & 1) << {b * len(_cols) + i})" for b in range(_bits) for i, c in enumerate(_cols))
ORACLE["cluster_by_keys"] = with_ctes(f"""
, k AS (SELECT *, CAST(substr(part_id, 5) AS BIGINT) AS part_no, CAST(substr(warehouse_id, 3) AS BIGINT) AS warehouse_no
        FROM inventory)
SELECT inventory_id, part_id, part_name, warehouse_id, warehouse_location, current_quantity, reorder_level, reorder_quantity,
  unit_cost, last_updated, category, supplier_id, CAST({_z} AS BIGINT) AS z_value FROM k""", "inventory")


def _po():
    return ORACLE["create_purchase_orders"]


def change_feed_sql():
    return with_ctes(f"""
, po AS (SELECT request_id AS inventory_id, quantity AS received FROM ({_po()}) WHERE status = 'PENDING'),
v1 AS (SELECT inventory_id, supplier_id, current_quantity, reorder_level FROM inventory),
v2 AS (SELECT i.inventory_id, i.supplier_id, CAST(i.current_quantity + coalesce(po.received, 0) AS INTEGER) AS current_quantity,
          i.reorder_level FROM inventory i LEFT JOIN po ON i.inventory_id = po.inventory_id
       WHERE i.supplier_id NOT IN (SELECT supplier_id FROM suppliers WHERE status = 'INACTIVE')),
j AS (SELECT coalesce(v1.inventory_id, v2.inventory_id) AS inventory_id,
        v1.inventory_id IS NOT NULL AS in1, v2.inventory_id IS NOT NULL AS in2,
        v1.supplier_id AS s1, v1.current_quantity AS q1, v1.reorder_level AS l1,
        v2.supplier_id AS s2, v2.current_quantity AS q2, v2.reorder_level AS l2
      FROM v1 FULL OUTER JOIN v2 ON v1.inventory_id = v2.inventory_id)
SELECT inventory_id, s2 AS supplier_id, q2 AS current_quantity, l2 AS reorder_level, 'insert' AS _change_type FROM j WHERE NOT in1
UNION ALL SELECT inventory_id, s1, q1, l1, 'delete' FROM j WHERE NOT in2
UNION ALL SELECT inventory_id, s1, q1, l1, 'update_preimage' FROM j WHERE in1 AND in2 AND (s1, q1, l1) IS DISTINCT FROM (s2, q2, l2)
UNION ALL SELECT inventory_id, s2, q2, l2, 'update_postimage' FROM j WHERE in1 AND in2 AND (s1, q1, l1) IS DISTINCT FROM (s2, q2, l2)""",
                     "inventory", "suppliers")


ORACLE["change_feed"] = change_feed_sql()

_ALL = ["inventory", "shipments", "suppliers", "standard_operating_procedures", "incident_reports",
        "customers", "transactions", "sales_proposals", "telemetry", "tickets", "support_tickets"]
ORACLE["table_row_counts"] = with_ctes(
    ", c AS (" + " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in _ALL) + ")\n"
    "SELECT e.table_name, c.row_count, c.row_count IS NOT NULL AS present FROM (SELECT unnest(["
    + ", ".join(f"'{t}'" for t in _ALL + ["request_log"]) + "]) AS table_name) e LEFT JOIN c ON e.table_name = c.table_name",
    *_ALL)
ORACLE["limit_result"] = with_ctes("""
SELECT inventory_id, part_id, warehouse_id, supplier_id, current_quantity, reorder_level,
  CASE WHEN current_quantity <= reorder_level THEN 'REORDER REQUIRED' WHEN current_quantity <= reorder_level * 1.5 THEN 'LOW STOCK'
       ELSE 'ADEQUATE' END AS stock_status,
  reorder_quantity AS order_quantity,
  CAST(CAST(CAST(unit_cost AS DECIMAL(18,2)) * reorder_quantity AS DECIMAL(18,2)) AS DOUBLE) AS order_cost
FROM inventory WHERE current_quantity <= reorder_level * 1.5
ORDER BY order_cost DESC, inventory_id LIMIT 100""", "inventory")
