"""Oracle SQL for J01–J10 (J05 is rows-only) and I01–I03, I05."""

from millrace.operators import quality as Q
from millrace.sources.schemas import ENUMS, ID_FORMATS, TABLES

from .queries import ORACLE, with_ctes

ALL = ["inventory", "shipments", "suppliers", "standard_operating_procedures", "incident_reports",
       "customers", "transactions", "sales_proposals", "telemetry", "tickets", "support_tickets"]


def duck_pred(p: str) -> str:
    return p.replace("size(", "len(").replace("unix_timestamp(", "epoch(")


def by_table(rules):
    parts = [f"SELECT '{t}' AS table_name, '{r}' AS rule, count_if(coalesce(({p}), false)) AS failed_rows FROM {t}"
             for t, r, p in rules]
    return with_ctes("\nUNION ALL\n".join(parts), *sorted({t for t, _, _ in rules}))


ORACLE["dq_required_columns"] = by_table([(t, f"not_null:{c}", f'"{c}" IS NULL') for t in ALL for c in TABLES[t].required])
ORACLE["dq_id_format"] = by_table([(t, f"id_format:{c}", f"NOT regexp_full_match({c}, '{p}[0-9][0-9-]*')")
                                   for t, c, p in ID_FORMATS])
ORACLE["dq_enums"] = by_table([(t, f"enum:{c}", f"{c} NOT IN ({', '.join(repr(v) for v in vals)})")
                               for (t, c), vals in ENUMS.items()])
ORACLE["dq_ranges"] = by_table(Q.RANGE_RULES)
ORACLE["dq_content"] = by_table([(t, r, duck_pred(p)) for t, r, p in Q.CONTENT_RULES])
ORACLE["dq_business_rules"] = by_table([(t, r, duck_pred(p)) for t, r, p in Q.BUSINESS_RULES])
ORACLE["dq_foreign_keys"] = with_ctes("\nUNION ALL\n".join(
    f"SELECT '{c}' AS table_name, 'fk:{ck}->{p}.{pk}' AS rule, count(*) AS failed_rows FROM {c} "
    f"WHERE {ck} IS NULL OR {ck} NOT IN (SELECT {pk} FROM {p} WHERE {pk} IS NOT NULL)"
    for c, ck, p, pk in Q.FOREIGN_KEYS), *sorted({x for c, _, p, _ in Q.FOREIGN_KEYS for x in (c, p)}))
ORACLE["dq_unique_keys"] = with_ctes("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, 'unique:{TABLES[t].key}' AS rule, CAST(coalesce(sum(n), 0) AS BIGINT) AS failed_rows "
    f"FROM (SELECT count(*) AS n FROM {t} GROUP BY {TABLES[t].key} HAVING count(*) > 1)" for t in ALL), *ALL)

_exp = {"inventory": "(SELECT count(*) * 5 FROM part)", "shipments": "(SELECT count(*) FROM lineitem)",
        "suppliers": "(SELECT count(*) FROM supplier)", "customers": "(SELECT count(*) FROM customer)",
        "transactions": "(SELECT count(*) FROM lineitem)", "telemetry": "(SELECT count(*) FROM events)",
        "tickets": "(SELECT count(*) FROM orders)", "support_tickets": "(SELECT count(*) FROM orders)",
        "standard_operating_procedures": "(SELECT count(*) FROM documents WHERE doc_id % 3 = 0)",
        "incident_reports": "(SELECT count(*) FROM documents WHERE doc_id % 3 = 1)",
        "sales_proposals": "(SELECT count(*) FROM documents WHERE doc_id % 3 = 2)"}
ORACLE["dq_volumes"] = with_ctes("\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, 'row_count' AS rule, {_exp[t]} AS expected, count(*) AS actual, "
    f"abs(count(*) - {_exp[t]}) AS failed_rows FROM {t}" for t in ALL), *ALL)

ENT = """SELECT principal, r_name AS tenant_id FROM (
  SELECT principal, unnest([CAST(substr(principal, 3, 3) AS INTEGER) % 5, (CAST(substr(principal, 3, 3) AS INTEGER) + 1) % 5]) AS rk
  FROM (SELECT DISTINCT sales_rep_id AS principal FROM transactions)) JOIN region ON rk = r_regionkey"""
ORACLE["tenant_rows"] = with_ctes(f"""
, ent AS ({ENT})
SELECT e.principal, t.region, t.transaction_id FROM transactions t JOIN ent e ON t.region = e.tenant_id WHERE e.principal = 'SR001'""", "transactions")
ORACLE["tenant_leaks"] = with_ctes(f"""
, ent AS ({ENT})
SELECT sales_rep_id AS principal, region, transaction_id FROM transactions t
WHERE NOT EXISTS (SELECT 1 FROM ent e WHERE e.principal = t.sales_rep_id AND e.tenant_id = t.region)""", "transactions")
ORACLE["mask_columns"] = with_ctes(f"""
, ent AS ({ENT}),
cr AS (SELECT c.*, r_name AS cust_region FROM customers c LEFT JOIN nation ON c.country = n_name
       LEFT JOIN region ON n_regionkey = r_regionkey),
x AS (SELECT cr.*, cust_region IN (SELECT tenant_id FROM ent WHERE principal = 'SR001') AS ent_ok FROM cr)
SELECT customer_id, customer_name,
  CASE WHEN coalesce(ent_ok, false) THEN contact_name ELSE substr(sha256(contact_name), 1, 12) END AS contact_name,
  CASE WHEN coalesce(ent_ok, false) THEN email ELSE '***@' || split_part(email, '@', -1) END AS email,
  CASE WHEN coalesce(ent_ok, false) THEN phone ELSE '***-' || right(phone, 4) END AS phone,
  coalesce(ent_ok, false) AS entitled
FROM x""", "transactions", "customers")
ORACLE["access_audit"] = """
SELECT 'user' || CAST(user_id AS VARCHAR) AS principal, CAST(ts AS DATE) AS day, event_type AS action,
  count(*) AS accesses, count(DISTINCT json_extract_string(props, '$.k')) AS objects
FROM events GROUP BY ALL"""
