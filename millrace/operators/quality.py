"""Data-quality checks. Output rows are ``(table_name, rule, failed_rows)``.

Every check on a table is computed in ONE aggregation pass over that table
(``count_if`` per rule), then unpivoted with ``stack``; tables are combined with
``unionByName``. Rules are SQL predicates (true = the row fails), so the same
rule text can be reviewed, stored and evaluated by Spark.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import ENUMS, ID_FORMATS, TABLES

# --- fixed rule sets -------------------------------------------------------------------------
RANGE_RULES = [
    ("suppliers", "rating_3_to_5", "rating < 3.0 OR rating > 5.0"),
    ("suppliers", "lead_time_ge_3", "lead_time_days < 3"),
    ("inventory", "quantity_ge_0", "current_quantity < 0"),
    ("inventory", "reorder_level_gt_0", "reorder_level <= 0"),
    ("inventory", "unit_cost_gt_0", "unit_cost <= 0"),
    ("customers", "total_orders_ge_1", "total_orders < 1"),
    ("customers", "total_spent_gt_0", "total_spent <= 0"),
    ("customers", "credit_limit_gt_0", "credit_limit <= 0"),
    ("transactions", "quantity_ge_1", "quantity < 1"),
    ("transactions", "unit_price_gt_0", "unit_price <= 0"),
    ("transactions", "total_amount_gt_0", "total_amount <= 0"),
    ("telemetry", "power_gt_0", "power_consumption <= 0"),
    ("tickets", "satisfaction_3_to_5", "satisfaction_score < 3 OR satisfaction_score > 5"),
    ("incident_reports", "resolution_hours_gt_0", "resolution_time_hours <= 0"),
    ("sales_proposals", "value_gt_0", "proposal_value <= 0"),
]
# (table, rule, Spark predicate). Content rules from the reference's assertions.
CONTENT_RULES = [
    ("standard_operating_procedures", "text_gt_100_chars", "length(procedure_text) <= 100"),
    ("standard_operating_procedures", "has_prerequisites", "NOT contains(procedure_text, 'Prerequisites:')"),
    ("standard_operating_procedures", "has_steps", "NOT contains(procedure_text, 'Procedure Steps:')"),
    ("standard_operating_procedures", "tags_ge_2", "size(tags) < 2"),
    ("incident_reports", "description_gt_100_chars", "length(incident_description) <= 100"),
    ("incident_reports", "affected_systems_ge_1", "size(affected_systems) < 1"),
    ("sales_proposals", "content_gt_100_chars", "length(proposal_content) <= 100"),
    ("sales_proposals", "has_executive_summary", "NOT contains(proposal_content, 'EXECUTIVE SUMMARY:')"),
    ("sales_proposals", "products_ge_1", "size(products) < 1"),
]
BUSINESS_RULES = [
    ("inventory", "reorder_qty_is_3x_level", "reorder_quantity <> 3 * reorder_level"),
    ("transactions", "tax_is_8pct_of_net",
     "CAST(tax_amount AS DECIMAL(18,2)) <> CAST((CAST(total_amount AS DECIMAL(18,2)) - CAST(discount_amount AS DECIMAL(18,2))) * 0.08 AS DECIMAL(18,2))"),
    ("tickets", "resolved_after_created", "resolved_date < created_date"),
    ("tickets", "hours_match_dates",
     "abs((unix_timestamp(resolved_date) - unix_timestamp(created_date)) / 3600.0 - resolution_time_hours) > 0.01"),
    ("shipments", "delivered_iff_actual_date", "(status = 'DELIVERED') <> (actual_delivery IS NOT NULL)"),
    ("shipments", "delivery_not_before_shipping", "actual_delivery < shipment_date"),
]
FOREIGN_KEYS = [
    ("inventory", "supplier_id", "suppliers", "supplier_id"),
    ("shipments", "part_id", "inventory", "part_id"),
    ("shipments", "supplier_id", "suppliers", "supplier_id"),
    ("transactions", "customer_id", "customers", "customer_id"),
    ("transactions", "product_id", "inventory", "part_id"),
    ("tickets", "customer_id", "customers", "customer_id"),
    ("sales_proposals", "customer_id", "customers", "customer_id"),
    ("support_tickets", "ticket_id", "tickets", "ticket_id"),
]


def columns_of_rules(rules: list[tuple[str, str]]) -> dict[str, set]:
    """The columns of each table that predicates (table, SQL text) name."""
    out: dict[str, set] = {}
    for table, text in rules:
        words = set(re.findall(r"[A-Za-z_]+", re.sub(r"'[^']*'", "", text)))
        out.setdefault(table, set()).update(words & set(TABLES[table].schema.names))
    return out


def _one_pass(table_name: str, df: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """count_if of every (rule, failing-predicate) in one aggregation, unpivoted to rows."""
    if not rules:
        return None
    aggs = [F.count_if(F.coalesce(F.expr(pred), F.lit(False))).alias(f"r{i}") for i, (_, pred) in enumerate(rules)]
    wide = df.agg(*aggs)
    stack = "stack({n}, {pairs}) AS (rule, failed_rows)".format(
        n=len(rules), pairs=", ".join(f"'{r}', r{i}" for i, (r, _) in enumerate(rules)))
    return wide.select(F.lit(table_name).alias("table_name"), F.expr(stack))


def _union(parts):
    parts = [p for p in parts if p is not None]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _by_table(tables: dict, rules) -> DataFrame:
    grouped: dict[str, list] = {}
    for t, r, pred in rules:
        grouped.setdefault(t, []).append((r, pred))
    return _union([_one_pass(t, tables[t], rs) for t, rs in grouped.items() if t in tables])


def required_columns(tables: dict) -> DataFrame:
    """Required columns missing from the table, and NULLs in required columns."""
    parts = []
    for name, df in tables.items():
        spec = TABLES[name]
        present = set(df.columns)
        rules = [(f"not_null:{c}", f"`{c}` IS NULL") for c in spec.required if c in present]
        missing = [c for c in spec.required if c not in present]
        p = _one_pass(name, df, rules)
        parts.append(p)
        for c in missing:  # a missing column fails every row
            parts.append(df.agg(F.count(F.lit(1)).alias("failed_rows")).select(
                F.lit(name).alias("table_name"), F.lit(f"missing:{c}").alias("rule"), "failed_rows"))
    return _union(parts)


def id_format(tables: dict) -> DataFrame:
    """Ids carry their prefix followed by digits (and dashes)."""
    rules = [(t, f"id_format:{c}", f"NOT ({c} RLIKE '^{p}[0-9][0-9-]*$')") for t, c, p in ID_FORMATS]
    return _by_table(tables, rules)


def enums(tables: dict) -> DataFrame:
    """Enumerated columns hold only their domain values."""
    rules = [(t, f"enum:{c}", f"{c} NOT IN ({', '.join(repr(v) for v in vals)})") for (t, c), vals in ENUMS.items()]
    return _by_table(tables, rules)


def ranges(tables: dict) -> DataFrame:
    """Numeric ranges (NULL-safe: a NULL is not a range failure)."""
    return _by_table(tables, RANGE_RULES)


def types(tables: dict) -> DataFrame:
    """Declared vs actual column types; one row per column with a mismatch flag."""
    spark = next(iter(tables.values())).sparkSession
    rows = []
    for name, df in tables.items():
        actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        for f in TABLES[name].schema.fields:
            a = actual.get(f.name)
            rows.append((name, f"type:{f.name}", f.dataType.simpleString(), a, 0 if a == f.dataType.simpleString() else 1))
    return spark.createDataFrame(rows, "table_name string, rule string, expected string, actual string, failed_rows int")


def foreign_keys(tables: dict) -> DataFrame:
    """Child rows whose key has no parent (left anti join against distinct parent keys)."""
    parts = []
    for child, ck, parent, pk in FOREIGN_KEYS:
        if child not in tables or parent not in tables:
            continue
        keys = tables[parent].select(F.col(pk).alias("_k")).distinct()
        orphans = tables[child].select(F.col(ck).alias("_k")).join(keys, "_k", "left_anti")
        parts.append(orphans.agg(F.count(F.lit(1)).alias("failed_rows")).select(
            F.lit(child).alias("table_name"), F.lit(f"fk:{ck}->{parent}.{pk}").alias("rule"), "failed_rows"))
    return _union(parts)


def volumes(tables: dict, expected: DataFrame) -> DataFrame:
    """Actual row count per table against the expected count (``table_name, expected``)."""
    counts = _union([df.agg(F.count(F.lit(1)).alias("actual")).select(F.lit(n).alias("table_name"), "actual")
                     for n, df in tables.items()])
    j = expected.join(counts, "table_name", "left")
    return j.select("table_name", F.lit("row_count").alias("rule"), "expected",
                    F.coalesce("actual", F.lit(0)).alias("actual"),
                    F.abs(F.coalesce("actual", F.lit(0)) - F.col("expected")).alias("failed_rows"))


def content(tables: dict) -> DataFrame:
    """Text length, section headers and minimum array sizes."""
    return _by_table(tables, CONTENT_RULES)


def business_rules(tables: dict) -> DataFrame:
    """Cross-column business rules."""
    return _by_table(tables, BUSINESS_RULES)


def unique_keys(tables: dict) -> DataFrame:
    """Rows whose declared key is not unique (sum of counts of repeated keys)."""
    parts = []
    for name, df in tables.items():
        k = TABLES[name].key
        dup = df.groupBy(k).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        parts.append(dup.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failed_rows")).select(
            F.lit(name).alias("table_name"), F.lit(f"unique:{k}").alias("rule"), "failed_rows"))
    return _union(parts)
