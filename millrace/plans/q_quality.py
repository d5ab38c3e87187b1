"""Queries for §2.10 data quality (J01–J10) and §2.9 governance."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import governance as I
from ..operators import quality as J
from ..sources.schemas import ENUMS, ID_FORMATS, TABLES
from .queries import Ctx, query

ALL_TABLES = ["inventory", "shipments", "suppliers", "standard_operating_procedures", "incident_reports",
              "customers", "transactions", "sales_proposals", "telemetry", "tickets", "support_tickets"]


def tables(c: Ctx):
    return {n: getattr(c, n) for n in ALL_TABLES}


def key_tables(c: Ctx, keys: dict):
    """Tables with some of their columns only, so no join is made for a column that no check reads."""
    return {n: c.only(n, *sorted(cols)) for n, cols in keys.items()}


#: The columns that the rules of a check read, by table.
for _key, _fn, _columns in [
        ("dq_required_columns", J.required_columns, {n: set(TABLES[n].required) for n in ALL_TABLES}),
        ("dq_id_format", J.id_format, J.columns_of_rules([(t, c) for t, c, _ in ID_FORMATS])),
        ("dq_enums", J.enums, J.columns_of_rules(list(ENUMS))),
        ("dq_ranges", J.ranges, J.columns_of_rules([(t, p) for t, _, p in J.RANGE_RULES])),
        ("dq_content", J.content, J.columns_of_rules([(t, p) for t, _, p in J.CONTENT_RULES])),
        ("dq_business_rules", J.business_rules, J.columns_of_rules([(t, p) for t, _, p in J.BUSINESS_RULES]))]:
    query(_key)((lambda f, cols: lambda spark, sf: f(key_tables(Ctx(spark, sf), cols)))(_fn, _columns))


@query("dq_types")
def q_dq_types(spark, sf):
    return J.types(tables(Ctx(spark, sf)))


@query("dq_foreign_keys")
def q_dq_foreign_keys(spark, sf):
    keys: dict = {}
    for child, ck, parent, pk in J.FOREIGN_KEYS:
        keys.setdefault(child, set()).add(ck)
        keys.setdefault(parent, set()).add(pk)
    return J.foreign_keys(key_tables(Ctx(spark, sf), keys))


@query("dq_unique_keys")
def q_dq_unique_keys(spark, sf):
    return J.unique_keys(key_tables(Ctx(spark, sf), {n: {TABLES[n].key} for n in ALL_TABLES}))


def expected_volumes(c: Ctx):
    t = c.t
    n = lambda df, name, mult=1: df.agg((F.count(F.lit(1)) * mult).alias("expected")).select(
        F.lit(name).alias("table_name"), "expected")
    docs = lambda kind, name: c.documents.where(F.pmod("doc_id", F.lit(3)) == kind).agg(
        F.count(F.lit(1)).alias("expected")).select(F.lit(name).alias("table_name"), "expected")
    parts = [n(t.part, "inventory", 5), n(t.lineitem, "shipments"), n(t.supplier, "suppliers"),
             n(t.customer, "customers"), n(t.lineitem, "transactions"), n(t.events, "telemetry"),
             n(t.orders, "tickets"), n(t.orders, "support_tickets"),
             docs(0, "standard_operating_procedures"), docs(1, "incident_reports"), docs(2, "sales_proposals")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("dq_volumes")
def q_dq_volumes(spark, sf):
    c = Ctx(spark, sf)
    return J.volumes(key_tables(c, {n: {TABLES[n].key} for n in ALL_TABLES}), expected_volumes(c))


# ---- governance ------------------------------------------------------------------------------
def entitlements(c: Ctx):
    """Each sales rep is entitled to two regions, chosen by rep number (a rule over reps in the data)."""
    reps = c.only("transactions", "sales_rep_id").select(F.col("sales_rep_id").alias("principal")).distinct()
    k = F.substring("principal", 3, 3).cast("int")
    e = reps.select("principal", F.explode(F.array(F.pmod(k, F.lit(5)), F.pmod(k + 1, F.lit(5)))).alias("rk"))
    # region is a fixed 5-row dimension
    return e.join(F.broadcast(c.region), F.col("rk") == F.col("r_regionkey")).select(
        "principal", F.col("r_name").alias("tenant_id"))


PRINCIPAL = "SR001"


@query("tenant_rows")
def q_tenant_rows(spark, sf):
    c = Ctx(spark, sf)
    rows = c.only("transactions", "transaction_id", "region")
    return I.tenant_rows(rows, entitlements(c), "region", PRINCIPAL).select(F.lit(PRINCIPAL).alias("principal"), "region", "transaction_id")


@query("tenant_leaks")
def q_tenant_leaks(spark, sf):
    c = Ctx(spark, sf)
    handled = c.only("transactions", "transaction_id", "region", "sales_rep_id").withColumnRenamed("sales_rep_id", "principal")
    return I.tenant_leaks(handled, entitlements(c), "region") \
        .select("principal", "region", "transaction_id")


@query("mask_columns")
def q_mask_columns(spark, sf):
    c = Ctx(spark, sf)
    geo = F.broadcast(c.nation.join(c.region, F.col("n_regionkey") == F.col("r_regionkey"))
                      .select(F.col("n_name").alias("country"), F.col("r_name").alias("cust_region")))
    mine = F.broadcast(entitlements(c).where(F.col("principal") == PRINCIPAL)
                       .select(F.col("tenant_id").alias("cust_region"), F.lit(True).alias("_e")))
    cu = c.customers.join(geo, "country", "left").join(mine, "cust_region", "left")
    return I.mask_columns(cu, F.coalesce(F.col("_e"), F.lit(False)))


def request_log(c: Ctx):
    e = c.events
    return e.select(F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("principal"),
                    F.col("event_type").alias("action"), F.get_json_object("props", "$.k").alias("object_id"), "ts")


@query("access_audit")
def q_access_audit(spark, sf):
    return I.access_audit(request_log(Ctx(spark, sf)))
