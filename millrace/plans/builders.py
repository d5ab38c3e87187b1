"""The 11 domain tables derived, as joins and projections, from the driver tables.

Every column is a deterministic function of source keys (no random numbers, no
current date), so the same input always gives the same table and a SQL oracle
can repeat it. Only fixed-size dimensions (``nation``: 25 rows, ``region``: 5
rows, literal vocabularies) are broadcast explicitly; all fact–fact and
fact–entity joins are left to the planner, which shuffles on the join key and
lets AQE switch to a broadcast only when the measured size is under the
threshold.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..sources.schemas import TABLES
from ..sources.tables import Tables


def pick(values: list, idx: Column) -> Column:
    """``values[idx mod len]`` for a literal vocabulary."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.pmod(idx, F.lit(len(values))).cast("int") + 1)


def money(c: Column) -> Column:
    """Round a double money amount to cents exactly (DECIMAL, half up)."""
    return c.cast("decimal(18,2)")


def nat(t: Tables) -> DataFrame:
    # nation is a fixed 25-row dimension: broadcasting it is bounded by construction.
    return F.broadcast(t.nation.select("n_nationkey", "n_name", "n_regionkey"))


def _wants(want: set | None, *columns: str) -> bool:
    """Is any of these columns asked for? ``want`` None asks for all of them."""
    return want is None or not want.isdisjoint(columns)


def _select(df: DataFrame, want: set | None, table: str, columns: list[Column]) -> DataFrame:
    """The wanted ones of a table's columns, given in the order of its schema; those left out may refer
    to tables that were not joined."""
    names = TABLES[table].schema.names
    return df.select(*[c for n, c in zip(names, columns, strict=True) if _wants(want, n)])


def _id(pattern: str, key: Column) -> Column:
    """A prefixed id; NULL for a NULL key."""
    return F.when(key.isNotNull(), F.format_string(pattern, key))


def suppliers(t: Tables) -> DataFrame:
    """B01 build_suppliers."""
    k = F.col("s_suppkey")
    s = t.supplier.join(nat(t), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return s.select(
        F.format_string("SUP%04d", k + 1).alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.concat(F.lit("Contact "), (k + 1).cast("string")).alias("contact_name"),
        F.concat(F.lit("orders"), (k + 1).cast("string"), F.lit("@supplier.example")).alias("contact_email"),
        F.format_string("+1-555-%04d", F.pmod(k, F.lit(10000))).alias("contact_phone"),
        F.concat((k + 1).cast("string"), F.lit(" Industrial Way")).alias("address"),
        F.col("n_name").alias("city"),
        F.col("n_name").alias("country"),
        ((F.pmod(k * 7, F.lit(21)) + 30) / 10.0).alias("rating"),
        (F.pmod(k * 11, F.lit(28)) + 3).cast("int").alias("lead_time_days"),
        pick(C.SUPPLIER_PAYMENT_TERMS, k).alias("payment_terms"),
        F.when(F.pmod(k, F.lit(10)) == 9, "INACTIVE").otherwise("ACTIVE").alias("status"),
        F.date_add(F.lit(C.AS_OF_SHIPPING), -(F.pmod(k * 37, F.lit(730)) + 400).cast("int")).alias("created_date"),
        F.date_add(F.lit(C.AS_OF_SHIPPING), -F.pmod(k * 13, F.lit(180)).cast("int")).alias("last_order_date"),
    )


def warehouses_col() -> Column:
    return F.array(*[F.struct(F.lit(i).alias("w_idx"), F.lit(w).alias("warehouse_id"),
                              F.lit(loc).alias("warehouse_location"))
                     for i, (w, loc) in enumerate(C.WAREHOUSES)])


def inventory(t: Tables) -> DataFrame:
    """B02 build_inventory: every part in each of the five warehouses.

    The warehouse fan-out is an ``explode`` of a literal 5-element array, a
    fixed 5x expansion of ``part`` (no join at all). The supplier is chosen
    from the supplier count, a scalar subquery.
    """
    n_sup = t.supplier.select(F.count(F.lit(1))).scalar()
    k = F.col("p_partkey")
    r = F.col("w.w_idx")
    p = t.part.select("p_partkey", "p_name", "p_retailprice", F.explode(warehouses_col()).alias("w"))
    part_id = F.format_string("PART%05d", k + 1)
    return p.select(
        F.concat(part_id, F.lit("-"), F.col("w.warehouse_id")).alias("inventory_id"),
        part_id.alias("part_id"),
        F.col("p_name").alias("part_name"),
        F.col("w.warehouse_id").alias("warehouse_id"),
        F.col("w.warehouse_location").alias("warehouse_location"),
        F.pmod(k * 37 + r * 101, F.lit(1001)).cast("int").alias("current_quantity"),
        (F.pmod(k * 13 + r * 7, F.lit(151)) + 50).cast("int").alias("reorder_level"),
        ((F.pmod(k * 13 + r * 7, F.lit(151)) + 50) * 3).cast("int").alias("reorder_quantity"),
        F.col("p_retailprice").alias("unit_cost"),
        (F.lit(C.AS_OF_SHIPPING).cast("timestamp")
         - F.make_dt_interval(hours=F.pmod(k * 7 + r * 3, F.lit(72)).cast("int"))).alias("last_updated"),
        pick(C.PART_CATEGORIES, k).alias("category"),
        F.when(n_sup > 0, F.format_string("SUP%04d", F.try_mod(k * 31 + r, n_sup) + 1)).otherwise(C.DEFAULT_SUPPLIER).alias("supplier_id"),
    )


def shipments(t: Tables, want: set | None = None) -> DataFrame:
    """B03 build_shipments: one shipment per line item, also where part or supplier are missing."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    j = li
    if _wants(want, "part_name"):
        p = t.part.select("p_partkey", "p_name")
        j = j.join(p, j.l_partkey == p.p_partkey, "left")
    if _wants(want, "supplier_name", "origin_location"):
        s = t.supplier.select("s_suppkey", "s_name", "s_nationkey")
        if _wants(want, "origin_location"):
            s = s.join(nat(t), F.col("s_nationkey") == F.col("n_nationkey"), "left")
        j = j.join(s, j.l_suppkey == s.s_suppkey, "left")
    o, ln = F.col("l_orderkey"), F.col("l_linenumber")
    ship = F.to_date("l_shipdate")
    expected = F.date_add(ship, (F.pmod(o * 7 + ln, F.lit(14)) + 1).cast("int"))
    status = pick(C.SHIPMENT_STATUSES, o * 3 + ln)
    wh = F.pmod(o + ln, F.lit(len(C.WAREHOUSES)))
    return _select(j, want, "shipments", [
        F.format_string("SHP%d-%d", o, ln).alias("shipment_id"),
        F.format_string("ORD%06d", o).alias("order_id"),
        F.format_string("PART%05d", F.col("l_partkey") + 1).alias("part_id"),
        F.col("p_name").alias("part_name"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.format_string("SUP%04d", F.col("l_suppkey") + 1).alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
        F.col("n_name").alias("origin_location"),
        pick([loc for _, loc in C.WAREHOUSES], wh).alias("destination_location"),
        ship.alias("shipment_date"),
        expected.alias("expected_delivery"),
        F.when(status == "DELIVERED",
               F.date_add(expected, (F.pmod(F.col("l_partkey"), F.lit(6)) - 2).cast("int"))).alias("actual_delivery"),
        status.alias("status"),
        pick(C.CARRIERS, o + F.col("l_suppkey")).alias("carrier"),
        F.format_string("TRK%010d", o * 10 + ln).alias("tracking_number"),
        (F.col("l_quantity") * 10 + 50).cast("double").alias("cost"),
    ])


def customer_orders(t: Tables) -> DataFrame:
    """Orders pre-aggregated per customer before any join (map-side partial aggregation)."""
    return t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(money(F.col("o_totalprice"))).alias("spent"),
        F.max(F.to_date("o_orderdate")).alias("last_purchase"))


def customers(t: Tables, want: set | None = None) -> DataFrame:
    """B04 build_customers."""
    k = F.col("c_custkey")
    c = t.customer
    if _wants(want, "status", "total_orders", "total_spent", "last_purchase_date"):
        c = c.join(customer_orders(t), F.col("c_custkey") == F.col("o_custkey"), "left")
    if _wants(want, "city", "country"):
        c = c.join(nat(t), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    days = F.datediff(F.lit(C.AS_OF_SALES), F.col("last_purchase"))
    lapsed = days.isNull() | (days > 180)
    return _select(c, want, "customers", [
        F.format_string("CUST%05d", k + 1).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lit("Buyer "), (k + 1).cast("string")).alias("contact_name"),
        F.concat(F.lit("buyer"), (k + 1).cast("string"), F.lit("@customer.example")).alias("email"),
        F.format_string("+1-555-%07d", k).alias("phone"),
        F.col("c_mktsegment").alias("industry"),
        pick(C.SEGMENTS, k).alias("segment"),
        F.concat((k + 1).cast("string"), F.lit(" Market Street")).alias("address"),
        F.col("n_name").alias("city"),
        F.col("n_name").alias("country"),
        F.date_add(F.lit(C.AS_OF_SALES), -(F.pmod(k * 17, F.lit(1460)) + 2400).cast("int")).alias("created_date"),
        F.when(lapsed, F.when(F.pmod(k, F.lit(2)) == 0, "INACTIVE").otherwise("CHURNED"))
         .otherwise("ACTIVE").alias("status"),
        F.coalesce(F.col("n_orders"), F.lit(0)).cast("int").alias("total_orders"),
        F.coalesce(F.col("spent"), F.lit(Decimal("0.00"))).cast("double").alias("total_spent"),
        F.col("last_purchase").alias("last_purchase_date"),
        (F.pmod(k * 997, F.lit(490000)) + 10000).cast("double").alias("credit_limit"),
        pick(C.CUSTOMER_PAYMENT_TERMS, F.floor(k / 3)).alias("payment_terms"),
    ])


def transactions(t: Tables, want: set | None = None) -> DataFrame:
    """B05 build_transactions: one sale per line item, priced in exact cents, also where order, customer or
    part are missing."""
    j = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount")
    if _wants(want, "customer_id", "customer_name", "transaction_date", "region"):
        o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
        j = j.join(o, j.l_orderkey == o.o_orderkey, "left")
    if _wants(want, "customer_name", "region"):
        c = t.customer.select("c_custkey", "c_name", "c_nationkey")
        j = j.join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
    if _wants(want, "product_name", "unit_price"):
        p = t.part.select("p_partkey", "p_name", "p_retailprice")
        j = j.join(p, F.col("l_partkey") == F.col("p_partkey"), "left")
    if _wants(want, "region"):
        geo = nat(t).join(F.broadcast(t.region.select("r_regionkey", "r_name")),
                          F.col("n_regionkey") == F.col("r_regionkey"))
        j = j.join(geo, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    ok = F.col("l_orderkey")
    total = money(F.col("l_extendedprice"))
    discount = (total * F.col("l_discount").cast("decimal(6,4)")).cast("decimal(18,2)")
    tax = ((total - discount) * F.lit(Decimal("0.08"))).cast("decimal(18,2)")
    rep = F.pmod(ok, F.lit(20)) + 1
    return _select(j, want, "transactions", [
        F.format_string("TXN%d-%d", ok, F.col("l_linenumber")).alias("transaction_id"),
        F.format_string("ORD%06d", ok).alias("order_id"),
        _id("CUST%05d", F.col("o_custkey") + 1).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("o_orderdate").alias("transaction_date"),
        F.format_string("PART%05d", F.col("l_partkey") + 1).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").alias("unit_price"),
        total.cast("double").alias("total_amount"),
        discount.cast("double").alias("discount_amount"),
        tax.cast("double").alias("tax_amount"),
        pick(C.PAYMENT_METHODS, ok).alias("payment_method"),
        F.format_string("SR%03d", rep).alias("sales_rep_id"),
        F.concat(F.lit("Rep "), rep.cast("string")).alias("sales_rep_name"),
        F.col("r_name").alias("region"),
        F.when(F.pmod(ok, F.lit(10)) == 9, "PENDING").otherwise("COMPLETED").alias("status"),
    ])


def telemetry(t: Tables) -> DataFrame:
    """B06 build_telemetry: one reading per event; sensor columns NULL by device type."""
    e = t.events
    u, eid = F.col("user_id"), F.col("event_id")
    kind = F.pmod(u, F.lit(len(C.DEVICE_TYPES)))
    k = F.get_json_object("props", "$.k").try_cast("int")
    err = F.col("event_type") == "error"
    return e.select(
        F.concat(F.lit("R"), eid.cast("string")).alias("reading_id"),
        F.format_string("DEV%04d", u + 1).alias("device_id"),
        pick(C.DEVICE_TYPES, u).alias("device_type"),
        pick(C.DEVICE_LOCATIONS, u).alias("location_id"),
        F.col("ts").alias("timestamp"),
        ((F.pmod(eid * 7, F.lit(100)) + 200) / 10.0).alias("temperature"),
        F.when(kind != 1, (F.pmod(eid * 11, F.lit(200)) + 400) / 10.0).alias("humidity"),
        F.when(kind != 0, (F.pmod(eid * 13, F.lit(400)) + 800) / 10.0).alias("pressure"),
        F.when(kind >= 2, F.pmod(eid * 3, F.lit(100)) / 10.0).alias("vibration"),
        F.col("value").alias("power_consumption"),
        F.when(err, F.when(F.pmod(eid, F.lit(4)) == 0, "WARNING").otherwise("ERROR")).otherwise("NORMAL").alias("operational_status"),
        F.when(err, F.concat(F.lit("E"), (k + 100).cast("string"))).alias("error_code"),
        (err & (F.pmod(k, F.lit(2)) == 0)).alias("maintenance_required"),
        F.to_date("ts").alias("reading_date"),
    )


def _ticket_description(o: Column) -> Column:
    idx = F.pmod(o, F.lit(len(C.TICKET_TEMPLATES)))
    a = F.pmod(o, F.lit(10)) + 1
    b = F.pmod(o, F.lit(900)) + 100
    expr = None
    for i, tpl in enumerate(C.TICKET_TEMPLATES):
        v = F.format_string(tpl, a if "%06d" not in tpl else o, b)
        expr = F.when(idx == i, v) if expr is None else expr.when(idx == i, v)
    return expr


def tickets(t: Tables, want: set | None = None) -> DataFrame:
    """B07 build_tickets: one support ticket per order; resolution fields by age."""
    j = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    if _wants(want, "customer_name"):
        c = t.customer.select("c_custkey", "c_name")
        j = j.join(c, F.col("o_custkey") == F.col("c_custkey"), "left")
    ok = F.col("o_orderkey")
    age = F.datediff(F.lit(C.AS_OF_SALES), F.to_date("o_orderdate"))
    old = age > 7
    hours = F.pmod(ok * 17, F.lit(168)) + 1
    resolved = F.col("o_orderdate") + F.make_dt_interval(hours=hours.cast("int"))
    prio = (F.when(F.col("o_orderpriority").startswith("1"), "CRITICAL")
             .when(F.col("o_orderpriority").startswith("2"), "HIGH")
             .when(F.col("o_orderpriority").startswith("3"), "MEDIUM").otherwise("LOW"))
    n_tags = F.pmod(ok, F.lit(4)).cast("int")
    tags = F.slice(F.array(*[F.lit(x) for x in C.TICKET_TAGS]),
                   (F.pmod(ok, F.lit(3)) + 1).cast("int"), n_tags)
    return _select(j, want, "tickets", [
        F.format_string("TKT%08d", ok).alias("ticket_id"),
        _id("CUST%05d", F.col("o_custkey") + 1).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("o_orderdate").alias("created_date"),
        pick(C.TICKET_CATEGORIES, ok).alias("category"),
        prio.alias("priority"),
        pick(C.TICKET_SUBJECTS, ok).alias("subject"),
        _ticket_description(ok).alias("description"),
        F.when(old, pick(["RESOLVED", "CLOSED"], ok))
         .otherwise(pick(["OPEN", "IN_PROGRESS", "ESCALATED"], ok)).alias("status"),
        F.concat(F.lit("Agent "), (F.pmod(ok, F.lit(10)) + 1).cast("string")).alias("assigned_to"),
        F.when(old, resolved).alias("resolved_date"),
        F.when(old, hours.cast("double")).alias("resolution_time_hours"),
        F.when(old, pick(C.SATISFACTION_SCORES, ok)).cast("int").alias("satisfaction_score"),
        tags.alias("tags"),
    ])


def support_tickets(t: Tables, want: set | None = None) -> DataFrame:
    """B11 build_support_tickets: search-ready projection of tickets."""
    tk = tickets(t)
    if want is not None and "customer_name" not in want:
        tk = tickets(t, want=set(tk.columns) - {"customer_name"}).withColumn("customer_name", F.lit(None).cast("string"))
    return tk.select(
        F.concat(F.lit("ST-"), F.col("ticket_id")).alias("id"),
        "ticket_id", "customer_id", "customer_name",
        F.concat_ws("\n\n", "subject", "description").alias("ticket_content"),
        F.col("description").alias("problem_description"),
        F.concat(F.lit("Status: "), F.col("status"), F.lit(". Assigned to: "), F.col("assigned_to")).alias("resolution"),
        "category",
        F.lit(C.SUPPORT_PRODUCT).alias("product_affected"),
        "created_date", "resolved_date", "priority",
        F.coalesce(F.col("tags"), F.array().cast("array<string>")).alias("tags"),
    )


def _doc_kind(t: Tables, kind: int) -> DataFrame:
    """Documents of one kind (doc_id mod 3: 0 SOP, 1 incident, 2 proposal); the three kinds
    together cover every document."""
    d = t.documents.select("doc_id", "text").where(F.pmod(F.col("doc_id"), F.lit(3)) == kind)
    return d.withColumn("lines", F.split(F.col("text"), "\n"))


def _line(i: int) -> Column:
    return F.coalesce(F.try_element_at(F.col("lines"), F.lit(i)), F.lit(""))


def sops(t: Tables) -> DataFrame:
    """B08 build_sops: procedure text assembled from a document's lines under section headers."""
    d = _doc_kind(t, 0)
    k = F.col("doc_id")
    prereq = F.transform(F.slice("lines", 2, 2), lambda x: F.concat(F.lit("- "), x))
    steps = F.transform(F.slice("lines", 4, 1 << 30),
                        lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x))
    safety = F.transform(F.slice("lines", F.greatest(F.size("lines") - 1, F.lit(1)), 2), lambda x: F.concat(F.lit("- "), x))
    text = F.concat(_line(1), F.lit("\n\nPrerequisites:\n"), F.array_join(prereq, "\n"),
                    F.lit("\n\nProcedure Steps:\n"), F.array_join(steps, "\n"),
                    F.lit("\n\nSafety Considerations:\n"), F.array_join(safety, "\n"))
    eff = F.date_add(F.lit(C.AS_OF_SHIPPING), -(F.pmod(k * 13, F.lit(540)) + 200).cast("int"))
    return d.select(
        F.concat(F.lit("SOP-"), k.cast("string")).alias("id"),
        F.concat(pick(C.SOP_NAMES, k), F.lit(" - Rev "), (F.pmod(k, F.lit(5)) + 1).cast("string")).alias("procedure_name"),
        text.alias("procedure_text"),
        pick(C.SOP_CATEGORIES, F.floor(k / 3)).alias("category"),
        pick(C.SOP_DEPARTMENTS, F.floor(k / 7)).alias("department"),
        F.concat((F.pmod(k, F.lit(3)) + 1).cast("string"), F.lit("."), F.pmod(k, F.lit(10)).cast("string")).alias("version"),
        eff.alias("effective_date"),
        F.date_add(eff, (F.pmod(k, F.lit(151)) + 30).cast("int")).alias("last_reviewed"),
        F.date_add(F.lit(C.AS_OF_SHIPPING), (F.pmod(k, F.lit(336)) + 30).cast("int")).alias("next_review"),
        F.concat(F.lit("Author "), (F.pmod(k, F.lit(25)) + 1).cast("string")).alias("created_by"),
        F.slice(F.array(*[F.lit(x) for x in C.SOP_TAGS]), (F.pmod(k, F.lit(3)) + 1).cast("int"),
                (F.pmod(F.floor(k / 3), F.lit(3)) + 2).cast("int")).alias("tags"),
    )


def incidents(t: Tables) -> DataFrame:
    """B09 build_incidents."""
    d = _doc_kind(t, 1)
    k = F.col("doc_id")
    sev = F.pmod(F.floor(k / 3), F.lit(10))
    severity = F.when(sev < 4, "LOW").when(sev < 7, "MEDIUM").when(sev < 9, "HIGH").otherwise("CRITICAL")
    # Every line after the third is an action taken; those after the fourth are the immediate response.
    def listed(start: int) -> Column:
        return F.array_join(F.transform(F.slice("lines", start, 1 << 30), lambda x: F.concat(F.lit("- "), x)), "\n")

    last = F.coalesce(F.try_element_at(F.col("lines"), F.lit(-1)), F.lit(""))
    desc = F.concat(_line(1), F.lit("\n\nInitial Detection: "), _line(2), F.lit("\nImmediate Impact: "),
                    _line(3), F.lit("\nActions Taken:\n"), listed(4))
    resolution = F.concat(F.lit("Immediate Response:\n"), listed(5), F.lit("\n\nPermanent Fix: "), last)
    return d.select(
        F.concat(F.lit("INC-"), k.cast("string")).alias("id"),
        pick(C.INCIDENT_TITLES, F.floor(k / 3)).alias("incident_title"),
        desc.alias("incident_description"),
        (F.lit(C.AS_OF_SHIPPING).cast("timestamp")
         - F.make_dt_interval(hours=(F.pmod(k * 7919, F.lit(8760)) + 24).cast("int"))).alias("incident_date"),
        severity.alias("severity"),
        pick(C.INCIDENT_CATEGORIES, F.floor(k / 3)).alias("category"),
        F.slice(F.array(*[F.lit(x) for x in C.AFFECTED_SYSTEMS]), (F.pmod(k, F.lit(3)) + 1).cast("int"),
                (F.pmod(F.floor(k / 3), F.lit(3)) + 1).cast("int")).alias("affected_systems"),
        resolution.alias("resolution"),
        ((F.pmod(k * 37, F.lit(716)) + 5) / 10.0).alias("resolution_time_hours"),
        last.alias("root_cause"),
        _line(1).alias("preventive_measures"),
        F.concat(F.lit("Reporter "), (F.pmod(k, F.lit(30)) + 1).cast("string")).alias("reported_by"),
        F.concat(F.lit("Engineer "), (F.pmod(k, F.lit(12)) + 1).cast("string")).alias("resolved_by"),
    )


def proposals(t: Tables, want: set | None = None) -> DataFrame:
    """B10 build_proposals: proposal documents joined to their customer."""
    n_cust = t.customer.select(F.count(F.lit(1))).scalar()
    j = _doc_kind(t, 2).withColumn("cust_key", F.try_mod(F.col("doc_id"), n_cust))
    if _wants(want, "customer_name", "proposal_content", "executive_summary"):
        c = t.customer.select("c_custkey", "c_name")
        j = j.join(c, F.col("cust_key") == F.col("c_custkey"), "left")
    k = F.col("doc_id")
    q = F.floor(k / 3)
    pdate = F.date_add(F.lit(C.AS_OF_SALES), -F.pmod(k * 11, F.lit(365)).cast("int"))
    age = F.pmod(k * 11, F.lit(365))
    status = (F.when(age > 60, pick(["WON", "LOST", "LOST"], q))
               .when(age > 30, pick(["UNDER_REVIEW", "SENT"], q))
               .otherwise(pick(["DRAFT", "SENT"], q)))
    product = pick(C.PROPOSAL_PRODUCTS, k)
    summary = F.concat(F.lit("Proposal for "), product, F.lit(" implementation at "), F.coalesce("c_name", F.lit("")),
                       F.lit(". "), _line(1))
    phases = F.transform(F.slice("lines", 4, 1 << 30),
                         lambda x, i: F.concat(F.lit("Phase "), (i + 1).cast("string"), F.lit(": "), x))
    content = F.concat(F.lit("EXECUTIVE SUMMARY:\n"), summary, F.lit("\n\nBUSINESS CASE:\n"), _line(2),
                       F.lit("\n\nPROPOSED SOLUTION:\n"), _line(3), F.lit("\n\nIMPLEMENTATION TIMELINE:\n"),
                       F.array_join(phases, "\n"), F.lit("\n\nINVESTMENT SUMMARY:\n"),
                       F.coalesce(F.try_element_at(F.col("lines"), F.lit(-1)), F.lit("")))
    return _select(j, want, "sales_proposals", [
        F.concat(F.lit("PRP-"), k.cast("string")).alias("id"),
        F.format_string("PROP%06d", k).alias("proposal_id"),
        _id("CUST%05d", F.col("cust_key") + 1).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        pdate.alias("proposal_date"),
        content.alias("proposal_content"),
        summary.alias("executive_summary"),
        (F.pmod(k * 7907, F.lit(1950000)) + 50000).cast("double").alias("proposal_value"),
        F.slice(F.array(*[F.lit(x) for x in C.PROPOSAL_PRODUCTS]), (F.pmod(k, F.lit(4)) + 1).cast("int"),
                (F.pmod(q, F.lit(3)) + 1).cast("int")).alias("products"),
        status.alias("status"),
        F.date_add(pdate, 90).alias("valid_until"),
        F.concat(F.lit("Rep "), (F.pmod(q, F.lit(20)) + 1).cast("string")).alias("created_by"),
        F.when(status.isin("SENT", "UNDER_REVIEW"), (F.pmod(k, F.lit(81)) + 10) / 100.0).alias("win_probability"),
        F.when(F.pmod(q, F.lit(2)) == 0, F.concat(F.lit("Competitor "), F.pmod(k, F.lit(7)).cast("string"))).alias("competitor_info"),
        F.when(F.pmod(q, F.lit(10)) >= 7, _line(2)).alias("notes"),
    ])


#: Builders that take the wanted columns; the others join nothing that could be left out.
PRUNED = {"shipments", "customers", "transactions", "tickets", "support_tickets", "sales_proposals"}

BUILDERS = {
    "suppliers": suppliers, "inventory": inventory, "shipments": shipments, "customers": customers,
    "transactions": transactions, "telemetry": telemetry, "tickets": tickets,
    "support_tickets": support_tickets, "standard_operating_procedures": sops,
    "incident_reports": incidents, "sales_proposals": proposals,
}
