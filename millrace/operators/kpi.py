"""KPI tables behind the dashboards and natural-language spaces.

Conventions: money is summed as DECIMAL(18,2) and returned as DOUBLE; every
top-1 / latest-per-key is an associative aggregate (``max``/``min`` of a
struct) instead of a window, so a key holding a third of all rows still
aggregates map-side. Windows are used only over pre-aggregated series whose
partition size is bounded (months per region, days per part, warehouses per part).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import config as C
from .lookup import stock_status

OPEN_SHIPMENT = ["PENDING", "IN_TRANSIT", "DELAYED"]
OPEN_TICKET = ["OPEN", "IN_PROGRESS", "ESCALATED"]
OPEN_PROPOSAL = ["SENT", "UNDER_REVIEW"]


def dsum(c):
    """Exact money sum (DECIMAL) returned as double."""
    return F.sum(F.col(c).cast("decimal(18,2)") if isinstance(c, str) else c.cast("decimal(18,2)")).cast("double")


def inventory_by_warehouse(inventory: DataFrame) -> DataFrame:
    """G01."""
    return inventory.groupBy("warehouse_id", "category").agg(
        F.count(F.lit(1)).alias("parts"),
        F.sum("current_quantity").alias("total_units"),
        dsum(F.col("unit_cost").cast("decimal(18,2)") * F.col("current_quantity")).alias("stock_value"),
        F.count_if(F.col("current_quantity") <= F.col("reorder_level")).alias("parts_below_reorder"))


def supplier_scorecard(shipments: DataFrame, suppliers: DataFrame) -> DataFrame:
    """Per supplier on-time rate, mean delay, cost; every supplier appears."""
    dl = F.col("status") == "DELIVERED"
    delay = F.when(dl, F.datediff("actual_delivery", "expected_delivery"))
    s = shipments.groupBy("supplier_id").agg(
        F.count(F.lit(1)).alias("shipments"),
        F.count_if(dl).alias("delivered"),
        F.count_if(dl & (F.col("actual_delivery") <= F.col("expected_delivery"))).alias("on_time"),
        F.avg(delay).alias("avg_delay_days"),
        dsum("cost").alias("total_cost"))
    j = suppliers.select("supplier_id", "supplier_name", "rating", "lead_time_days").join(s, "supplier_id", "left")
    return j.select("supplier_id", "supplier_name", "rating", "lead_time_days",
                    F.coalesce("shipments", F.lit(0)).alias("shipments"),
                    F.coalesce("delivered", F.lit(0)).alias("delivered"),
                    F.try_divide(F.col("on_time"), F.col("delivered")).alias("on_time_rate"),
                    "avg_delay_days", F.coalesce("total_cost", F.lit(0.0)).alias("total_cost"))


def lane_performance(shipments: DataFrame) -> DataFrame:
    """G03."""
    transit = F.datediff(F.coalesce("actual_delivery", "expected_delivery"), "shipment_date")
    return shipments.groupBy("origin_location", "destination_location", "carrier").agg(
        F.count(F.lit(1)).alias("shipments"), F.sum("quantity").alias("total_quantity"),
        dsum("cost").alias("total_cost"), F.avg(transit).alias("avg_transit_days"),
        F.count_if(F.col("status") == "DELAYED").alias("delayed"))


def late_shipments(shipments: DataFrame, as_of: _dt.date = C.AS_OF_SHIPPING) -> DataFrame:
    """Open shipments past their expected date at ``as_of``."""
    return shipments.where(F.col("status").isin(*OPEN_SHIPMENT) & (F.col("expected_delivery") < F.lit(as_of))) \
        .select("shipment_id", "part_id", "supplier_id", "status", "expected_delivery",
                F.datediff(F.lit(as_of), "expected_delivery").alias("days_late"))


def sales_kpis(transactions: DataFrame) -> DataFrame:
    """Revenue, discount, tax and line count by region / rep / month with subtotals."""
    t = transactions.withColumn("month", F.date_format("transaction_date", "yyyy-MM"))
    net = F.col("total_amount").cast("decimal(18,2)") - F.col("discount_amount").cast("decimal(18,2)")
    return t.rollup("region", "sales_rep_id", "month").agg(
        F.count(F.lit(1)).alias("lines"), dsum(net).alias("revenue"),
        dsum("discount_amount").alias("discount"), dsum("tax_amount").alias("tax"),
        F.grouping_id().alias("grouping_level"))


def monthly_revenue(transactions: DataFrame) -> DataFrame:
    net = F.col("total_amount").cast("decimal(18,2)") - F.col("discount_amount").cast("decimal(18,2)")
    return transactions.groupBy("region", F.date_format("transaction_date", "yyyy-MM").alias("month")) \
        .agg(F.sum(net).alias("revenue_dec"))


def kpi_trends(transactions: DataFrame) -> DataFrame:
    """Change against the month before and 3-month moving average per region, by calendar month: a
    month without sales is a gap (no change is given after it, and it is not averaged in).

    The window runs over the monthly aggregate (one row per region and month),
    so its partitions are bounded by the calendar, not by the data volume.
    """
    m = monthly_revenue(transactions).withColumn("_i", F.substring("month", 1, 4).cast("int") * 12 + F.substring("month", 6, 2).cast("int"))
    w = Window.partitionBy("region").orderBy("_i")
    prev = F.max("revenue_dec").over(w.rangeBetween(-1, -1)).cast("double")
    mov = w.rangeBetween(-2, 0)
    rev = F.col("revenue_dec").cast("double")
    return m.select("region", "month", rev.alias("revenue"),
                    F.try_divide((rev - prev) * 100.0, prev).alias("mom_change_pct"),
                    (F.sum("revenue_dec").over(mov).cast("double") / F.count(F.lit(1)).over(mov)).alias("moving_avg_3m"))


def customer_360(customers: DataFrame, transactions: DataFrame, tickets: DataFrame, proposals: DataFrame) -> DataFrame:
    """Profile plus per-customer aggregates of three facts (each aggregated before its join)."""
    tx = transactions.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("txn_lines"), dsum("total_amount").alias("txn_revenue"),
        F.max("transaction_date").alias("last_transaction"))
    tk = tickets.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("tickets"), F.count_if(F.col("status").isin(*OPEN_TICKET)).alias("open_tickets"),
        F.avg("satisfaction_score").alias("avg_satisfaction"))
    pr = proposals.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("proposals"),
        dsum(F.when(F.col("status").isin(*OPEN_PROPOSAL), F.col("proposal_value"))).alias("open_proposal_value"))
    c = customers.select("customer_id", "customer_name", "segment", "industry", "status", "total_orders",
                         "total_spent", "last_purchase_date")
    j = c.join(tx, "customer_id", "left").join(tk, "customer_id", "left").join(pr, "customer_id", "left")
    z = lambda n: F.coalesce(F.col(n), F.lit(0)).alias(n)
    return j.select("customer_id", "customer_name", "segment", "industry", "status", "total_orders", "total_spent",
                    "last_purchase_date", z("txn_lines"), F.coalesce("txn_revenue", F.lit(0.0)).alias("txn_revenue"),
                    "last_transaction", z("tickets"), z("open_tickets"), "avg_satisfaction", z("proposals"),
                    F.coalesce("open_proposal_value", F.lit(0.0)).alias("open_proposal_value"))


def churn_heatmap(churn: DataFrame) -> DataFrame:
    """Mean churn probability by segment and industry, one row a cell, for every industry in the data."""
    milli = (F.col("churn_probability") * 1000).cast("decimal(10,0)").cast("bigint")
    return churn.groupBy("segment", "industry").agg((F.sum(milli) / F.count(F.lit(1)) / 1000.0).alias("mean_churn_probability"))


VALUE_BUCKET = 1000.0


def percent_ranks(df: DataFrame, value: str) -> DataFrame:
    """(value, percent rank) of the distinct values: (rank - 1) / (rows - 1), 0 for a single row.

    Values are counted first; the running count is taken within buckets of the value and over the
    bucket totals, so no window holds more than a bucket's distinct values or the buckets.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("_b", F.floor(F.col(value) / VALUE_BUCKET))
    totals = counts.groupBy("_b").agg(F.sum("n").alias("t"))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_b", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("o"))
    inside = Window.partitionBy("_b").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    rows = totals.select(F.sum("t")).scalar()
    lower = F.col("o") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    return counts.join(offsets, "_b").select(value, F.when(rows > 1, lower / (rows - 1)).otherwise(0.0).alias("value_rank"))


def proposal_pipeline(proposals: DataFrame) -> DataFrame:
    """Win rate and weighted pipeline per rep; lead score = win probability x percent rank of the value."""
    proposals = proposals.select("created_by", "status", "proposal_value", "win_probability").join(
        percent_ranks(proposals, "proposal_value"), "proposal_value", "left")
    open_ = F.col("status").isin(*OPEN_PROPOSAL)
    lead = F.round(F.col("win_probability") * F.col("value_rank"), 9)
    weighted = F.col("proposal_value").cast("decimal(18,2)") * F.col("win_probability").cast("decimal(4,2)")
    return proposals.groupBy("created_by").agg(
        F.count(F.lit(1)).alias("proposals"),
        F.count_if(F.col("status") == "WON").alias("won"),
        F.count_if(F.col("status") == "LOST").alias("lost"),
        F.try_divide(F.count_if(F.col("status") == "WON"),
                     F.count_if(F.col("status").isin("WON", "LOST"))).alias("win_rate"),
        dsum(F.when(open_, F.col("proposal_value"))).alias("open_pipeline_value"),
        F.sum(F.when(open_, weighted)).cast("double").alias("weighted_pipeline"),
        F.max(F.when(open_, lead)).alias("best_lead_score"))


def ticket_sla(tickets: DataFrame) -> DataFrame:
    """Resolution time (mean, exact p95), satisfaction and backlog per priority."""
    return tickets.groupBy("priority").agg(
        F.count(F.lit(1)).alias("tickets"),
        F.count(F.col("resolved_date")).alias("resolved"),
        F.avg("resolution_time_hours").alias("mean_resolution_hours"),
        F.percentile("resolution_time_hours", 0.95).alias("p95_resolution_hours"),
        F.avg("satisfaction_score").alias("avg_satisfaction"),
        F.count_if(F.col("status").isin(*OPEN_TICKET)).alias("backlog"))


def incident_mttr(incidents: DataFrame) -> DataFrame:
    """Mean time to resolve by affected system and severity."""
    tenths = F.round(F.col("resolution_time_hours") * 10).cast("bigint")
    e = incidents.select(F.explode("affected_systems").alias("system"), "severity", tenths.alias("t"))
    return e.groupBy("system", "severity").agg(
        F.count(F.lit(1)).alias("incidents"), (F.sum("t") / F.count(F.lit(1)) / 10.0).alias("mttr_hours"))


def tag_facets(tickets: DataFrame, sops: DataFrame) -> DataFrame:
    """Tag counts over tickets and SOPs."""
    a = tickets.select(F.lit("ticket").alias("source"), F.explode("tags").alias("tag"))
    b = sops.select(F.lit("sop").alias("source"), F.explode("tags").alias("tag"))
    return a.unionByName(b).groupBy("source", "tag").agg(F.count(F.lit(1)).alias("n"))


SEVERITY_PRIORITY = {"CRITICAL": 1, "HIGH": 2, "MEDIUM": 3}


def alerts_panel(shortage: DataFrame, late: DataFrame, devices: DataFrame) -> DataFrame:
    """Shortages, late shipments and faulted devices in one ranked feed.

    The dense rank is taken over the distinct priorities present (at most three
    rows), then joined back: no global window over the feed itself.
    """
    a = shortage.where(F.col("risk_level").isin("CRITICAL", "HIGH")).select(
        F.lit("SHORTAGE").alias("alert_type"), F.col("inventory_id").alias("entity_id"),
        F.col("risk_level").alias("severity"), F.col("recommendation").alias("detail"))
    b = late.select(F.lit("LATE_SHIPMENT").alias("alert_type"), F.col("shipment_id").alias("entity_id"),
                    F.when(F.col("days_late") > 30, "HIGH").otherwise("MEDIUM").alias("severity"),
                    F.concat(F.lit("Late by "), F.col("days_late").cast("string"), F.lit(" days")).alias("detail"))
    c = devices.where(F.col("latest_status") == "ERROR").select(
        F.lit("DEVICE_ERROR").alias("alert_type"), F.col("device_id").alias("entity_id"),
        F.lit("CRITICAL").alias("severity"),
        F.concat(F.lit("Last fault "), F.coalesce(F.col("last_error_code"), F.lit("unknown"))).alias("detail"))
    feed = a.unionByName(b).unionByName(c)
    prio = F.coalesce(*[F.when(F.col("severity") == k, F.lit(v)) for k, v in SEVERITY_PRIORITY.items()], F.lit(9))
    feed = feed.withColumn("priority", prio)
    ranks = feed.select("priority").distinct().withColumn(
        "alert_rank", F.dense_rank().over(Window.orderBy("priority")))
    return feed.join(F.broadcast(ranks), "priority")


def device_anomalies(telemetry: DataFrame, z: float = 3.0) -> DataFrame:
    """Error rate and z-score outliers of power per device.

    Per-device mean / stddev come from a partial aggregate and are joined back
    (AQE splits a hot device), rather than a window that would sort a hot
    device's readings inside one task.
    """
    st = telemetry.groupBy("device_id").agg(
        F.count(F.lit(1)).alias("readings"), F.count_if(F.col("operational_status") == "ERROR").alias("errors"),
        F.avg("power_consumption").alias("mean_power"), F.stddev_samp("power_consumption").alias("std_power"))
    j = telemetry.select("device_id", "power_consumption").join(st.select("device_id", "mean_power", "std_power"),
                                                                "device_id")
    out = j.where(F.abs(F.col("power_consumption") - F.col("mean_power")) > F.lit(z) * F.col("std_power")) \
        .groupBy("device_id").agg(F.count(F.lit(1)).alias("outliers"))
    r = st.join(out, "device_id", "left")
    return r.select("device_id", "readings", "errors", (F.col("errors") / F.col("readings")).alias("error_rate"),
                    F.round("mean_power", 4).alias("mean_power"), F.round("std_power", 4).alias("std_power"),
                    F.coalesce("outliers", F.lit(0)).alias("outliers"))


def reallocate_stock(inventory: DataFrame, keep_factor: int = 2) -> DataFrame:
    """Greedy transfers from surplus to short warehouses of the same part.

    Deficit = reorder_level - current_quantity (> 0); surplus = current_quantity
    - keep_factor * reorder_level (> 0). Within a part, deficits (largest first)
    and surpluses (largest first) are laid out as cumulative ranges; a transfer
    is the overlap of a deficit range with a surplus range. Only overlapping
    pairs survive the range condition; the per-part sides are bounded by the
    number of warehouses.
    """
    inv = inventory.select("part_id", "warehouse_id", "current_quantity", "reorder_level")
    need = inv.select("part_id", F.col("warehouse_id").alias("to_warehouse"),
                      (F.col("reorder_level") - F.col("current_quantity")).alias("amt")).where(F.col("amt") > 0)
    have = inv.select("part_id", F.col("warehouse_id").alias("from_warehouse"),
                      (F.col("current_quantity") - F.lit(keep_factor) * F.col("reorder_level")).alias("amt")) \
        .where(F.col("amt") > 0)
    need = need.join(have.select("part_id").distinct(), "part_id", "left_semi")

    def ranges(df, key):
        w = Window.partitionBy("part_id").orderBy(F.col("amt").desc(), F.col(key))
        end = F.sum("amt").over(w.rowsBetween(Window.unboundedPreceding, 0))
        return df.select("part_id", key, (end - F.col("amt")).alias("lo"), end.alias("hi"))

    n = ranges(need, "to_warehouse").alias("n")
    h = ranges(have, "from_warehouse").alias("h")
    j = n.join(h, (F.col("n.part_id") == F.col("h.part_id")) & (F.col("n.lo") < F.col("h.hi"))
               & (F.col("h.lo") < F.col("n.hi")))
    qty = F.least("n.hi", "h.hi") - F.greatest("n.lo", "h.lo")
    return j.select(F.col("n.part_id").alias("part_id"), "from_warehouse", "to_warehouse",
                    qty.cast("int").alias("transfer_qty"))


def expedite_orders(shipments: DataFrame, inventory: DataFrame, as_of: _dt.date = C.AS_OF_SHIPPING) -> DataFrame:
    """Delayed inbound shipments of parts that are below their reorder level somewhere."""
    short = inventory.where(stock_status(F.col("current_quantity"), F.col("reorder_level")) == "REORDER REQUIRED") \
        .select("part_id")
    return late_shipments(shipments, as_of).where(F.col("status") == "DELAYED") \
        .join(short, "part_id", "left_semi")


def maintenance_tickets(telemetry: DataFrame, existing: DataFrame) -> DataFrame:
    """One new maintenance ticket per device with a fault flag, unless one is open for that device.

    ``existing``: device_id, status. A device with an open ticket gets no second one; a closed
    ticket does not hold a new fault back.
    """
    f = telemetry.where(F.col("maintenance_required")).groupBy("device_id").agg(
        F.max(F.struct("timestamp", "reading_id", "error_code", "location_id")).alias("r"))
    t = f.select(F.concat(F.lit("MT-"), F.col("device_id")).alias("ticket_id"), "device_id",
                 F.col("r.reading_id").alias("reading_id"), F.col("r.error_code").alias("error_code"),
                 F.col("r.timestamp").alias("fault_ts"), F.col("r.location_id").alias("location_id"),
                 F.lit("HIGH").alias("priority"))
    return t.join(existing.where(F.col("status").isin(*OPEN_TICKET)).select("device_id"), "device_id", "left_anti") \
        .select(*t.columns)


def next_best_action(c360: DataFrame, churn: DataFrame) -> DataFrame:
    """A rule ladder over churn band, open tickets and open proposals."""
    j = c360.select("customer_id", "open_tickets", "open_proposal_value").join(
        churn.select("customer_id", "risk_level", "churn_probability"), "customer_id")
    act = (F.when((F.col("risk_level") == "HIGH") & (F.col("open_tickets") > 0), "Escalate support and call")
            .when(F.col("risk_level") == "HIGH", "Send re-engagement offer")
            .when(F.col("open_proposal_value") > 0, "Follow up on open proposal")
            .when(F.col("risk_level") == "MEDIUM", "Send targeted recommendations")
            .otherwise("Offer upsell"))
    return j.select("customer_id", "risk_level", "churn_probability", "open_tickets", "open_proposal_value",
                    act.alias("next_best_action"))


def upsell_score(transactions: DataFrame, as_of: _dt.date = C.AS_OF_SALES, half: int = 182) -> DataFrame:
    """Spend in the last half-year vs the half-year before (growth ratio)."""
    hi = F.lit(as_of).cast("timestamp")
    mid = F.lit(as_of - _dt.timedelta(days=half)).cast("timestamp")
    lo = F.lit(as_of - _dt.timedelta(days=2 * half)).cast("timestamp")
    td = F.col("transaction_date")
    amt = F.col("total_amount").cast("decimal(18,2)")
    g = transactions.where((td >= lo) & (td < hi)).groupBy("customer_id").agg(
        F.sum(F.when(td >= mid, amt)).cast("double").alias("recent_spend"),
        F.sum(F.when(td < mid, amt)).cast("double").alias("prior_spend"))
    r, p = F.coalesce("recent_spend", F.lit(0.0)), F.coalesce("prior_spend", F.lit(0.0))
    return g.select("customer_id", r.alias("recent_spend"), p.alias("prior_spend"),
                    F.try_divide(r - p, p).alias("growth"))


def asof_stock_at_order(transactions: DataFrame, shipments: DataFrame) -> DataFrame:
    """For each sale, the latest inbound shipment of the product on or before the sale day.

    As-of join in two bounded steps: shipments are first reduced to one row per
    (part, day); the running ``last(ignorenulls)`` window then runs over
    (part, day) keys only, so its partitions are bounded by the calendar even
    when one part carries a third of all rows. Sales join back on (part, day).
    """
    sd = shipments.groupBy("part_id", F.col("shipment_date").alias("day")).agg(
        F.max(F.struct("shipment_id", "shipment_date")).alias("s"))
    tx = transactions.select("transaction_id", F.col("product_id").alias("part_id"), "transaction_date",
                             F.to_date("transaction_date").alias("day"))
    keys = tx.select("part_id", "day").distinct().withColumn("is_sale", F.lit(1))
    u = sd.withColumn("is_sale", F.lit(0)).unionByName(keys, allowMissingColumns=True)
    w = Window.partitionBy("part_id").orderBy("day", "is_sale").rowsBetween(Window.unboundedPreceding, 0)
    asof = u.select("part_id", "day", "is_sale", F.last("s", ignorenulls=True).over(w).alias("last_s")) \
        .where(F.col("is_sale") == 1).drop("is_sale")
    j = tx.join(asof, ["part_id", "day"], "left")
    return j.select("transaction_id", F.col("part_id").alias("product_id"), "transaction_date",
                    F.col("last_s.shipment_id").alias("last_shipment_id"),
                    F.col("last_s.shipment_date").alias("last_shipment_date"),
                    F.datediff("day", F.col("last_s.shipment_date")).alias("days_since_shipment"))
