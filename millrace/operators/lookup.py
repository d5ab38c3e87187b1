"""Order validation, lookups, shipment tracking, equipment and churn activity."""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from .textmatch import contains_join


def on_time_rate(shipments: DataFrame) -> DataFrame:
    """Delivered-on-time share per supplier (delivered rows only); partial aggregation."""
    dl = shipments.where(F.col("status") == "DELIVERED")
    return dl.groupBy("supplier_id").agg(
        (F.count_if(F.col("actual_delivery") <= F.col("expected_delivery")) / F.count(F.lit(1))).alias("on_time_rate"))


def create_purchase_orders(requests: DataFrame, suppliers: DataFrame, parts: DataFrame,
                           reliability: DataFrame | None = None, as_of: _dt.date = C.AS_OF_SHIPPING) -> DataFrame:
    """Validate each order request and price the valid ones.

    ``requests``: request_id, supplier_id, part_id, quantity, priority.
    ``parts``: part_id, part_name, unit_cost, min_qty (one row per part).
    The first failing check (in the reference's order) decides the error.
    """
    sup = suppliers.select("supplier_id", "supplier_name", "lead_time_days", F.lit(True).alias("_sup"))
    if reliability is not None:
        sup = sup.join(reliability, "supplier_id", "left")
    else:
        sup = sup.withColumn("on_time_rate", F.lit(None).cast("double"))
    prt = parts.select("part_id", "part_name", "unit_cost", "min_qty", F.lit(True).alias("_part"))
    j = requests.join(sup, "supplier_id", "left").join(prt, "part_id", "left")
    q = F.col("quantity")
    prio = F.when(F.col("priority").isin(*C.ORDER_PRIORITIES), F.col("priority")).otherwise("NORMAL")
    error = (F.when(q <= 0, F.lit("Quantity must be greater than zero"))
              .when(F.col("_sup").isNull(), F.concat(F.lit("Invalid supplier ID: "), F.col("supplier_id")))
              .when(F.col("_part").isNull(), F.concat(F.lit("Invalid part ID: "), F.col("part_id")))
              .when(q < F.col("min_qty"), F.concat(F.lit("Quantity "), q.cast("string"),
                                                   F.lit(" below minimum order quantity "), F.col("min_qty").cast("string"))))
    ok = error.isNull()
    pct = F.coalesce(*[F.when(prio == p, F.lit(Decimal(str(v)))) for p, v in C.RUSH_FEE.items()]).cast("decimal(4,2)")
    adj = F.coalesce(*[F.when(prio == p, F.lit(v)) for p, v in C.LEAD_ADJUST.items()])
    subtotal = (F.col("unit_cost").cast("decimal(18,2)") * q).cast("decimal(18,2)")
    rush = (subtotal * pct).cast("decimal(18,2)")
    days = F.greatest(F.lit(1), F.col("lead_time_days") + adj)
    return j.select(
        "request_id",
        F.when(ok, F.concat(F.lit("PO-"), F.upper(F.sha2(F.col("request_id"), 256)))).alias("order_id"),
        F.when(ok, "PENDING").otherwise("FAILED").alias("status"),
        error.alias("error"),
        "supplier_id", "part_id", q.alias("quantity"), prio.alias("priority"),
        F.when(ok, F.col("supplier_name")).alias("supplier_name"),
        F.when(ok, F.col("on_time_rate")).alias("reliability_score"),
        F.when(ok, F.col("part_name")).alias("part_name"),
        F.when(ok, F.col("unit_cost")).alias("unit_cost"),
        F.when(ok, subtotal.cast("double")).alias("subtotal"),
        F.when(ok, rush.cast("double")).alias("rush_fee"),
        F.when(ok, (pct * 100).cast("double")).alias("rush_fee_percent"),
        F.when(ok, (subtotal + rush).cast("double")).alias("total_cost"),
        F.when(ok, days).alias("estimated_days"),
        F.when(ok, F.date_add(F.lit(as_of), days)).alias("estimated_delivery_date"),
    )


def _money_str(c: Column) -> Column:
    return c.cast("decimal(18,2)").cast("string")


def lookup_customer(queries: DataFrame, customers: DataFrame, q_col: str = "name_query") -> DataFrame:
    """Per name query, the matching customer with the most recent purchase (ties: id).

    Queries without a match keep a row with NULL result (the reference returns NULL).
    Top-1 is a ``min(struct)`` aggregate, so a query matching a third of all
    customers still aggregates map-side instead of landing in one task.
    """
    cu = customers.select("customer_id", "customer_name", "email", "total_orders", "total_spent",
                          "last_purchase_date", "status")
    order_key = F.coalesce(-F.datediff(F.col("last_purchase_date"), F.lit(_dt.date(1970, 1, 1))), F.lit(1 << 30))
    m = contains_join(queries.select(q_col).distinct(), q_col, cu.withColumn("k", order_key), "customer_name", first_by=["k", "customer_id"])
    best = m.groupBy(q_col).agg(F.min(F.struct("k", "customer_id", "customer_name", "email",
                                               "total_orders", "total_spent", "last_purchase_date", "status")).alias("b"))
    line = F.concat(F.lit("Customer ID: "), F.col("b.customer_id"), F.lit(", Email: "), F.col("b.email"),
                    F.lit(", Total Orders: "), F.col("b.total_orders").cast("string"),
                    F.lit(", Total Spent: $"), _money_str(F.col("b.total_spent")),
                    F.lit(", Last Purchase: "), F.col("b.last_purchase_date").cast("string"),
                    F.lit(", Status: "), F.col("b.status"))
    res = best.select(q_col, F.col("b.customer_id").alias("customer_id"),
                      F.col("b.customer_name").alias("customer_name"), line.alias("summary"))
    return queries.select(q_col).distinct().join(res, q_col, "left")


def stock_status(qty: Column, level: Column) -> Column:
    return (F.when(qty <= level, "REORDER REQUIRED").when(qty <= level * 1.5, "LOW STOCK").otherwise("ADEQUATE"))


def inventory_status(queries: DataFrame, inventory: DataFrame, q_col: str = "part_query") -> DataFrame:
    """Per part-name query, the lowest-stock matching inventory row (ties: inventory_id)."""
    inv = inventory.select("inventory_id", "part_id", "part_name", "warehouse_id", "warehouse_location",
                           "current_quantity", "reorder_level")
    m = contains_join(queries.select(q_col).distinct(), q_col, inv, "part_name", first_by=["current_quantity", "inventory_id"])
    best = m.groupBy(q_col).agg(F.min(F.struct("current_quantity", "inventory_id", "part_id", "part_name",
                                               "warehouse_id", "warehouse_location", "reorder_level")).alias("b"))
    st = stock_status(F.col("b.current_quantity"), F.col("b.reorder_level"))
    line = F.concat(F.lit("Part: "), F.col("b.part_name"), F.lit(" ("), F.col("b.part_id"), F.lit("), Stock: "),
                    F.col("b.current_quantity").cast("string"), F.lit(" units, Location: "),
                    F.col("b.warehouse_location"), F.lit(", Reorder Level: "), F.col("b.reorder_level").cast("string"),
                    F.lit(", Status: "), st)
    res = best.select(q_col, F.col("b.inventory_id").alias("inventory_id"), F.col("b.part_id").alias("part_id"),
                      F.col("b.warehouse_id").alias("warehouse_id"), st.alias("stock_status"), line.alias("summary"))
    return queries.select(q_col).distinct().join(res, q_col, "left")


def track_shipments(shipments: DataFrame, days_back=(7, 30, 90), as_of: _dt.date = C.AS_OF_SHIPPING) -> DataFrame:
    """One summary row per look-back, all look-backs in a single pass.

    The widest look-back is a plain filter on ``shipment_date`` (partition
    column) so it prunes partitions; each row is then fanned out to the
    look-backs it falls in (at most ``len(days_back)``) and counted once.
    An empty period gives 0 counts and a NULL rate (not a NULL summary).
    """
    lbs = sorted(days_back)
    s = shipments.select("shipment_date", "status").where(
        F.col("shipment_date") >= F.date_sub(F.lit(as_of), max(lbs)))
    age = F.datediff(F.lit(as_of), F.col("shipment_date"))
    fan = s.select("status", F.explode(F.filter(F.array(*[F.lit(n) for n in lbs]), lambda n: age <= n)).alias("days_back"))
    agg = fan.groupBy("days_back").agg(
        F.count(F.lit(1)).alias("total_shipments"),
        F.count_if(F.col("status") == "DELIVERED").alias("delivered"),
        F.count_if(F.col("status") == "IN_TRANSIT").alias("in_transit"),
        F.count_if(F.col("status") == "DELAYED").alias("delayed"))
    spark = shipments.sparkSession
    periods = spark.createDataFrame([(n,) for n in lbs], "days_back int")
    r = periods.join(agg, "days_back", "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    return r.select("days_back", z("total_shipments").alias("total_shipments"), z("delivered").alias("delivered"),
                    F.round(F.try_divide(F.col("delivered") * 100.0, F.col("total_shipments")), 1).alias("delivered_pct"),
                    z("in_transit").alias("in_transit"), z("delayed").alias("delayed"))


def reorder_list(inventory: DataFrame) -> DataFrame:
    """Every inventory row that is not ADEQUATE, with the order to place and its cost."""
    st = stock_status(F.col("current_quantity"), F.col("reorder_level"))
    return inventory.select("inventory_id", "part_id", "warehouse_id", "supplier_id", "current_quantity",
                            "reorder_level", st.alias("stock_status"),
                            F.col("reorder_quantity").alias("order_quantity"),
                            (F.col("unit_cost").cast("decimal(18,2)") * F.col("reorder_quantity"))
                            .cast("decimal(18,2)").cast("double").alias("order_cost")) \
        .where(F.col("stock_status") != "ADEQUATE")


def equipment_status(telemetry: DataFrame) -> DataFrame:
    """Per device the latest status, last fault and open maintenance codes.

    Every output is an associative aggregate (max of struct, count, bounded
    set of codes), so the per-device group never has to sit in one task.
    """
    t = telemetry
    err = F.col("operational_status") == "ERROR"
    return t.groupBy("device_id").agg(
        F.max(F.struct("timestamp", "reading_id", "operational_status")).alias("latest"),
        F.max(F.when(err, F.struct("timestamp", "reading_id", "error_code"))).alias("fault"),
        F.count(F.lit(1)).alias("readings"),
        F.count_if(err).alias("error_count"),
        F.array_sort(F.collect_set(F.when(F.col("maintenance_required"), F.col("error_code")))).alias("open_error_codes"),
    ).select("device_id", F.col("latest.timestamp").alias("last_reading_ts"),
             F.col("latest.operational_status").alias("latest_status"),
             F.col("fault.error_code").alias("last_error_code"), F.col("fault.timestamp").alias("last_error_ts"),
             "readings", "error_count", "open_error_codes")


def churn_activity(transactions: DataFrame, tickets: DataFrame, days_back: int = 90,
                   as_of: _dt.date = C.AS_OF_SALES) -> DataFrame:
    """Orders in the last ``days_back`` days vs the window before, plus recent tickets."""
    hi = F.lit(as_of).cast("timestamp")
    mid = F.lit(as_of - _dt.timedelta(days=days_back)).cast("timestamp")
    lo = F.lit(as_of - _dt.timedelta(days=2 * days_back)).cast("timestamp")
    td = F.col("transaction_date")
    tx = (transactions.where((td >= lo) & (td < hi))
          .select("customer_id", "order_id", (td >= mid).alias("recent")).distinct()
          .groupBy("customer_id").agg(F.count_if("recent").alias("orders_recent"),
                                      F.count_if(~F.col("recent")).alias("orders_prior")))
    cd = F.col("created_date")
    tk = (tickets.where((cd >= mid) & (cd < hi)).groupBy("customer_id")
          .agg(F.count(F.lit(1)).alias("tickets_recent")))
    j = tx.join(tk, "customer_id", "full")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    return j.select("customer_id", z("orders_recent").alias("orders_recent"), z("orders_prior").alias("orders_prior"),
                    F.try_divide((z("orders_prior") - z("orders_recent")) * 100.0, z("orders_prior")).alias("order_drop_pct"),
                    z("tickets_recent").alias("tickets_recent"))


def safe_apply(events: DataFrame) -> DataFrame:
    """C11: a per-row computation that reports failures as data instead of failing the job.

    value per unit of the JSON field ``k``: malformed JSON or a missing field and
    a zero divisor become an ``error`` value; the good rows carry ``result``.
    """
    k = F.get_json_object("props", "$.k").try_cast("int")
    res = F.try_divide(F.col("value"), k)
    err = F.when(k.isNull(), "missing_or_bad_field").when(k == 0, "division_by_zero")
    return events.select("event_id", k.alias("k"), F.when(err.isNull(), res).alias("result"), err.alias("error"))
