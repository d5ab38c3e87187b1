"""Queries for §2.7 KPI analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scoring as S
from ..operators import kpi as G
from ..operators import lookup as L
from .q_scoring import churn_customers, usage
from .queries import Ctx, query

LATE_COLUMNS = ("shipment_id", "part_id", "supplier_id", "status", "expected_delivery")
SALES_COLUMNS = ("region", "sales_rep_id", "transaction_date", "total_amount", "discount_amount", "tax_amount")


@query("inventory_by_warehouse")
def q_g01(spark, sf):
    return G.inventory_by_warehouse(Ctx(spark, sf).inventory)


@query("supplier_scorecard")
def q_g02(spark, sf):
    c = Ctx(spark, sf)
    return G.supplier_scorecard(c.only("shipments", "supplier_id", "status", "expected_delivery", "actual_delivery", "cost"), c.suppliers)


@query("lane_performance")
def q_g03(spark, sf):
    return G.lane_performance(Ctx(spark, sf).only("shipments", "origin_location", "destination_location", "carrier", "quantity", "cost", "shipment_date", "expected_delivery", "actual_delivery", "status"))


@query("late_shipments")
def q_g04(spark, sf):
    return G.late_shipments(Ctx(spark, sf).only("shipments", *LATE_COLUMNS))


@query("sales_kpis")
def q_g05(spark, sf):
    return G.sales_kpis(Ctx(spark, sf).only("transactions", *SALES_COLUMNS))


@query("kpi_trends")
def q_g06(spark, sf):
    return G.kpi_trends(Ctx(spark, sf).only("transactions", *SALES_COLUMNS))


def c360(c: Ctx):
    return G.customer_360(
        c.only("customers", "customer_id", "customer_name", "segment", "industry", "status", "total_orders", "total_spent", "last_purchase_date"),
        c.only("transactions", "customer_id", "total_amount", "transaction_date"),
        c.only("tickets", "customer_id", "status", "satisfaction_score"),
        c.only("sales_proposals", "customer_id", "status", "proposal_value"))


@query("customer_360")
def q_g07(spark, sf):
    return c360(Ctx(spark, sf))


@query("churn_heatmap")
def q_g08(spark, sf):
    return G.churn_heatmap(S.predict_churn(churn_customers(Ctx(spark, sf))))


@query("proposal_pipeline")
def q_g09(spark, sf):
    return G.proposal_pipeline(Ctx(spark, sf).only("sales_proposals", "created_by", "status", "proposal_value", "win_probability"))


@query("ticket_sla")
def q_g10(spark, sf):
    return G.ticket_sla(Ctx(spark, sf).only("tickets", "priority", "resolved_date", "resolution_time_hours", "satisfaction_score", "status"))


@query("incident_mttr")
def q_g11(spark, sf):
    return G.incident_mttr(Ctx(spark, sf).incident_reports)


@query("tag_facets")
def q_g12(spark, sf):
    c = Ctx(spark, sf)
    return G.tag_facets(c.only("tickets", "tags"), c.standard_operating_procedures)


@query("alerts_panel")
def q_g13(spark, sf):
    c = Ctx(spark, sf)
    return G.alerts_panel(S.predict_shortage(c.inventory, usage(c)), G.late_shipments(c.only("shipments", *LATE_COLUMNS)),
                          L.equipment_status(c.telemetry))


@query("device_anomalies")
def q_g14(spark, sf):
    return G.device_anomalies(Ctx(spark, sf).telemetry)


@query("reallocate_stock")
def q_g15(spark, sf):
    return G.reallocate_stock(Ctx(spark, sf).inventory)


@query("expedite_orders")
def q_g16(spark, sf):
    c = Ctx(spark, sf)
    return G.expedite_orders(c.only("shipments", *LATE_COLUMNS), c.inventory)


def device_tickets(c: Ctx):
    """Tickets with the device they are about: a rule over the ticket number (150 devices)."""
    number = F.substring("ticket_id", 4, 20).cast("bigint")
    return c.only("tickets", "ticket_id", "status").select(F.format_string("DEV%04d", F.pmod(number, F.lit(150)) + 1).alias("device_id"), "status")


@query("maintenance_tickets")
def q_g17(spark, sf):
    c = Ctx(spark, sf)
    return G.maintenance_tickets(c.telemetry, device_tickets(c))


@query("next_best_action")
def q_g18(spark, sf):
    c = Ctx(spark, sf)
    return G.next_best_action(c360(c), S.predict_churn(churn_customers(c)))


@query("upsell_score")
def q_g19(spark, sf):
    return G.upsell_score(Ctx(spark, sf).only("transactions", "customer_id", "transaction_date", "total_amount"))


@query("asof_stock_at_order")
def q_g20(spark, sf):
    c = Ctx(spark, sf)
    return G.asof_stock_at_order(c.only("transactions", "transaction_id", "product_id", "transaction_date"), c.only("shipments", "shipment_id", "part_id", "shipment_date"))
