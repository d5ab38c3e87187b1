"""Schema registry for the 11 domain tables: one definition drives DDL, reads and checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

S, I, D, B = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
DT, TS = T.DateType(), T.TimestampType()
AS = T.ArrayType(T.StringType())


@dataclass(frozen=True)
class TableSpec:
    domain: str
    name: str
    columns: list  # (name, type, nullable, comment)
    key: str
    partition: str | None = None
    cluster: list = field(default_factory=list)
    comment: str = ""

    @property
    def qualified(self) -> str:
        return f"{self.domain}.{self.name}"

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(c[0], c[1], c[2], {"comment": c[3]} if c[3] else {})
                             for c in self.columns])

    @property
    def required(self) -> list:
        return [c[0] for c in self.columns if not c[2]]


def _c(name, typ, nullable=False, comment=""):
    return (name, typ, nullable, comment)


TABLES = {
    "inventory": TableSpec("supply_chain", "inventory", [
        _c("inventory_id", S, comment="Unique inventory record"), _c("part_id", S), _c("part_name", S),
        _c("warehouse_id", S), _c("warehouse_location", S), _c("current_quantity", I),
        _c("reorder_level", I), _c("reorder_quantity", I), _c("unit_cost", D),
        _c("last_updated", TS), _c("category", S), _c("supplier_id", S)],
        key="inventory_id", cluster=["part_id", "warehouse_id"]),
    "shipments": TableSpec("supply_chain", "shipments", [
        _c("shipment_id", S), _c("order_id", S), _c("part_id", S), _c("part_name", S),
        _c("quantity", I), _c("supplier_id", S), _c("supplier_name", S), _c("origin_location", S),
        _c("destination_location", S), _c("shipment_date", DT), _c("expected_delivery", DT),
        _c("actual_delivery", DT, True, "only when DELIVERED"),
        _c("status", S, comment="PENDING, IN_TRANSIT, DELIVERED, DELAYED, CANCELLED"),
        _c("carrier", S), _c("tracking_number", S), _c("cost", D)],
        key="shipment_id", partition="shipment_date", cluster=["supplier_id", "part_id"]),
    "suppliers": TableSpec("supply_chain", "suppliers", [
        _c("supplier_id", S), _c("supplier_name", S), _c("contact_name", S), _c("contact_email", S),
        _c("contact_phone", S), _c("address", S), _c("city", S), _c("country", S),
        _c("rating", D), _c("lead_time_days", I), _c("payment_terms", S),
        _c("status", S, comment="ACTIVE, INACTIVE"), _c("created_date", DT), _c("last_order_date", DT)],
        key="supplier_id"),
    "standard_operating_procedures": TableSpec("supply_chain", "standard_operating_procedures", [
        _c("id", S), _c("procedure_name", S), _c("procedure_text", S), _c("category", S),
        _c("department", S), _c("version", S), _c("effective_date", DT), _c("last_reviewed", DT),
        _c("next_review", DT), _c("created_by", S), _c("tags", AS)], key="id"),
    "incident_reports": TableSpec("supply_chain", "incident_reports", [
        _c("id", S), _c("incident_title", S), _c("incident_description", S), _c("incident_date", TS),
        _c("severity", S, comment="LOW, MEDIUM, HIGH, CRITICAL"), _c("category", S),
        _c("affected_systems", AS), _c("resolution", S), _c("resolution_time_hours", D),
        _c("root_cause", S), _c("preventive_measures", S), _c("reported_by", S), _c("resolved_by", S)],
        key="id", partition="incident_day"),
    "customers": TableSpec("sales", "customers", [
        _c("customer_id", S), _c("customer_name", S), _c("contact_name", S), _c("email", S),
        _c("phone", S), _c("industry", S), _c("segment", S, comment="Enterprise, SMB, Startup"),
        _c("address", S), _c("city", S), _c("country", S), _c("created_date", DT),
        _c("status", S, comment="ACTIVE, INACTIVE, CHURNED"), _c("total_orders", I),
        _c("total_spent", D), _c("last_purchase_date", DT, True), _c("credit_limit", D),
        _c("payment_terms", S)], key="customer_id", cluster=["segment", "industry"]),
    "transactions": TableSpec("sales", "transactions", [
        _c("transaction_id", S), _c("order_id", S), _c("customer_id", S), _c("customer_name", S),
        _c("transaction_date", TS), _c("product_id", S), _c("product_name", S), _c("quantity", I),
        _c("unit_price", D), _c("total_amount", D), _c("discount_amount", D), _c("tax_amount", D),
        _c("payment_method", S), _c("sales_rep_id", S), _c("sales_rep_name", S), _c("region", S),
        _c("status", S, comment="COMPLETED, PENDING")],
        key="transaction_id", partition="transaction_day", cluster=["customer_id", "product_id"]),
    "sales_proposals": TableSpec("sales", "sales_proposals", [
        _c("id", S), _c("proposal_id", S), _c("customer_id", S), _c("customer_name", S),
        _c("proposal_date", DT), _c("proposal_content", S), _c("executive_summary", S),
        _c("proposal_value", D), _c("products", AS),
        _c("status", S, comment="DRAFT, SENT, UNDER_REVIEW, WON, LOST"), _c("valid_until", DT),
        _c("created_by", S), _c("win_probability", D, True), _c("competitor_info", S, True),
        _c("notes", S, True)], key="proposal_id"),
    "telemetry": TableSpec("iot", "telemetry", [
        _c("reading_id", S), _c("device_id", S), _c("device_type", S), _c("location_id", S),
        _c("timestamp", TS), _c("temperature", D, True), _c("humidity", D, True),
        _c("pressure", D, True), _c("vibration", D, True), _c("power_consumption", D),
        _c("operational_status", S, comment="NORMAL, WARNING, ERROR"), _c("error_code", S, True),
        _c("maintenance_required", B), _c("reading_date", DT)],
        key="reading_id", partition="reading_date", cluster=["device_id"]),
    "tickets": TableSpec("support", "tickets", [
        _c("ticket_id", S), _c("customer_id", S), _c("customer_name", S), _c("created_date", TS),
        _c("category", S), _c("priority", S, comment="LOW, MEDIUM, HIGH, CRITICAL"),
        _c("subject", S), _c("description", S),
        _c("status", S, comment="OPEN, IN_PROGRESS, RESOLVED, CLOSED, ESCALATED"),
        _c("assigned_to", S), _c("resolved_date", TS, True), _c("resolution_time_hours", D, True),
        _c("satisfaction_score", I, True), _c("tags", AS)],
        key="ticket_id", partition="created_day", cluster=["customer_id"]),
    "support_tickets": TableSpec("support", "support_tickets", [
        _c("id", S), _c("ticket_id", S), _c("customer_id", S), _c("customer_name", S),
        _c("ticket_content", S), _c("problem_description", S), _c("resolution", S),
        _c("category", S), _c("product_affected", S), _c("created_date", TS),
        _c("resolved_date", TS, True), _c("priority", S), _c("tags", AS)], key="id"),
}

DOMAINS = {"supply_chain": "Inventory, shipments, suppliers, procedures and incidents",
           "sales": "Customers, transactions and proposals",
           "iot": "Device telemetry",
           "support": "Support tickets",
           "agent_logs": "Request and trace logs"}

# Enumerations the quality checks assert.
ENUMS = {
    ("shipments", "status"): ["PENDING", "IN_TRANSIT", "DELIVERED", "DELAYED", "CANCELLED"],
    ("suppliers", "status"): ["ACTIVE", "INACTIVE"],
    ("customers", "segment"): ["Enterprise", "SMB", "Startup"],
    ("customers", "status"): ["ACTIVE", "INACTIVE", "CHURNED"],
    ("transactions", "status"): ["COMPLETED", "PENDING"],
    ("telemetry", "operational_status"): ["NORMAL", "WARNING", "ERROR"],
    ("tickets", "priority"): ["LOW", "MEDIUM", "HIGH", "CRITICAL"],
    ("tickets", "status"): ["OPEN", "IN_PROGRESS", "RESOLVED", "CLOSED", "ESCALATED"],
    ("incident_reports", "severity"): ["LOW", "MEDIUM", "HIGH", "CRITICAL"],
    ("sales_proposals", "status"): ["DRAFT", "SENT", "UNDER_REVIEW", "WON", "LOST"],
}

# Id prefixes.
ID_FORMATS = [("suppliers", "supplier_id", "SUP"), ("inventory", "part_id", "PART"),
              ("inventory", "warehouse_id", "WH"), ("customers", "customer_id", "CUST"),
              ("transactions", "transaction_id", "TXN"), ("telemetry", "device_id", "DEV"),
              ("tickets", "ticket_id", "TKT"), ("sales_proposals", "proposal_id", "PROP")]
