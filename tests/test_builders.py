"""Builders and checks on seeded faults: dangling keys, empty dimensions, gaps, open tickets, whole texts."""

import datetime as dt
from types import SimpleNamespace

import pytest

from millrace.operators import kpi as G
from millrace.operators import quality as J
from millrace.plans import builders as B
from millrace.sources.schemas import TABLES

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def t(spark):
    from millrace.sources.tables import Tables
    return Tables(spark, SF_SMALL)


def test_wanted_columns_equal_the_full_table(t):
    for name in ("shipments", "customers", "transactions", "tickets", "sales_proposals"):
        full = B.BUILDERS[name](t)
        assert full.columns == TABLES[name].schema.names
        for c in full.columns[1:]:
            part = B.BUILDERS[name](t, want={full.columns[0], c})
            assert part.columns == [full.columns[0], c]
    some = {"transaction_id", "customer_id", "total_amount"}
    a = B.transactions(t, want=some)
    assert sorted(a.collect()) == sorted(B.transactions(t).select(*a.columns).collect())


def test_dangling_keys_stay_and_are_found(spark, t):
    """A line item of an unknown part, supplier and order, and an order of an unknown customer."""
    bad = t.lineitem.limit(1).selectExpr("*").toPandas()
    bad["l_orderkey"], bad["l_partkey"], bad["l_suppkey"] = 10 ** 9, 10 ** 8, 10 ** 7
    order = t.orders.limit(1).toPandas()
    order["o_orderkey"], order["o_custkey"] = 10 ** 9 + 1, 10 ** 6
    seeded = SimpleNamespace(lineitem=t.lineitem.union(spark.createDataFrame(bad, t.lineitem.schema)),
                             orders=t.orders.union(spark.createDataFrame(order, t.orders.schema)),
                             **{n: getattr(t, n) for n in ("part", "supplier", "customer", "nation", "region", "documents")})
    tables = {n: B.BUILDERS[n](seeded) for n in ("suppliers", "inventory", "shipments", "customers", "transactions", "tickets", "sales_proposals", "support_tickets")}
    found = {(r.table_name, r.rule): r.failed_rows for r in J.foreign_keys(tables).collect()}
    assert found["shipments", "fk:part_id->inventory.part_id"] == 1 and found["shipments", "fk:supplier_id->suppliers.supplier_id"] == 1
    assert found["transactions", "fk:product_id->inventory.part_id"] == 1 and found["tickets", "fk:customer_id->customers.customer_id"] == 1
    assert found["support_tickets", "fk:ticket_id->tickets.ticket_id"] == 0
    assert tables["transactions"].where("transaction_id like 'TXN1000000000-%' and customer_id is null").count() == 1


def test_no_supplier_and_no_customer(t):
    empty = SimpleNamespace(supplier=t.supplier.limit(0), part=t.part, customer=t.customer.limit(0), documents=t.documents)
    assert {r.supplier_id for r in B.inventory(empty).select("supplier_id").distinct().collect()} == {"DEFAULT_SUP"}
    assert B.proposals(empty).where("customer_id is null").count() == B.proposals(t).count()


def test_incidents_hold_every_line(t):
    texts = {r.id: (r.incident_description, r.resolution) for r in B.incidents(t).collect()}
    for d in t.documents.where("doc_id % 3 = 1").collect():
        desc, resolution = texts[f"INC-{d.doc_id}"]
        lines = d.text.split("\n")
        assert all(line in desc for line in lines) and all(line in resolution for line in lines[4:])


def test_telemetry_has_warnings_and_survives_bad_json(spark):
    e = spark.createDataFrame([(4, 1, "error", 1.0, '{"k": 3}', dt.datetime(2024, 1, 1)), (5, 1, "error", 1.0, '{"k": "x"}', dt.datetime(2024, 1, 1)),
                               (6, 1, "click", 1.0, "{", dt.datetime(2024, 1, 1))], "event_id long, user_id long, event_type string, value double, props string, ts timestamp")
    got = {r.reading_id: (r.operational_status, r.error_code) for r in B.telemetry(SimpleNamespace(events=e)).collect()}
    assert got == {"R4": ("WARNING", "E103"), "R5": ("ERROR", None), "R6": ("NORMAL", None)}


def test_trend_compares_with_the_month_before_only(spark):
    rows = [("EU", dt.datetime(2024, m, 3), a, 0.0) for m, a in ((1, 100.0), (2, 150.0), (4, 300.0))]
    got = {r.month: r for r in G.kpi_trends(spark.createDataFrame(rows, "region string, transaction_date timestamp, total_amount double, discount_amount double")).collect()}
    assert got["2024-02"].mom_change_pct == 50.0 and got["2024-04"].mom_change_pct is None
    assert got["2024-04"].moving_avg_3m == 225.0  # February and April


def test_open_tickets_hold_back_new_ones(spark):
    tel = spark.createDataFrame([(f"DEV{k}", f"r{k}", dt.datetime(2024, 1, 1), "E1", "L", True) for k in range(3)],
                                "device_id string, reading_id string, timestamp timestamp, error_code string, location_id string, maintenance_required boolean")
    existing = spark.createDataFrame([("DEV0", "OPEN"), ("DEV1", "CLOSED")], "device_id string, status string")
    assert {r.device_id for r in G.maintenance_tickets(tel, existing).collect()} == {"DEV1", "DEV2"}


def test_heatmap_keeps_unknown_industries(spark):
    churn = spark.createDataFrame([("S", "AEROSPACE", 0.5), ("S", None, 0.25)], "segment string, industry string, churn_probability double")
    assert {r.industry: r.mean_churn_probability for r in G.churn_heatmap(churn).collect()} == {"AEROSPACE": 0.5, None: 0.25}


def test_percent_rank(spark):
    values = [5.0, 1.0, 1.0, 2500.0, 999.0, 7000.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = {r.v: r.value_rank for r in G.percent_ranks(df, "v").collect()}
    assert got == {v: sum(x < v for x in values) / 5 for v in values}
