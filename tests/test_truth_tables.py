"""Golden truth tables for the scoring and lookup rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace import config as C
from millrace.functions import scoring as S
from millrace.operators import lookup as L


def shortage_row(spark, qty, usage):
    df = spark.createDataFrame([(qty, usage)], "q int, u double")
    cols = S.shortage_columns(F.col("q"), F.col("u"))
    return df.select(*[c.alias(n) for n, c in cols.items()]).first()


@pytest.mark.parametrize("days,level", [(1, "CRITICAL"), (2, "CRITICAL"), (3, "HIGH"), (6, "HIGH"),
                                        (7, "MEDIUM"), (11, "MEDIUM"), (12, "LOW"), (30, "LOW")])
def test_shortage_bands_by_whole_day(spark, days, level):
    r = shortage_row(spark, days * 10, 10.0)
    assert r.days_until_shortage == days
    assert r.risk_level == level


def test_shortage_reference_call(spark):
    # part PART001, inventory 25, usage 2.5 -> 10 days, risk 0.286, MEDIUM, order 75
    r = shortage_row(spark, 25, 2.5)
    assert (r.days_until_shortage, r.risk_score, r.risk_level, r.suggested_order_quantity) == (10, 0.286, "MEDIUM", 75)
    assert r.predicted_shortage_date == C.AS_OF_SHIPPING + dt.timedelta(days=10)
    assert r.recommendation == "MEDIUM: Monitor closely. 10 days of inventory remaining."


def test_shortage_floor_and_stockout(spark):
    r = shortage_row(spark, 0, None)
    assert r.daily_usage_rate == 0.1 and r.days_until_shortage == 1 and r.risk_level == "CRITICAL"
    assert r.risk_score == round(13 / 14, 3)


def churn_row(spark, d, n, v):
    df = spark.createDataFrame([(d, n, v)], "d int, n int, v double")
    cols = S.churn_columns(F.col("d"), F.col("n"), F.col("v"))
    return df.select(*[c.alias(k) for k, c in cols.items()]).first()


@pytest.mark.parametrize("d,n,v", [(60, 4, 199.0), (61, 5, 200.0), (90, 20, 1000.0), (61, 4, 1000.0)])
def test_churn_truth_table(spark, d, n, v):
    r = churn_row(spark, d, n, v)
    p = min(1.0, d / 90.0) * 0.5 + max(0.0, 1.0 - n / 20.0) * 0.3 + max(0.0, 1.0 - v / 1000.0) * 0.2
    assert r.churn_probability == pytest.approx(round(p, 3))
    assert r.risk_level == ("HIGH" if p > 0.7 else "MEDIUM" if p > 0.4 else "LOW")
    factors = ([f"No purchases in {d} days"] if d > 60 else []) + (["Low purchase frequency"] if n < 5 else []) \
        + (["Low average order value"] if v < 200 else [])
    assert r.risk_factors == factors
    assert len(r.recommendations) == (3 if r.risk_level != "LOW" else 1)


def test_purchase_order_checks_in_order(spark):
    sup = spark.createDataFrame([("SUP0001", "Acme", 7)], "supplier_id string, supplier_name string, lead_time_days int")
    parts = spark.createDataFrame([("PART00001", "Bearing", 15.5, 10)],
                                  "part_id string, part_name string, unit_cost double, min_qty int")
    req = spark.createDataFrame([
        ("r1", "SUP0001", "PART00001", 0, "NORMAL"),     # quantity <= 0 wins over everything
        ("r2", "SUP9999", "PART00001", 20, "NORMAL"),    # unknown supplier
        ("r3", "SUP0001", "PART99999", 20, "NORMAL"),    # unknown part
        ("r4", "SUP0001", "PART00001", 5, "NORMAL"),     # below minimum
        ("r5", "SUP0001", "PART00001", 20, "URGENT"),
        ("r6", "SUP0001", "PART00001", 20, "HIGH"),
        ("r7", "SUP0001", "PART00001", 20, "whatever"),  # unknown priority -> NORMAL
    ], "request_id string, supplier_id string, part_id string, quantity int, priority string")
    out = {r.request_id: r for r in L.create_purchase_orders(req, sup, parts).collect()}
    assert out["r1"].error == "Quantity must be greater than zero"
    assert out["r2"].error == "Invalid supplier ID: SUP9999"
    assert out["r3"].error == "Invalid part ID: PART99999"
    assert out["r4"].error == "Quantity 5 below minimum order quantity 10"
    assert all(out[k].status == "FAILED" and out[k].order_id is None for k in ["r1", "r2", "r3", "r4"])
    u = out["r5"]
    assert (u.status, u.subtotal, u.rush_fee, u.total_cost, u.rush_fee_percent, u.estimated_days) == \
        ("PENDING", 310.0, 62.0, 372.0, 20.0, 4)
    assert (out["r6"].rush_fee, out["r6"].estimated_days) == (31.0, 6)
    assert (out["r7"].priority, out["r7"].rush_fee, out["r7"].estimated_days) == ("NORMAL", 0.0, 7)
    assert u.order_id.startswith("PO-") and len(u.order_id) == 3 + 64


@pytest.mark.parametrize("qty,level,status", [(100, 100, "REORDER REQUIRED"), (150, 100, "LOW STOCK"),
                                              (151, 100, "ADEQUATE"), (0, 50, "REORDER REQUIRED")])
def test_inventory_status_boundaries(spark, qty, level, status):
    df = spark.createDataFrame([(qty, level)], "q int, l int")
    assert df.select(L.stock_status(F.col("q"), F.col("l")).alias("s")).first().s == status


def test_track_shipments_empty_period_gives_zero_counts(spark):
    s = spark.createDataFrame([(dt.date(1990, 1, 1), "DELIVERED")], "shipment_date date, status string")
    rows = {r.days_back: r for r in L.track_shipments(s).collect()}
    assert set(rows) == {7, 30, 90}
    assert rows[7].total_shipments == 0 and rows[7].delivered_pct is None
