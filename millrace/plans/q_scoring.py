"""Queries for §2.3 scoring, lookup and order functions."""

from __future__ import annotations

from ..functions import scoring as S
from .queries import Ctx, query

USAGE_WINDOW_DAYS = 365
DEMAND_FACTOR = 20.0


def usage(c: Ctx):
    return S.part_usage_rate(c.only("transactions", "transaction_date", "product_id", "quantity"), window_days=USAGE_WINDOW_DAYS, demand_factor=DEMAND_FACTOR)


def churn_customers(c: Ctx):
    return c.only("customers", "customer_id", "segment", "industry", "last_purchase_date", "total_orders", "total_spent")


@query("part_usage_rate")
def q_part_usage_rate(spark, sf):
    return usage(Ctx(spark, sf))


@query("predict_shortage")
def q_predict_shortage(spark, sf):
    c = Ctx(spark, sf)
    return S.predict_shortage(c.inventory, usage(c))


@query("predict_churn")
def q_predict_churn(spark, sf):
    return S.predict_churn(churn_customers(Ctx(spark, sf)))
