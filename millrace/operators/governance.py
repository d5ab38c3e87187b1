"""Tenant isolation, leak detection, column masking and access audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tenant_rows(rows: DataFrame, entitlements: DataFrame, tenant_col: str, principal: str | None = None) -> DataFrame:
    """Rows the principal may see: ``rows ⋉ entitlements`` on the tenant key.

    With ``principal`` given, the principal's entitlement rows (a handful) are
    the semi-join side; without it, every (principal, row) visibility pair is
    produced by an equi-join on the tenant key.
    """
    ent = entitlements.select("principal", F.col("tenant_id").alias(tenant_col))
    if principal is not None:
        mine = ent.where(F.col("principal") == principal).select(tenant_col)
        return rows.join(mine, tenant_col, "left_semi")
    return rows.join(ent, tenant_col)


def tenant_leaks(visible: DataFrame, entitlements: DataFrame, tenant_col: str) -> DataFrame:
    """Visible (principal, row) pairs whose tenant is not entitled to that principal; must be empty."""
    ent = entitlements.select("principal", F.col("tenant_id").alias(tenant_col))
    return visible.join(ent, ["principal", tenant_col], "left_anti")


def mask_email(c: Column) -> Column:
    return F.concat(F.lit("***@"), F.substring_index(c, "@", -1))


def mask_phone(c: Column) -> Column:
    return F.concat(F.lit("***-"), F.substring(c, -4, 4))


def mask_columns(customers: DataFrame, entitled: Column) -> DataFrame:
    """Contact columns in clear only where ``entitled`` is true; hashed or redacted elsewhere."""
    return customers.select(
        "customer_id", "customer_name",
        F.when(entitled, F.col("contact_name")).otherwise(F.substring(F.sha2("contact_name", 256), 1, 12)).alias("contact_name"),
        F.when(entitled, F.col("email")).otherwise(mask_email(F.col("email"))).alias("email"),
        F.when(entitled, F.col("phone")).otherwise(mask_phone(F.col("phone"))).alias("phone"),
        entitled.alias("entitled"))


def access_audit(requests: DataFrame) -> DataFrame:
    """Accesses per principal, action and day, with distinct objects touched."""
    return requests.groupBy("principal", F.to_date("ts").alias("day"), "action").agg(
        F.count(F.lit(1)).alias("accesses"), F.countDistinct("object_id").alias("objects"))
