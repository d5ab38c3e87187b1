"""Queries for §2.1 sources, sinks, schema and layout."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import layout as A
from ..operators import lookup as L
from ..session import scratch_path
from ..sources import sinks as W
from ..sources.schemas import TABLES
from ..sources.tables import scan_table
from .q_lookup import delivery_columns, order_requests, part_terms
from .q_quality import ALL_TABLES, key_tables
from .queries import Ctx, query


@query("create_tables")
def q_a01(spark, sf):
    return W.create_tables(spark, scratch_path(spark, "warehouse"))


PROPS_SCHEMA = T.StructType([T.StructField("k", T.IntegerType())])


@query("typed_ingest")
def q_a02(spark, sf):
    return A.typed_ingest(Ctx(spark, sf).events, "props", PROPS_SCHEMA, ["event_id"])


LINEITEM_TARGET = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.IntegerType()), T.StructField("l_extendedprice", T.DecimalType(18, 2)),
    T.StructField("l_discount", T.DecimalType(4, 2)), T.StructField("l_tax", T.DecimalType(4, 2)),
    T.StructField("l_shipdate", T.DateType())])


@query("conform_to_schema")
def q_a03(spark, sf):
    return A.conform_to_schema(Ctx(spark, sf).lineitem, LINEITEM_TARGET)


def _declared(spark, name):
    W.create_tables(spark, scratch_path(spark, "warehouse"), [TABLES[name]])
    return TABLES[name].qualified


@query("overwrite_table")
def q_a04(spark, sf):
    return W.overwrite_table(Ctx(spark, sf).suppliers, _declared(spark, "suppliers"))


@query("insert_overwrite")
def q_a05(spark, sf):
    c = Ctx(spark, sf)
    t = _declared(spark, "telemetry")
    W.overwrite_table(c.telemetry, t)
    even_days = c.telemetry.where(F.dayofmonth("reading_date") % 2 == 0).withColumn("maintenance_required", F.lit(True))
    return W.insert_overwrite_partitions(even_days, t)


@query("evolving_write")
def q_a06(spark, sf):
    c = Ctx(spark, sf)
    s = c.suppliers
    batch = s.where(F.col("status") == "INACTIVE").join(L.on_time_rate(delivery_columns(c)), "supplier_id", "left")
    return W.evolving_write(s.where(F.col("status") == "ACTIVE"), batch, scratch_path(spark, "suppliers_v2"))


@query("scan_table")
def q_a07(spark, sf):
    return scan_table(spark, "lineitem", sf)


@query("partitioned_write")
def q_a08(spark, sf):
    tel = Ctx(spark, sf).telemetry.drop("reading_date")
    return W.partitioned_write(tel, scratch_path(spark, "telemetry_by_day"), "reading_date", ts_col="timestamp")


@query("cluster_by_keys")
def q_a09(spark, sf):
    inv = Ctx(spark, sf).inventory
    keyed = inv.withColumn("part_no", F.expr("substring(part_id, 5)").cast("bigint")) \
        .withColumn("warehouse_no", F.expr("substring(warehouse_id, 3)").cast("bigint"))
    return A.cluster_by_keys(keyed, ["part_no", "warehouse_no"], scratch_path(spark, "inventory_z")) \
        .drop("part_no", "warehouse_no")


@query("compact_files")
def q_a10(spark, sf):
    return W.compact_files(Ctx(spark, sf).shipments, scratch_path(spark, "shipments_compact"))


def inventory_v2(c: Ctx):
    """Inventory after receiving the valid purchase orders, without rows of inactive suppliers."""
    po = L.create_purchase_orders(order_requests(c), c.suppliers, part_terms(c), L.on_time_rate(delivery_columns(c))) \
        .where(F.col("status") == "PENDING").select(F.col("request_id").alias("inventory_id"),
                                                     F.col("quantity").alias("received"))
    inactive = c.suppliers.where(F.col("status") == "INACTIVE").select("supplier_id")
    v2 = c.inventory.join(po, "inventory_id", "left").join(inactive, "supplier_id", "left_anti")
    return v2.withColumn("current_quantity", (F.col("current_quantity") + F.coalesce("received", F.lit(0))).cast("int")) \
        .select(*c.inventory.columns)


@query("change_feed")
def q_a11(spark, sf):
    c = Ctx(spark, sf)
    cols = ["inventory_id", "supplier_id", "current_quantity", "reorder_level"]
    return A.change_feed(c.inventory.select(*cols), inventory_v2(c).select(*cols), "inventory_id")


EXPECTED_TABLES = [TABLES[n].name for n in ALL_TABLES] + ["request_log"]


@query("table_row_counts")
def q_a12(spark, sf):
    return A.table_row_counts(key_tables(Ctx(spark, sf), {n: {TABLES[n].key} for n in ALL_TABLES}), EXPECTED_TABLES)


@query("limit_result")
def q_a13(spark, sf):
    r = L.reorder_list(Ctx(spark, sf).inventory)
    return A.limit_result(r, [F.col("order_cost").desc(), F.col("inventory_id")], 100)
