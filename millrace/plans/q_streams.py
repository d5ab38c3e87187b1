"""Queries for §2.8 streaming (H01–H09): finite availableNow runs over the driver files."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import config as C
from ..session import scratch_path
from ..streaming import telemetry as H
from . import builders as B
from .queries import query


def _run(spark, df, name):
    base = scratch_path(spark, f"stream-{name}")
    return H.run_available_now(df, f"{base}/out", f"{base}/checkpoint")


def tel_stream(spark, sf):
    return H.telemetry_stream(H.event_stream(spark, sf, stored=True))


@query("telemetry_tumbling")
def q_h01(spark, sf):
    return _run(spark, H.tumbling(tel_stream(spark, sf)), "tumbling")


@query("telemetry_sliding")
def q_h02(spark, sf):
    return _run(spark, H.sliding(tel_stream(spark, sf)), "sliding")


@query("error_sessions")
def q_h03(spark, sf):
    return _run(spark, H.error_sessions(tel_stream(spark, sf)), "sessions")


@query("dedup_readings")
def q_h04(spark, sf):
    # the same files arrive through two sources (a replayed feed): every reading twice
    twice = tel_stream(spark, sf).unionByName(tel_stream(spark, sf))
    return _run(spark, H.dedup_readings(twice), "dedup")


@query("status_change_alerts")
def q_h05(spark, sf):
    return _run(spark, H.status_change_alerts(tel_stream(spark, sf)), "status")


@query("stream_index_sync")
def q_h06(spark, sf):
    base = scratch_path(spark, "stream-index")
    idx = H.run_index_sync(H.event_stream(spark, sf, "embeddings"), f"{base}/index", f"{base}/checkpoint",
                           "vec_id", "embedding", ["label"])
    from ..operators.retrieval import content_hash
    return idx.select("id", "label", content_hash(F.col("vector"), F.col("label")).alias("content_hash"))


@query("stream_trace_scoring")
def q_h07(spark, sf):
    from .q_routing import EXPECTED_TOOLS
    spans = lambda: H.sampled_traces(H.trace_spans(H.event_stream(spark, sf, stored=True)))
    return _run(spark, H.trace_scoring(spans(), spans(), EXPECTED_TOOLS), "trace-scoring")


#: Deliveries in which the events arrive: gateways, each of a quarter of the devices, hand in their readings in turn.
ARRIVALS = 4


@query("late_readings")
def q_h08(spark, sf):
    """Readings that arrive after H01 has emitted their hourly window; the stream goes on from its checkpoint after
    each delivery."""
    from ..sources.tables import Tables
    base = scratch_path(spark, "stream-late")
    events = Tables(spark, sf).events
    for n in range(ARRIVALS):
        events.where(F.pmod("user_id", F.lit(ARRIVALS)) == n).write.mode("append").parquet(f"{base}/feed/events.parquet")
        out = H.run_late_readings(H.telemetry_stream(H.event_stream(spark, f"{base}/feed", stored=True)), f"{base}/out", f"{base}/checkpoint")
    return out.select("reading_id", "device_id", "timestamp")


def devices(spark, sf):
    """Static device dimension (one row per device seen in the event table)."""
    from ..sources.tables import Tables
    u = Tables(spark, sf).events.select("user_id").distinct()
    return u.select(F.format_string("DEV%04d", F.col("user_id") + 1).alias("device_id"),
                    B.pick(C.DEVICE_TYPES, F.col("user_id")).alias("device_type"),
                    B.pick(C.DEVICE_LOCATIONS, F.col("user_id")).alias("location_id"))


@query("stream_enrich")
def q_h09(spark, sf):
    ev = H.event_stream(spark, sf).select(
        F.concat(F.lit("R"), F.col("event_id").cast("string")).alias("reading_id"),
        F.format_string("DEV%04d", F.col("user_id") + 1).alias("device_id"),
        F.col("ts").alias("timestamp"), F.col("value").alias("power_consumption"))
    return _run(spark, H.enrich(ev, devices(spark, sf)), "enrich")
