"""Structured Streaming jobs over the telemetry / event stream.

Every job is an ordinary streaming query: a file source (new Parquet files in
a folder), event-time watermarks, and an append-mode Parquet sink with a
checkpoint in the shared checkpoint folder, so a restarted job resumes from
its committed offsets and state. ``run_available_now`` drives a query with
``trigger(availableNow=True)`` (process what is there, then stop) and returns
the sink as a batch DataFrame.
"""

from __future__ import annotations

import json
from typing import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans import builders as B
from ..sources.tables import table_path

WATERMARK = "10 minutes"


#: Files that one micro-batch of a live feed takes at most, so a backlog is worked off in bounded steps.
MAX_FILES_PER_TRIGGER = 200


def event_stream(spark: SparkSession, folder: str, name: str = "events", stored: bool = False) -> DataFrame:
    """Stream the Parquet files of table ``name`` in ``folder``, be it one file or a folder to which files are
    added (schema from the footers, never inferred from data); ``timestamp_ntz`` is cast to
    ``timestamp`` for watermarks.

    Files are taken in the order of their arrival. A live feed arrives in about the order of event time, so a file
    limit holds. The files of a ``stored`` table may each span all of its time: a job that keeps a watermark or a
    last reading takes what is there as one micro-batch, else rows of later batches would count as late."""
    path = table_path(folder, name)
    schema = spark.read.parquet(path).schema
    # As a glob, a path may name a single file, which a stream's plain path may not.
    reader = spark.readStream.schema(schema)
    if not stored:
        reader = reader.option("maxFilesPerTrigger", MAX_FILES_PER_TRIGGER)
    s = reader.parquet(path[:-1] + f"[{path[-1]}]")
    return s.select(*[F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, T.TimestampNTZType)
                      else F.col(f.name) for f in schema.fields])


class _StreamTables:
    def __init__(self, events):
        self.events = events


def telemetry_stream(events: DataFrame) -> DataFrame:
    """B06 applied to a stream: the builder is a pure projection, so it runs unchanged."""
    return B.telemetry(_StreamTables(events))


def run_available_now(df: DataFrame, out_path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    q = (df.writeStream.outputMode(mode).format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return df.sparkSession.read.parquet(out_path)


def tumbling(tel: DataFrame, size: str = "1 hour") -> DataFrame:
    """Per device and hour: readings, mean power, errors (emitted when the window closes)."""
    return tel.withWatermark("timestamp", WATERMARK).groupBy(F.window("timestamp", size), "device_id").agg(
        F.count(F.lit(1)).alias("readings"), F.round(F.avg("power_consumption"), 4).alias("mean_power"),
        F.count_if(F.col("operational_status") == "ERROR").alias("errors")
    ).select("device_id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
             "readings", "mean_power", "errors")


def sliding(tel: DataFrame, size: str = "1 hour", slide: str = "15 minutes") -> DataFrame:
    """1 h windows every 15 min per location."""
    return tel.withWatermark("timestamp", WATERMARK).groupBy(F.window("timestamp", size, slide), "location_id").agg(
        F.count(F.lit(1)).alias("readings"), F.count_if(F.col("operational_status") == "ERROR").alias("errors")
    ).select("location_id", F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
             "readings", "errors")


def error_sessions(tel: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Runs of ERROR readings per device separated by at least ``gap``.

    The watermark follows all readings, so sessions of a fleet without new errors close as well: the
    filter reads the event time, which keeps it above the watermark.
    """
    is_error = F.when(F.col("timestamp").isNull(), False).otherwise(F.col("operational_status") == "ERROR")
    w = tel.withWatermark("timestamp", WATERMARK).where(is_error)
    return w.groupBy(F.session_window("timestamp", gap), "device_id").agg(F.count(F.lit(1)).alias("errors")).select(
        "device_id", F.col("session_window.start").alias("session_start"),
        F.col("session_window.end").alias("session_end"), "errors")


def dedup_readings(tel: DataFrame) -> DataFrame:
    """Drop repeated reading_id within the watermark delay (state is evicted after it)."""
    return tel.withWatermark("timestamp", WATERMARK).dropDuplicatesWithinWatermark(["reading_id"])


def enrich(readings: DataFrame, devices: DataFrame) -> DataFrame:
    """Stream-static join of readings to the device dimension."""
    return readings.join(devices, "device_id", "left")


def sample_and_score(events: DataFrame, per_mille: int = 100, slow_ms: int = 2000) -> DataFrame:
    """The F05 sample of requests, scored per row as they arrive."""
    h = F.pmod(F.pmod(F.col("event_id"), F.lit(2147483647)) * F.lit(2654435761), F.lit(1000))
    dur = F.round(F.col("value") * 100).cast("bigint")
    return events.where(h < per_mille).select(
        F.col("event_id").alias("span_id"),
        F.concat(F.lit("T"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("trace_id"),
        F.col("event_type").alias("endpoint"), dur.alias("duration_ms"),
        (F.col("event_type") == "error").alias("error"), (dur > slow_ms).alias("slow"))


STATUS_OUT = T.StructType([T.StructField("device_id", T.StringType()), T.StructField("timestamp", T.TimestampType()),
                           T.StructField("reading_id", T.StringType()), T.StructField("previous_status", T.StringType()),
                           T.StructField("new_status", T.StringType())])


#: Readings of a device are put in order a slot at a time.
SLOT_MS = 600_000
#: Readings of a device that wait together; those beyond wait by slot, which takes more calls to the state store.
WAITING = 50_000


def _status_processor():
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

    class StatusChange(StatefulProcessor):
        """Readings wait until the watermark has passed the end of their slot, when nothing of it can arrive any more;
        then a device's statuses are compared in event time. A device has one timer, at the end of its earliest waiting
        slot. Its first ``WAITING`` readings wait in a list, a row a batch, so the usual device costs a few calls to the
        state store and not some for every slot; what is beyond waits in map state by slot. In memory: one batch of rows,
        the list, and one slot of one device."""

        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.last = handle.getValueState("last", "status string")
            # Readings in the list, whether slots are in use, and the time of the timer.
            self.held = handle.getValueState("held", "readings long, spilled boolean, timer long")
            self.waiting = handle.getListState("waiting", "readings string")
            self.slots = handle.getMapState("slots", "slot long", "readings string")

        def _timer(self, old: int, due: int) -> None:
            if old != due:
                if old:
                    self.handle.deleteTimer(old)
                self.handle.registerTimer(due)

        def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
            n, spilled, timer = self.held.get() if self.held.exists() else (0, False, 0)
            due = timer
            for pdf in rows:
                pdf = pdf[pdf["timestamp"].notna()]
                if not len(pdf):
                    continue
                us = pdf["timestamp"].to_numpy().astype("datetime64[us]").astype("int64")
                lines = [json.dumps(r) for r in zip(us.tolist(), pdf["reading_id"], pdf["operational_status"])]
                end = (int(us.min()) // (SLOT_MS * 1000) + 1) * SLOT_MS
                due = min(due, end) if due else end
                if n + len(lines) <= WAITING:
                    n += len(lines)
                    self.waiting.appendValue(("\n".join(lines),))
                    continue
                spilled, new = True, {}
                for t, line in zip(us.tolist(), lines):
                    new.setdefault(t // (SLOT_MS * 1000), []).append(line)
                for slot, more in new.items():
                    if self.slots.containsKey((slot,)):
                        more = [self.slots.getValue((slot,))[0], *more]
                    self.slots.updateValue((slot,), ("\n".join(more),))
            if due:
                self._timer(timer, due)
                self.held.update((n, spilled, due))
            yield from ()

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            closed = timerValues.getCurrentWatermarkInMs() // SLOT_MS  # slots below have ended
            _, spilled, _ = self.held.get()
            by_slot: dict[int, list] = {}
            stay: list[str] = []
            first = None  # of the slots that go on waiting
            for (lines,) in self.waiting.get():
                for line in lines.split("\n"):
                    r = json.loads(line)
                    slot = r[0] // (SLOT_MS * 1000)
                    if slot < closed:
                        by_slot.setdefault(slot, []).append(r)
                    else:
                        stay.append(line)
                        first = slot if first is None else min(first, slot)
            waits = {k[0] for k in self.slots.keys()} if spilled else set()
            open_slots = {k for k in waits if k >= closed}
            if open_slots:
                first = min(open_slots) if first is None else min(first, *open_slots)
            before, out = self.last.get()[0] if self.last.exists() else None, []
            for slot in sorted(by_slot.keys() | (waits - open_slots)):
                readings = by_slot.pop(slot, [])
                if slot in waits:
                    readings += [json.loads(line) for line in self.slots.getValue((slot,))[0].split("\n")]
                    self.slots.removeKey((slot,))
                for t, rid, status in sorted(readings, key=lambda r: (r[0], r[1] or "")):
                    if before is not None and status is not None and status != before:
                        out.append((key[0], pd.Timestamp(t, unit="us"), rid, before, status))
                    before = before if status is None else status
                if len(out) >= WAITING:
                    yield pd.DataFrame(out, columns=["device_id", "timestamp", "reading_id", "previous_status", "new_status"])
                    out = []
            if before is not None:
                self.last.update((before,))
            if stay:
                self.waiting.put([("\n".join(stay),)])
            else:
                self.waiting.clear()
            if first is None:
                self.held.clear()
            else:
                self.handle.registerTimer((first + 1) * SLOT_MS)
                self.held.update((len(stay), bool(open_slots), (first + 1) * SLOT_MS))
            if out:
                yield pd.DataFrame(out, columns=["device_id", "timestamp", "reading_id", "previous_status", "new_status"])

        def close(self) -> None:
            pass

    return StatusChange()


def status_change_alerts(tel: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """A row where a device's operational status changes, in event time (custom state per device).

    A reading is judged once the watermark has passed its ten-minute slot; what comes in any order within ``delay`` is
    put in order, what comes later is late and left out. A reading without a status says nothing."""
    return tel.withWatermark("timestamp", delay).select("device_id", "timestamp", "reading_id", "operational_status").groupBy("device_id") \
        .transformWithStateInPandas(statefulProcessor=_status_processor(), outputStructType=STATUS_OUT,
                                    outputMode="Append", timeMode="EventTime")


# ------------------------------------------------------------------ H06
#: Hash buckets of the index. A micro-batch rewrites the buckets of its ids, so there should be many more buckets
#: than a micro-batch has ids, and few enough for a bucket to fill a file.
INDEX_BUCKETS = 256


def index_schema(stream: DataFrame, id_col: str, meta_cols: list) -> T.StructType:
    of = {f.name: f.dataType for f in stream.schema.fields}
    return T.StructType([T.StructField("id", of[id_col]), T.StructField("version", T.LongType()), T.StructField("op", T.StringType()),
                         *[T.StructField(m, of[m]) for m in meta_cols], T.StructField("vector", T.ArrayType(T.DoubleType())), T.StructField("bucket", T.IntegerType())])


def index_sync_batch(index_root: str, id_col: str, vec_col: str, meta_cols: list, schema: T.StructType, buckets: int = INDEX_BUCKETS):
    """foreachBatch upsert of changed vectors (and deletes, by an ``op`` column) into an index folder partitioned
    by hash bucket of the id.

    A batch reads and rewrites only the buckets of its own ids (dynamic partition overwrite). The newest version of an
    id stays, the version being the batch; a delete stays as a row without a vector, so a bucket is never left unwritten
    and a replayed batch, also one that was cut off between buckets, gives the same rows again."""
    from ..operators import retrieval as D

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        op = F.col("op") if "op" in batch.columns else F.lit("upsert")
        bucket = F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")
        new = batch.select(F.col(id_col).alias("id"), F.lit(batch_id + 1).cast("long").alias("version"), op.alias("op"),
                           *meta_cols, D.l2_normalize(F.col(vec_col)).alias("vector")).where("id IS NOT NULL")
        new = new.where((F.col("op") == "delete") | F.col("vector").isNotNull()).withColumn("bucket", bucket).select(*schema.names)
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]  # at most ``buckets``
        if not batch_id:  # an empty index, so that every later batch finds a folder
            new.where("false").write.mode("append").partitionBy("bucket").parquet(index_root)
        if not touched:
            return
        old = spark.read.schema(schema).parquet(index_root).where(F.col("bucket").isin(touched))
        # Of the rows of one batch with one id, the greatest stays: deletes come before upserts.
        cols = [c for c in schema.names if c not in ("id", "bucket")]
        latest = old.unionByName(new).groupBy("bucket", "id").agg(F.max(F.struct(*cols)).alias("l"))
        (latest.select("id", *[F.col(f"l.{c}").alias(c) for c in cols], "bucket").repartition("bucket")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(index_root))
    return run


def run_index_sync(stream: DataFrame, index_root: str, checkpoint: str, id_col: str, vec_col: str,
                   meta_cols: list, buckets: int = INDEX_BUCKETS) -> DataFrame:
    schema = index_schema(stream, id_col, meta_cols)
    q = (stream.writeStream.foreachBatch(index_sync_batch(index_root, id_col, vec_col, meta_cols, schema, buckets))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return stream.sparkSession.read.schema(schema).parquet(index_root).where("op <> 'delete'").drop("op", "bucket")


# ------------------------------------------------------------------ H07
def trace_spans(events: DataFrame) -> DataFrame:
    """The events of a stream as spans: one trace a user and day."""
    return events.select(
        "event_id", "ts", "user_id", F.col("event_type").alias("endpoint"), F.round(F.col("value") * 100).cast("bigint").alias("duration_ms"),
        F.concat(F.lit("T"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("trace_id"))


def sampled_traces(spans: DataFrame, per_mille: int = 100) -> DataFrame:
    """Whole traces, chosen by an arithmetic hash of user and day."""
    h = F.pmod(F.pmod(F.col("user_id"), F.lit(2147483647)) * F.lit(2654435761) + F.unix_date(F.to_date("ts")).cast("bigint") * 97, F.lit(1000))
    return spans.where(h < per_mille)


def trace_scoring(called: DataFrame, planned: DataFrame, expected_tools: dict, slow_ms: int = 2000) -> DataFrame:
    """Tool calls of the sampled traces scored as they close (F01 on a stream).

    ``called`` and ``planned`` are span streams: the tools that a trace calls are gathered from the one, its entry
    point, which says the expected tools, from the other. Both are closed by the watermark at the end of the trace's
    day and met by a stream-stream join on trace and day."""
    from ..operators import evaluation as EV
    day = F.window("ts", "1 day")
    a = called.withWatermark("ts", WATERMARK).groupBy("trace_id", day).agg(
        F.array_sort(F.collect_set("endpoint")).alias("called_tools"), F.count(F.lit(1)).alias("spans"),
        F.count_if(F.col("endpoint") == "error").alias("errors"), F.count_if(F.col("duration_ms") > slow_ms).alias("slow"))
    entry = F.min(F.struct("ts", "event_id", "endpoint"))["endpoint"]
    b = planned.withWatermark("ts", WATERMARK).groupBy("trace_id", day).agg(entry.alias("entry"))
    plan = F.coalesce(*[F.when(F.col("entry") == k, F.array(*[F.lit(x) for x in v])) for k, v in expected_tools.items()])
    joined = a.join(b, ["trace_id", "window"]).select(F.col("trace_id").alias("case_id"), plan.alias("expected_tools"), "called_tools", "spans", "errors", "slow")
    return EV.score_tool_calls(joined, keep=["spans", "errors", "slow"])


# ------------------------------------------------------------------ H08
def late_rows_batch(root: str, size: str = "1 hour", delay: str = WATERMARK):
    """foreachBatch side output of the readings behind the watermark.

    The watermark of a batch is the greatest event time of the batches before it less ``delay``, as in H01; a reading is
    late if its window had been emitted by then. A batch writes its late readings and its greatest event time under its
    own id (overwritten by a replay) and reads the one before."""
    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = None
        if batch_id:
            seen = spark.read.schema("seen timestamp").parquet(f"{root}/seen/batch={batch_id - 1}").agg(F.max("seen")).first()[0]
        end = F.window("timestamp", size)["end"]
        late = batch.where(end <= F.lit(seen).cast("timestamp") - F.expr(f"INTERVAL {delay}")) if seen else batch.where("false")
        late.write.mode("overwrite").parquet(f"{root}/late/batch={batch_id}")
        batch.agg(F.greatest(F.max("timestamp"), F.lit(seen).cast("timestamp")).alias("seen")).write.mode("overwrite").parquet(f"{root}/seen/batch={batch_id}")
    return run


def run_late_readings(tel: DataFrame, root: str, checkpoint: str) -> DataFrame:
    """The late readings of all batches so far."""
    q = (tel.writeStream.foreachBatch(late_rows_batch(root)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return tel.sparkSession.read.schema(tel.schema).parquet(f"{root}/late").drop("batch")
