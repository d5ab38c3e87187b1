"""Evaluation scorers, trace/span analytics and request-log monitoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import tokens
from ..session import written

SLO_P95_MS = 2000
FAST_MS = 500
CONCURRENCY_TARGET = 100
SAMPLE_PER_MILLE = 100  # 10 % of traffic


def spans_from_events(events: DataFrame) -> DataFrame:
    """Span table (trace_id, span_id, parent_id, start, duration_ms, error, tokens, cost, endpoint).

    A trace is one user's activity on one day; its earliest event is the root span
    and every other span is its child. The root is found with ``min(struct)`` (a
    partial aggregate) and joined back.
    """
    e = events.select(
        F.concat(F.lit("T"), F.col("user_id").cast("string"), F.lit("-"), F.date_format("ts", "yyyyMMdd")).alias("trace_id"),
        F.col("event_id").alias("span_id"), F.col("ts").alias("start"),
        F.round(F.col("value") * 100).cast("bigint").alias("duration_ms"),
        (F.col("event_type") == "error").alias("error"),
        F.coalesce(F.get_json_object("props", "$.k").try_cast("int"), F.lit(0)).alias("tokens"),
        F.col("event_type").alias("endpoint"))
    roots = e.groupBy("trace_id").agg(F.min(F.struct("start", "span_id")).alias("r")) \
        .select("trace_id", F.col("r.span_id").alias("root_id"))
    return e.join(roots, "trace_id").select(
        "trace_id", "span_id", F.when(F.col("span_id") != F.col("root_id"), F.col("root_id")).alias("parent_id"),
        "start", "duration_ms", "error", "tokens", (F.col("tokens") * 2 / 1000.0).alias("cost"), "endpoint")


def score_tool_calls(cases: DataFrame, keep: list = ()) -> DataFrame:
    """expected vs called tools -> precision, recall, exact (set semantics); ``keep`` are columns to carry."""
    inter = F.size(F.array_intersect("expected_tools", "called_tools"))
    return cases.select("case_id", "expected_tools", "called_tools", *keep,
                        F.try_divide(inter, F.size("called_tools")).alias("precision"),
                        F.try_divide(inter, F.size("expected_tools")).alias("recall"),
                        (F.array_sort(F.array_distinct("expected_tools")) ==
                         F.array_sort(F.array_distinct("called_tools"))).alias("exact"))


def normalize_text(c):
    return F.trim(F.regexp_replace(F.lower(c), r"\s+", " "))


def score_responses(pairs: DataFrame) -> DataFrame:
    """deterministic response checks: normalised equality and token recall of the expected text."""
    e = F.array_distinct(tokens(F.col("expected_response")))
    r = F.array_distinct(tokens(F.col("response")))
    return pairs.select("case_id", "version",
                        (normalize_text(F.col("expected_response")) == normalize_text(F.col("response"))).cast("int").alias("exact_match"),
                        F.try_divide(F.size(F.array_intersect(e, r)), F.size(e)).alias("token_overlap"))


def eval_summary(scores: DataFrame, scorers: list) -> DataFrame:
    """mean and count of each scorer per version (unpivot, then one aggregation)."""
    long = scores.select("version", F.explode(F.array(*[
        F.struct(F.lit(s).alias("scorer"), F.col(s).cast("double").alias("score")) for s in scorers])).alias("x")) \
        .select("version", "x.scorer", "x.score")
    return long.groupBy("version", "scorer").agg(F.round(F.avg("score"), 6).alias("mean"),
                                                 F.count("score").alias("n"))


def compare_versions(summary: DataFrame, base: str, other: str) -> DataFrame:
    """per scorer, the mean of two versions side by side and their difference."""
    p = summary.groupBy("scorer").pivot("version", [base, other]).agg(F.first("mean"))
    return p.select("scorer", F.col(base).alias("base_mean"), F.col(other).alias("other_mean"),
                    F.round(F.col(other) - F.col(base), 6).alias("delta"))


def sample_traffic(df: DataFrame, id_col: str, per_mille: int = SAMPLE_PER_MILLE) -> DataFrame:
    """reproducible ~10 % sample by an arithmetic hash of the id (same id -> same decision)."""
    h = F.pmod(F.pmod(F.col(id_col), F.lit(2147483647)) * F.lit(2654435761), F.lit(1000))
    return df.where(h < per_mille)


def latency_slo(spans: DataFrame) -> DataFrame:
    """exact p50/p95/p99 of integer-ms latency per endpoint against the 2 s / 500 ms targets.

    ``percentile`` keeps a value->count map per group, bounded by the distinct
    ms values, and merges partially, so a hot endpoint does not sit in one task.
    """
    d = F.col("duration_ms")
    g = spans.groupBy("endpoint").agg(
        F.count(F.lit(1)).alias("requests"),
        F.percentile(d, 0.5).alias("p50_ms"), F.percentile(d, 0.95).alias("p95_ms"),
        F.percentile(d, 0.99).alias("p99_ms"),
        (F.count_if(d < FAST_MS) / F.count(F.lit(1))).alias("share_under_500ms"))
    return g.withColumn("meets_p95_2s", F.col("p95_ms") < SLO_P95_MS)


def span_rollup(spans: DataFrame) -> DataFrame:
    """per trace: span count, summed and wall-clock duration, errors, tokens, cost and the
    root's self time (its duration minus its children's, via a children aggregate joined back)."""
    us = F.unix_micros("start")
    per = spans.groupBy("trace_id").agg(
        F.count(F.lit(1)).alias("spans"), F.sum("duration_ms").alias("total_ms"),
        ((F.max(us + F.col("duration_ms") * 1000) - F.min(us)) / 1000.0).alias("wall_ms"),
        F.count_if("error").alias("errors"), F.sum("tokens").alias("tokens"))
    kids = spans.where(F.col("parent_id").isNotNull()).groupBy(F.col("parent_id").alias("kid_of")) \
        .agg(F.sum("duration_ms").alias("child_ms"))
    roots = spans.where(F.col("parent_id").isNull()).join(kids, F.col("span_id") == F.col("kid_of"), "left") \
        .select("trace_id", (F.col("duration_ms") - F.coalesce("child_ms", F.lit(0))).alias("root_self_ms"))
    return per.join(roots, "trace_id").select("trace_id", "spans", "total_ms", "wall_ms", "errors", "tokens",
                                              (F.col("tokens") * 2 / 1000.0).alias("cost"), "root_self_ms")


def feedback_join(traces: DataFrame, feedback: DataFrame, names: list) -> DataFrame:
    """latest value per (trace, feedback name), pivoted next to each trace (left join)."""
    latest = feedback.groupBy("trace_id", "name").agg(F.max(F.struct("ts", "value")).alias("l"))
    p = latest.groupBy("trace_id").pivot("name", names).agg(F.first("l.value"))
    n = feedback.groupBy("trace_id").agg(F.count(F.lit(1)).alias("n_feedback"))
    return traces.select("trace_id").join(p, "trace_id", "left").join(n, "trace_id", "left") \
        .withColumn("n_feedback", F.coalesce("n_feedback", F.lit(0)))


def curate_failures(failed: DataFrame, existing: DataFrame) -> DataFrame:
    """failed cases become new eval rows: dedupe on normalised input, drop ones already present."""
    f = failed.select("case_id", normalize_text(F.col("input")).alias("normalized_input"))
    g = f.groupBy("normalized_input").agg(F.min("case_id").alias("case_id"), F.count(F.lit(1)).alias("occurrences"))
    ex = existing.select(normalize_text(F.col("input")).alias("normalized_input"))
    return g.join(ex, "normalized_input", "left_anti")


def retrieval_relevance(retrieved: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """precision@k and recall@k per query from retrieved and relevant id pairs."""
    r = retrieved.where(F.col("rank") <= k).select("query_id", "doc_id")
    hits = r.join(relevant, ["query_id", "doc_id"]).groupBy("query_id").agg(F.count(F.lit(1)).alias("hits"))
    nrel = relevant.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    q = retrieved.select("query_id").union(relevant.select("query_id")).distinct()
    j = q.join(nrel, "query_id", "left").join(hits, "query_id", "left")
    h = F.coalesce("hits", F.lit(0))
    return j.select("query_id", F.coalesce("n_relevant", F.lit(0)).alias("n_relevant"), h.alias("hits"),
                    (h / float(k)).alias("precision_at_k"), F.try_divide(h, F.col("n_relevant")).alias("recall_at_k"))


def peak_concurrency(spans: DataFrame, ranges: int | None = None) -> DataFrame:
    """most spans in flight at once, exact, by a prefix scan over ranges of time.

    Starts (+1) and ends (-1) are summed by instant, map side first (at equal times ends come before starts, so the
    level behind an instant is its highest). The instants are dealt into ranges of equal size, however many fall into
    one minute; each range gives its net change, the running sum over these (a row a range) its offset, and the running
    sum inside a range the level at each instant. The peak is the greatest, at its first instant.
    """
    spark = spans.sparkSession
    us = F.unix_micros("start")
    points = spans.select(us.alias("t"), F.lit(1).alias("d")).unionByName(
        spans.select((us + F.col("duration_ms") * 1000).alias("t"), F.lit(-1).alias("d")))
    n = ranges or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    # Written, as the number of a range must not change between its two uses.
    dealt = written(points.where("t IS NOT NULL").groupBy("t").agg(F.sum("d").alias("net"))
                    .repartitionByRange(n, "t").withColumn("part", F.spark_partition_id()), "concurrency")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = dealt.groupBy("part").agg(F.sum("net").alias("net")) \
        .select("part", F.coalesce(F.sum("net").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    highest = dealt.withColumn("level", F.sum("net").over(inside)).groupBy("part") \
        .agg(F.max(F.struct(F.col("level"), (-F.col("t")).alias("nt"))).alias("m"))
    best = highest.join(offsets, "part").agg(F.max(F.struct((F.col("offset") + F.col("m.level")).alias("level"), F.col("m.nt").alias("nt"))).alias("x"))
    return best.select(F.col("x.level").alias("peak_concurrency"),
                       F.timestamp_micros(-F.col("x.nt")).alias("first_peak_at"),
                       (F.col("x.level") >= CONCURRENCY_TARGET).alias("meets_target"))


def request_log_stats(requests: DataFrame) -> DataFrame:
    """daily requests, errors and request bytes per endpoint."""
    return requests.groupBy(F.to_date("ts").alias("day"), "endpoint").agg(
        F.count(F.lit(1)).alias("requests"), F.count_if("error").alias("errors"),
        F.sum("request_bytes").alias("request_bytes"))
