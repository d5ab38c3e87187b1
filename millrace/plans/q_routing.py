"""Queries for §2.5 routing (E01–E05) and §2.6 evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import tokens
from ..operators import evaluation as EV
from ..operators import retrieval as D
from ..operators import routing as R
from ..operators.textmatch import contains_join
from ..session import written
from .q_retrieval import PRESETS
from .queries import Ctx, query

GENERAL = ["sop", "incidents"]


def questions(c: Ctx):
    return R.route_intent(R.last_user_message(c.conversations))


@query("last_user_message")
def q_e01(spark, sf):
    return R.last_user_message(Ctx(spark, sf).conversations)


@query("route_intent")
def q_e02(spark, sf):
    return questions(Ctx(spark, sf)).select("conv_id", "route")


def retriever_results(c: Ctx, q, names):
    """Preset retrievers over the given questions (query_id = conv_id)."""
    out = None
    for name, table, id_col, text_col, k in PRESETS:
        if name not in names:
            continue
        qs = names[name](q) if callable(names.get(name)) else q
        r = D.keyword_search(c.text_index(table, id_col, text_col), qs, "conv_id", "last_user_text", k) \
            .select(F.lit(name).alias("retriever"), "query_id", "rank", F.col("doc_id").alias("id"), "score")
        out = r if out is None else out.unionByName(r)
    return out


@query("route_context")
def q_e03(spark, sf):
    c = Ctx(spark, sf)
    q = questions(c).where(F.col("last_user_text").isNotNull())
    # each retriever only scores the questions routed to it (or to the general route when it is a general one)
    names = {n: (lambda n: lambda qq: qq.where((F.col("route") == n) | (F.lit(n in GENERAL) & (F.col("route") == "general"))))(n)
             for n in ["sop", "incidents", "proposals"]}
    return R.route_context(q, retriever_results(c, q, names), general=GENERAL)


@query("fanout_context")
def q_e04(spark, sf):
    c = Ctx(spark, sf)
    q = questions(c).where(F.col("last_user_text").isNotNull())
    order = [p[0] for p in PRESETS]
    return R.fanout_context(retriever_results(c, q, {n: None for n in order}), order)


@query("assemble_history")
def q_e05(spark, sf):
    return R.assemble_history(Ctx(spark, sf).conversations)


# ---- evaluation -------------------------------------------------------------------------------
# Golden tool plan per trace entry point (fixed values of the evaluation set).
EXPECTED_TOOLS = {"view": ["view", "click"], "click": ["click", "purchase"], "signup": ["signup", "view"],
                  "purchase": ["purchase"], "error": ["view"]}


def spans(c: Ctx):
    return EV.spans_from_events(c.events)


def tool_cases(c: Ctx):
    s = spans(c)
    root = s.where(F.col("parent_id").isNull()).select("trace_id", F.col("endpoint").alias("entry"))
    called = s.groupBy("trace_id").agg(F.array_sort(F.collect_set("endpoint")).alias("called_tools"))  # <= 5 types
    exp = F.coalesce(*[F.when(F.col("entry") == k, F.array(*[F.lit(x) for x in v])) for k, v in EXPECTED_TOOLS.items()])
    return called.join(root, "trace_id").select(F.col("trace_id").alias("case_id"), exp.alias("expected_tools"),
                                                "called_tools")


@query("score_tool_calls")
def q_f01(spark, sf):
    return EV.score_tool_calls(tool_cases(Ctx(spark, sf)))


def response_pairs(c: Ctx):
    """(user turn, the assistant turn that follows it) per conversation; A/B version by conversation id."""
    m = c.conversations
    u = m.where(F.col("role") == "user").select("conv_id", "turn", F.col("text").alias("expected_response"))
    a = m.where(F.col("role") == "assistant").select("conv_id", (F.col("turn") - 1).alias("turn"),
                                                     F.col("text").alias("response"))
    return u.join(a, ["conv_id", "turn"]).select(
        F.concat_ws("-", "conv_id", "turn").alias("case_id"),
        F.when(F.pmod("conv_id", F.lit(2)) == 0, "v1").otherwise("v2").alias("version"),
        "expected_response", "response")


def response_scores(c: Ctx):
    return EV.score_responses(response_pairs(c))


@query("score_responses")
def q_f02(spark, sf):
    return response_scores(Ctx(spark, sf))


SCORERS = ["exact_match", "token_overlap"]


@query("eval_summary")
def q_f03(spark, sf):
    return EV.eval_summary(response_scores(Ctx(spark, sf)), SCORERS)


@query("compare_versions")
def q_f04(spark, sf):
    return EV.compare_versions(EV.eval_summary(response_scores(Ctx(spark, sf)), SCORERS), "v1", "v2")


@query("sample_traffic")
def q_f05(spark, sf):
    return EV.sample_traffic(spans(Ctx(spark, sf)), "span_id").select("trace_id", "span_id", "endpoint")


@query("latency_slo")
def q_f06(spark, sf):
    return EV.latency_slo(spans(Ctx(spark, sf)))


@query("span_rollup")
def q_f07(spark, sf):
    return EV.span_rollup(spans(Ctx(spark, sf)))


FEEDBACK_NAMES = ["user_rating", "expert_label"]


def feedback(c: Ctx):
    s = spans(c).select("trace_id", "span_id")
    e = c.events.join(s, c.events.event_id == s.span_id)
    k = F.coalesce(F.get_json_object("props", "$.k").try_cast("int"), F.lit(0))
    fb = e.where(F.col("event_type").isin("purchase", "signup", "error")).select(
        "trace_id", F.when(F.col("event_type") == "error", "expert_label").otherwise("user_rating").alias("name"),
        F.when(F.col("event_type") == "error", F.lit(0.0)).otherwise((F.pmod(k, F.lit(5)) + 1).cast("double")).alias("value"),
        "ts")
    return fb


@query("feedback_join")
def q_f08(spark, sf):
    c = Ctx(spark, sf)
    return EV.feedback_join(spans(c).select("trace_id").distinct(), feedback(c), FEEDBACK_NAMES)


FAIL_OVERLAP = 0.2


@query("curate_failures")
def q_f09(spark, sf):
    c = Ctx(spark, sf)
    sc = response_scores(c).join(response_pairs(c).select("case_id", "expected_response"), "case_id")
    failed = sc.where(F.coalesce(F.col("token_overlap"), F.lit(0.0)) < FAIL_OVERLAP) \
        .select("case_id", F.col("expected_response").alias("input"))
    return EV.curate_failures(failed, c.benchmark.select(F.col("text").alias("input")))


def relevant_docs(c: Ctx):
    """Documents that contain a benchmark passage verbatim (exact): every text is read once, by one automaton of
    all passages."""
    passages = c.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("passage"))
    return contains_join(passages, "passage", c.documents.select("doc_id", "text"), "text").select("query_id", "doc_id")


@query("retrieval_relevance")
def q_f10(spark, sf):
    c = Ctx(spark, sf)
    retrieved = D.keyword_search(c.text_index("documents", "doc_id", "text"), c.benchmark, "item_id", "text", 10)
    return EV.retrieval_relevance(written(retrieved, "retrieved"), written(relevant_docs(c), "relevant"), 10)


@query("peak_concurrency")
def q_f11(spark, sf):
    return EV.peak_concurrency(spans(Ctx(spark, sf)))


@query("request_log_stats")
def q_f12(spark, sf):
    e = Ctx(spark, sf).events
    return EV.request_log_stats(e.select("ts", F.col("event_type").alias("endpoint"),
                                         (F.col("event_type") == "error").alias("error"),
                                         F.length("props").alias("request_bytes")))
