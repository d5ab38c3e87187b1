"""Oracle SQL for E01–E05 and F01–F12."""

from millrace import config as C

from .builders import CTES, DEPS
from .q_retrieval import PRESETS, bm25, ctes, query_sql
from .queries import ORACLE, with_ctes

E01 = """SELECT conv_id, max(turn) AS last_turn, arg_max(role, (turn, role, text)) AS last_role,
  arg_max(text, (turn, role, text)) AS last_text,
  max(turn) FILTER (WHERE role = 'user') AS last_user_turn,
  arg_max(text, (turn, text)) FILTER (WHERE role = 'user') AS last_user_text
FROM conversations GROUP BY conv_id"""
ORACLE["last_user_message"] = E01

_route = "CASE " + " ".join(
    "WHEN " + " OR ".join(f"contains(lower(last_user_text), '{w}')" for w in words) + f" THEN '{r}'"
    for r, words in C.ROUTE_RULES) + " ELSE 'general' END"
CTES["routed"] = f"SELECT *, {_route} AS route FROM ({E01})"
DEPS["routed"] = []
ORACLE["route_intent"] = with_ctes("SELECT conv_id, route FROM routed", "routed")

_QS = "SELECT conv_id AS query_id, last_user_text AS text FROM routed WHERE last_user_text IS NOT NULL"


def routed_presets(names, where):
    m, parts = {}, []
    for name, table, id_col, text_col, k in PRESETS:
        if name not in names:
            continue
        m.update(bm25(f"r_{name}_", table, id_col, text_col, k, queries=_QS + where(name)))
        parts.append(f"SELECT '{name}' AS retriever, query_id, rank, doc_id AS id, score FROM r_{name}_top")
    return m, "\nUNION ALL\n".join(parts), [t for n, t, *_ in PRESETS if n in names]


_gen = ["sop", "incidents"]
_m, _u, _t = routed_presets(["sop", "incidents", "proposals"],
                            lambda n: f" AND (route = '{n}'" + (" OR route = 'general')" if n in _gen else ")"))
ORACLE["route_context"] = query_sql(f"""
SELECT q.conv_id, q.route, r.retriever, r.rank, r.id, r.score FROM routed q JOIN ({_u}) r ON q.conv_id = r.query_id
WHERE q.route = r.retriever OR (q.route = 'general' AND r.retriever IN ('sop', 'incidents') AND r.rank <= 2)""",
                                    _m, "routed", *_t)

_order = [p[0] for p in PRESETS]
_m, _u, _t = routed_presets(_order, lambda n: "")
_pos = "CASE retriever " + " ".join(f"WHEN '{n}' THEN {i}" for i, n in enumerate(_order)) + " END"
ORACLE["fanout_context"] = query_sql(f"""
SELECT query_id AS conv_id, string_agg(retriever || ':' || id, ' | ' ORDER BY {_pos}, rank) AS context,
  CAST(count(*) AS INTEGER) AS n_items
FROM ({_u}) WHERE rank <= 2 GROUP BY query_id""", _m, "routed", *_t)

ORACLE["assemble_history"] = """
SELECT conv_id, CAST(count(*) AS INTEGER) AS n_messages,
  list(role || ': ' || text ORDER BY turn, role, text) AS history
FROM conversations WHERE role IN ('user', 'assistant', 'system') GROUP BY conv_id"""

# ---- evaluation -------------------------------------------------------------------------------
CTES["spans"] = """
WITH ev AS (SELECT 'T' || CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS trace_id, event_id AS span_id,
    ts AS start, CAST(round(value * 100) AS BIGINT) AS duration_ms, event_type = 'error' AS error,
    coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS tokens, event_type AS endpoint FROM events),
roots AS (SELECT trace_id, arg_min(span_id, (start, span_id)) AS root_id FROM ev GROUP BY trace_id)
SELECT e.trace_id, span_id, CASE WHEN span_id <> root_id THEN root_id END AS parent_id, start, duration_ms, error,
  tokens, CAST(tokens * 2 AS DOUBLE) / 1000.0 AS cost, endpoint
FROM ev e JOIN roots r ON e.trace_id = r.trace_id"""
DEPS["spans"] = []

_exp = "CASE entry " + " ".join(
    f"WHEN '{k}' THEN [{', '.join(repr(x) for x in v)}]" for k, v in
    {"view": ["view", "click"], "click": ["click", "purchase"], "signup": ["signup", "view"],
     "purchase": ["purchase"], "error": ["view"]}.items()) + " END"
ORACLE["score_tool_calls"] = with_ctes(f"""
, cases AS (SELECT s.trace_id AS case_id, {_exp} AS expected_tools, called_tools FROM
  (SELECT trace_id, list_sort(list_distinct(list(endpoint))) AS called_tools FROM spans GROUP BY trace_id) s
  JOIN (SELECT trace_id, endpoint AS entry FROM spans WHERE parent_id IS NULL) r ON s.trace_id = r.trace_id)
SELECT case_id, expected_tools, called_tools,
  CASE WHEN len(called_tools) > 0 THEN len(list_intersect(expected_tools, called_tools)) / len(called_tools) END AS precision,
  CASE WHEN len(expected_tools) > 0 THEN len(list_intersect(expected_tools, called_tools)) / len(expected_tools) END AS recall,
  list_sort(list_distinct(expected_tools)) = list_sort(list_distinct(called_tools)) AS exact
FROM cases""", "spans")

TOK = "list_distinct(list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: length(x) > 0))".format
NORM = "trim(regexp_replace(lower({}), '\\s+', ' ', 'g'))".format
CTES["pairs"] = """
SELECT u.conv_id || '-' || u.turn AS case_id, CASE WHEN u.conv_id % 2 = 0 THEN 'v1' ELSE 'v2' END AS version,
  u.text AS expected_response, a.text AS response
FROM conversations u JOIN conversations a ON u.conv_id = a.conv_id AND a.turn - 1 = u.turn
WHERE u.role = 'user' AND a.role = 'assistant'"""
DEPS["pairs"] = []
CTES["scores"] = f"""
SELECT case_id, version, CAST({NORM('expected_response')} = {NORM('response')} AS INTEGER) AS exact_match,
  CASE WHEN len({TOK('expected_response')}) > 0
       THEN len(list_intersect({TOK('expected_response')}, {TOK('response')})) / len({TOK('expected_response')}) END AS token_overlap
FROM pairs"""
DEPS["scores"] = ["pairs"]
ORACLE["score_responses"] = with_ctes("SELECT * FROM scores", "scores")
CTES["summary"] = """
SELECT version, scorer, round(avg(score), 6) AS mean, count(score) AS n FROM (
  SELECT version, 'exact_match' AS scorer, CAST(exact_match AS DOUBLE) AS score FROM scores
  UNION ALL SELECT version, 'token_overlap', token_overlap FROM scores) GROUP BY version, scorer"""
DEPS["summary"] = ["scores"]
ORACLE["eval_summary"] = with_ctes("SELECT * FROM summary", "summary")
ORACLE["compare_versions"] = with_ctes("""
SELECT scorer, max(mean) FILTER (WHERE version = 'v1') AS base_mean, max(mean) FILTER (WHERE version = 'v2') AS other_mean,
  round(max(mean) FILTER (WHERE version = 'v2') - max(mean) FILTER (WHERE version = 'v1'), 6) AS delta
FROM summary GROUP BY scorer""", "summary")

ORACLE["sample_traffic"] = with_ctes("""
SELECT trace_id, span_id, endpoint FROM spans WHERE ((span_id % 2147483647) * 2654435761) % 1000 < 100""", "spans")
ORACLE["latency_slo"] = with_ctes("""
SELECT endpoint, count(*) AS requests, quantile_cont(CAST(duration_ms AS DOUBLE), 0.5) AS p50_ms,
  quantile_cont(CAST(duration_ms AS DOUBLE), 0.95) AS p95_ms, quantile_cont(CAST(duration_ms AS DOUBLE), 0.99) AS p99_ms,
  count_if(duration_ms < 500) / count(*) AS share_under_500ms,
  quantile_cont(CAST(duration_ms AS DOUBLE), 0.95) < 2000 AS meets_p95_2s
FROM spans GROUP BY endpoint""", "spans")
ORACLE["span_rollup"] = with_ctes("""
, per AS (SELECT trace_id, count(*) AS spans, CAST(sum(duration_ms) AS BIGINT) AS total_ms,
            (max(epoch_us(start) + duration_ms * 1000) - min(epoch_us(start))) / 1000.0 AS wall_ms,
            count_if(error) AS errors, CAST(sum(tokens) AS BIGINT) AS tokens FROM spans GROUP BY trace_id),
kids AS (SELECT parent_id, sum(duration_ms) AS child_ms FROM spans WHERE parent_id IS NOT NULL GROUP BY parent_id),
roots AS (SELECT trace_id, duration_ms - coalesce(child_ms, 0) AS root_self_ms FROM spans s
          LEFT JOIN kids k ON s.span_id = k.parent_id WHERE s.parent_id IS NULL)
SELECT per.trace_id, spans, total_ms, wall_ms, errors, tokens, CAST(tokens * 2 AS DOUBLE) / 1000.0 AS cost,
  CAST(root_self_ms AS BIGINT) AS root_self_ms
FROM per JOIN roots ON per.trace_id = roots.trace_id""", "spans")
ORACLE["feedback_join"] = with_ctes("""
, fb AS (SELECT s.trace_id, CASE WHEN event_type = 'error' THEN 'expert_label' ELSE 'user_rating' END AS name,
           CASE WHEN event_type = 'error' THEN 0.0
                ELSE CAST(coalesce(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), 0) % 5 + 1 AS DOUBLE) END AS value, ts
         FROM events e JOIN spans s ON e.event_id = s.span_id WHERE event_type IN ('purchase', 'signup', 'error')),
latest AS (SELECT trace_id, name, arg_max(value, (ts, value)) AS value FROM fb GROUP BY trace_id, name),
n AS (SELECT trace_id, count(*) AS n_feedback FROM fb GROUP BY trace_id)
SELECT t.trace_id, max(l.value) FILTER (WHERE l.name = 'user_rating') AS user_rating,
  max(l.value) FILTER (WHERE l.name = 'expert_label') AS expert_label, coalesce(max(n.n_feedback), 0) AS n_feedback
FROM (SELECT DISTINCT trace_id FROM spans) t LEFT JOIN latest l ON t.trace_id = l.trace_id
  LEFT JOIN n ON t.trace_id = n.trace_id GROUP BY t.trace_id""", "spans")
ORACLE["curate_failures"] = with_ctes(f"""
SELECT {NORM('p.expected_response')} AS normalized_input, min(s.case_id) AS case_id, count(*) AS occurrences
FROM scores s JOIN pairs p ON s.case_id = p.case_id
WHERE coalesce(s.token_overlap, 0.0) < 0.2
  AND {NORM('p.expected_response')} NOT IN (SELECT {NORM('text')} FROM benchmark)
GROUP BY {NORM('p.expected_response')}""", "scores", "pairs")

_bm = bm25("bq", "documents", "doc_id", "text", 10, queries="SELECT item_id AS query_id, text FROM benchmark")
ORACLE["retrieval_relevance"] = "WITH " + ctes(_bm) + """,
rel AS (SELECT b.item_id AS query_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)),
hits AS (SELECT t.query_id, count(*) AS hits FROM bqtop t JOIN rel r ON t.query_id = r.query_id AND t.doc_id = r.doc_id GROUP BY t.query_id),
nrel AS (SELECT query_id, count(*) AS n_relevant FROM rel GROUP BY query_id),
q AS (SELECT query_id FROM bqtop UNION SELECT query_id FROM rel)
SELECT q.query_id, coalesce(n_relevant, 0) AS n_relevant, coalesce(hits, 0) AS hits,
  CAST(coalesce(hits, 0) AS DOUBLE) / 10.0 AS precision_at_k,
  CASE WHEN n_relevant > 0 THEN coalesce(hits, 0) / n_relevant END AS recall_at_k
FROM q LEFT JOIN nrel ON q.query_id = nrel.query_id LEFT JOIN hits ON q.query_id = hits.query_id"""

ORACLE["peak_concurrency"] = with_ctes("""
, pts AS (SELECT epoch_us(start) AS t, 1 AS d FROM spans UNION ALL SELECT epoch_us(start) + duration_ms * 1000, -1 FROM spans),
lv AS (SELECT t, sum(d) OVER (ORDER BY t, d ROWS UNBOUNDED PRECEDING) AS level FROM pts)
SELECT CAST(max(level) AS BIGINT) AS peak_concurrency, make_timestamp(min(t) FILTER (WHERE level = (SELECT max(level) FROM lv))) AS first_peak_at,
  max(level) >= 100 AS meets_target FROM lv""", "spans")
ORACLE["request_log_stats"] = """
SELECT CAST(ts AS DATE) AS day, event_type AS endpoint, count(*) AS requests, count_if(event_type = 'error') AS errors,
  CAST(sum(length(props)) AS BIGINT) AS request_bytes FROM events GROUP BY ALL"""
