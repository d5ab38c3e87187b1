"""Oracle SQL for D01–D14 (D05, D13 rows-only) and I04."""

from millrace.operators import densetext as DT
from millrace.operators import retrieval as D

from .builders import CTES, DEPS
from .queries import ORACLE, with_ctes

DB = "CAST({} AS DOUBLE)".format
TOK = "list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda x: length(x) > 0)".format


def norm_vec(v):
    return (f"list_transform(CAST({v} AS DOUBLE[]), lambda x: x / sqrt(list_aggregate("
            f"list_transform(CAST({v} AS DOUBLE[]), lambda y: y * y), 'sum')))")


def vhash(v, *meta):
    ints = f"array_to_string(list_transform({v}, lambda x: CAST(CAST(round(x * 1000000.0) AS BIGINT) AS VARCHAR)), ',')"
    return "sha256(concat_ws('|', " + ", ".join([f"CAST({m} AS VARCHAR)" for m in meta] + [ints]) + "))"


CTES["vix0"] = f"SELECT vec_id AS id, label, {norm_vec('embedding')} AS vector FROM embeddings"
DEPS["vix0"] = []
CTES["vixu"] = f"SELECT id, label, vector, {vhash('vector', 'label')} AS content_hash FROM vix0 WHERE NOT list_contains(list_transform(vector, lambda x: isnan(x)), true)"
DEPS["vixu"] = ["vix0"]

# Trained cells: the rows with the smallest md5 of their id are the start, then rounds of assignment and mean.
_NEAR = "row_number() OVER (PARTITION BY s.id ORDER BY round(list_inner_product(s.vector, c.v), 9) DESC, c.cell)"
CTES["cellsample"] = f"SELECT id, vector, row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR))) - 1 AS n FROM vixu QUALIFY n < {D.TRAIN_ROWS}"
DEPS["cellsample"] = ["vixu"]
CTES["cells0"] = f"SELECT n AS cell, list_transform(vector, lambda x: round(x, 6)) AS v FROM cellsample WHERE n < {D.CELLS}"
DEPS["cells0"] = ["cellsample"]
for _r in range(1, D.TRAIN_ROUNDS + 1):
    CTES[f"cells{_r}"] = f"""
SELECT c.cell, coalesce(m.v, c.v) AS v FROM cells{_r - 1} c LEFT JOIN (
  SELECT cell, list_transform(list(a ORDER BY d), lambda x: round(x / sqrt(list_aggregate(list_transform(list(a ORDER BY d), lambda y: y * y), 'sum')), 6)) AS v
  FROM (SELECT cell, d, avg(vector[d]) AS a FROM (
    SELECT s.vector, c.cell FROM cellsample s, cells{_r - 1} c QUALIFY {_NEAR} = 1), range(1, 65) t(d) GROUP BY cell, d) GROUP BY cell) m USING (cell)"""
    DEPS[f"cells{_r}"] = [f"cells{_r - 1}", "cellsample"]
CTES["probed"] = f"SELECT s.id, c.cell, {_NEAR} AS p FROM vixu s, cells{D.TRAIN_ROUNDS} c QUALIFY p <= {D.PROBES}"
DEPS["probed"] = ["vixu", f"cells{D.TRAIN_ROUNDS}"]
CTES["vix"] = "SELECT id, label, vector, CAST(cell AS INTEGER) AS bucket, content_hash FROM vixu JOIN probed USING (id) WHERE p = 1"
DEPS["vix"] = ["vixu", "probed"]
ORACLE["build_vector_index"] = with_ctes("SELECT id, label, bucket, content_hash FROM vix", "vix")

CTES["upserted"] = f"""
SELECT id, l.label AS label, l.quality AS quality, l.version AS version, {vhash('l.vector', 'l.label', 'l.quality')} AS content_hash
FROM (SELECT id, max({{'version': version, 'op': op, 'label': label, 'quality': quality, 'vector': vector}}) AS l FROM (
  SELECT id, 1 AS version, 'upsert' AS op, label, CAST(NULL AS INTEGER) AS quality, vector FROM vixu
  UNION ALL
  SELECT doc_id, 2, CASE WHEN toxic = 1 THEN 'delete' ELSE 'upsert' END, label, quality, {norm_vec('embedding')}
  FROM labels JOIN embeddings ON doc_id = vec_id) GROUP BY id)
WHERE l.op <> 'delete'"""
DEPS["upserted"] = ["vixu"]
ORACLE["upsert_vectors"] = with_ctes("SELECT * FROM upserted", "upserted")

ORACLE["sync_index"] = with_ctes("""
SELECT coalesce(p.id, c.id) AS id,
  CASE WHEN p.id IS NULL THEN 'insert' WHEN c.id IS NULL THEN 'delete' ELSE 'update' END AS change_type
FROM vixu p FULL OUTER JOIN upserted c ON p.id = c.id
WHERE p.id IS NULL OR c.id IS NULL OR p.content_hash <> c.content_hash""", "vixu", "upserted")


def knn(extra=""):
    return with_ctes(f"""
SELECT q.id AS query_id, i.id, round(list_inner_product(q.vector, i.vector), 9) AS score,
  CAST(row_number() OVER (PARTITION BY q.id ORDER BY round(list_inner_product(q.vector, i.vector), 9) DESC, i.id) AS INTEGER) AS rank
FROM vixu q JOIN vixu i ON q.id <> i.id {extra}
QUALIFY rank <= 10""", "vixu")


ORACLE["knn_exact"] = knn()
ORACLE["filtered_search"] = knn("AND q.label = i.label")

CTES["anntop"] = """SELECT q.id AS query_id, i.id, round(list_inner_product(q.vector, i.vector), 9) AS score,
  CAST(row_number() OVER (PARTITION BY q.id ORDER BY round(list_inner_product(q.vector, i.vector), 9) DESC, i.id) AS INTEGER) AS rank
FROM probed p JOIN vix q ON p.id = q.id JOIN vix i ON i.bucket = p.cell AND i.id <> q.id QUALIFY rank <= 10"""
DEPS["anntop"] = ["vix", "probed"]
ORACLE["ann_search"] = with_ctes("SELECT * FROM anntop", "anntop")
CTES["exacttop"] = """SELECT q.id AS query_id, i.id,
  row_number() OVER (PARTITION BY q.id ORDER BY round(list_inner_product(q.vector, i.vector), 9) DESC, i.id) AS rank
FROM vixu q JOIN vixu i ON q.id <> i.id QUALIFY rank <= 10"""
DEPS["exacttop"] = ["vixu"]
ORACLE["ann_recall"] = with_ctes("""
SELECT 10 AS k, count(*) AS queries, avg(r) AS recall_at_k FROM (
  SELECT e.query_id, CAST(count(a.id) AS DOUBLE) / 10 AS r
  FROM exacttop e LEFT JOIN anntop a ON a.query_id = e.query_id AND a.id = e.id GROUP BY e.query_id)""", "exacttop", "anntop")

USER_Q = "SELECT conv_id || '-' || turn AS query_id, conv_id, text FROM conversations WHERE role = 'user'"


def postings(p, docs, id_col, text_col):
    return {
        f"{p}post": f"SELECT doc_id, term, count(*) AS tf FROM (SELECT {id_col} AS doc_id, unnest({TOK(text_col)}) AS term FROM {docs}) GROUP BY ALL",
        f"{p}dl": f"SELECT doc_id, sum(tf) AS dl FROM {p}post GROUP BY doc_id",
        f"{p}stats": f"SELECT count(*) AS n, avg(dl) AS avgdl FROM {p}dl",
        f"{p}df": f"SELECT term, count(*) AS df FROM {p}post GROUP BY term",
    }


def bm25(p, docs, id_col, text_col, k, queries=USER_Q, doc_filter=None):
    c = postings(p, docs, id_col, text_col)
    c[f"{p}w"] = (f"SELECT doc_id, term, ln({DB(1.0)} + (n - df + {DB(0.5)}) / (df + {DB(0.5)})) * ((tf * {DB(2.2)})"
                  f" / (tf + {DB(1.2)} * ({DB(0.25)} + {DB(0.75)} * dl / avgdl))) AS w "
                  f"FROM {p}post JOIN {p}dl USING (doc_id) JOIN {p}df USING (term), {p}stats")
    c[f"{p}q"] = f"SELECT query_id, unnest(list_distinct({TOK('text')})) AS term FROM ({queries})"
    filt = f" WHERE (query_id, doc_id) IN (SELECT query_id, doc_id FROM {doc_filter})" if doc_filter else ""
    c[f"{p}s"] = (f"SELECT query_id, doc_id, round(sum(w), 6) AS score FROM {p}q JOIN {p}w USING (term)"
                  f"{filt} GROUP BY query_id, doc_id")
    c[f"{p}top"] = (f"SELECT query_id, doc_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank "
                    f"FROM {p}s QUALIFY rank <= {k}")
    return c


def ctes(d: dict, *base):
    return ",\n".join(f"{n} AS ({s})" for n, s in d.items())


def query_sql(body, cte_map, *base):
    """Builder CTEs first (with_ctes), then the local CTE map."""
    return with_ctes(", " + ctes(cte_map) + "\n" + body, *base) if base else "WITH " + ctes(cte_map) + "\n" + body


ORACLE["keyword_search"] = query_sql("SELECT * FROM kwtop", bm25("kw", "documents", "doc_id", "text", 10))
ORACLE["search_no_result"] = query_sql(f"""
SELECT query_id, CAST(0 AS BIGINT) AS n_results FROM ({USER_Q}) WHERE query_id NOT IN (SELECT query_id FROM kws)""",
                                       bm25("kw", "documents", "doc_id", "text", 10))
ORACLE["project_results"] = query_sql(
    "SELECT t.*, d.source, d.lang, d.n_chars FROM kwtop t LEFT JOIN documents d ON t.doc_id = d.doc_id",
    bm25("kw", "documents", "doc_id", "text", 10))

_perm = {"perm": f"""SELECT query_id, d.doc_id FROM (
  SELECT query_id, unnest(['src' || CAST(conv_id % 20 AS VARCHAR), 'src' || CAST((conv_id + 1) % 20 AS VARCHAR)]) AS source
  FROM ({USER_Q})) a JOIN documents d ON a.source = d.source"""}
ORACLE["permitted_search"] = query_sql("SELECT * FROM kwtop",
                                       {**_perm, **bm25("kw", "documents", "doc_id", "text", 10, doc_filter="perm")})

_tf = postings("tf", "documents", "doc_id", "text")
_tf["tfn"] = "SELECT count(DISTINCT doc_id) AS n FROM tfpost"
_tf["tfw"] = (f"SELECT doc_id, term, tf * (ln(({DB(1.0)} + n) / (df + {DB(1.0)})) + {DB(1.0)}) AS w "
              f"FROM tfpost JOIN tfdf USING (term), tfn")
_tf["tfv"] = ("SELECT doc_id, term, w / norm AS weight FROM tfw JOIN "
              "(SELECT doc_id, sqrt(sum(w * w)) AS norm FROM tfw GROUP BY doc_id) USING (doc_id)")
ORACLE["embed_text"] = query_sql("SELECT * FROM tfv", _tf)

_dense = dict(_tf)
_dense["dterm"] = (f"SELECT term, d, sum(CASE WHEN substr(sha256(CAST(doc_id AS VARCHAR)), d, 1) >= '8' THEN weight ELSE -weight END) AS v "
                   f"FROM tfv, range(1, {DT.DIMS + 1}) t(d) GROUP BY term, d")
_dense["dunit"] = "SELECT term, d, v / sqrt(sum(v * v) OVER (PARTITION BY term)) AS v FROM dterm"
_dense["ddoc"] = "SELECT doc_id, d, sum(weight * v) AS v FROM tfv JOIN dunit USING (term) GROUP BY doc_id, d"
_dense["dround"] = "SELECT doc_id, CAST(d - 1 AS INTEGER) AS dim, round(v / sqrt(sum(v * v) OVER (PARTITION BY doc_id)), 6) AS value FROM ddoc"
ORACLE["embed_dense"] = query_sql(f"SELECT doc_id, dim, CASE WHEN value = 0 THEN {DB(0.0)} ELSE value END AS value FROM dround", _dense)

_sem = dict(_tf)
_sem["sq"] = f"SELECT query_id, term, count(*) AS tf FROM (SELECT query_id, unnest({TOK('text')}) AS term FROM ({USER_Q})) GROUP BY ALL"
_sem["sqw"] = (f"SELECT query_id, term, tf * (ln(({DB(1.0)} + n) / (coalesce(df, 0) + {DB(1.0)})) + {DB(1.0)}) AS w "
               f"FROM sq LEFT JOIN tfdf USING (term), tfn")
_sem["sqv"] = ("SELECT query_id, term, w / qnorm AS qw FROM sqw JOIN "
               "(SELECT query_id, sqrt(sum(w * w)) AS qnorm FROM sqw GROUP BY query_id) USING (query_id)")
_sem["sems"] = "SELECT query_id, doc_id, round(sum(qw * weight), 6) AS score FROM sqv JOIN tfv USING (term) GROUP BY ALL"
_sem["semtop"] = ("SELECT query_id, doc_id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank "
                  "FROM sems QUALIFY rank <= 10")
_sem.update(bm25("kw", "documents", "doc_id", "text", 10))
ORACLE["hybrid_search"] = "WITH " + ctes(_sem) + """,
fused AS (SELECT coalesce(a.query_id, b.query_id) AS query_id, coalesce(a.doc_id, b.doc_id) AS doc_id,
            a.rank AS r_sem, b.rank AS r_kw,
            round(coalesce(CAST(1.0 AS DOUBLE) / (60 + a.rank), 0.0) + coalesce(CAST(1.0 AS DOUBLE) / (60 + b.rank), 0.0), 9) AS rrf_score
          FROM semtop a FULL OUTER JOIN kwtop b ON a.query_id = b.query_id AND a.doc_id = b.doc_id)
SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rrf_score DESC, doc_id) AS INTEGER) AS rank FROM fused QUALIFY rank <= 10"""

PRESETS = [("sop", "standard_operating_procedures", "id", "procedure_text", 5),
           ("incidents", "incident_reports", "id", "incident_description", 3),
           ("proposals", "sales_proposals", "id", "proposal_content", 3),
           ("tickets", "support_tickets", "id", "ticket_content", 3)]


def presets(names=None):
    m, parts = {}, []
    for name, table, id_col, text_col, k in PRESETS:
        if names and name not in names:
            continue
        m.update(bm25(f"p_{name}_", table, id_col, text_col, k))
        parts.append(f"SELECT '{name}' AS retriever, query_id, rank, doc_id AS id, score FROM p_{name}_top")
    return m, "\nUNION ALL\n".join(parts), [t for n, t, *_ in PRESETS if not names or n in names]


_m, _u, _t = presets()
ORACLE["retriever_presets"] = query_sql(_u, _m, *_t)
_m, _u, _t = presets(["sop", "incidents"])
ORACLE["search_domain"] = query_sql(f"""
SELECT retriever, query_id, id, score, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, retriever, id) AS INTEGER) AS rank
FROM (SELECT retriever, query_id, id, score FROM ({_u})) QUALIFY rank <= 5""", _m, *_t)
