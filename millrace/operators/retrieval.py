"""Vector and keyword retrieval as Spark jobs.

* Text: an index of whole texts, written once a corpus; BM25 and TF-IDF cosine lists
  by block maxima with a running k-th score (``textsearch``), exact.
* Vectors: exact k-NN deals index and queries into blocks; every pair of blocks meets
  in one task and gives k candidates a query to the final ``row_number`` merge.
* ANN: a stored index of trained cells; a query meets the rows of its nearest cells.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens, top_k
from ..session import scratch_path, ship_code, written
from . import textsearch as TS

RRF_K = 60


# ---------------------------------------------------------------- text -----------------------
def keyword_search(index: TS.TextIndex, queries: DataFrame, qid_col: str, q_text: str, k: int = 10,
                   query_groups: DataFrame | None = None, counters=None) -> DataFrame:
    """BM25 top-k documents per query. With ``query_groups`` (query_id, group) a query meets documents of
    its groups only (I04; the index carries each document's group): others are never scored."""
    return TS.bm25_search(index, queries, qid_col, q_text, k, query_groups, counters)


def embed_text(index: TS.TextIndex) -> DataFrame:
    """D01 embed_text: L2-normalised TF-IDF sparse vectors as (doc_id, term, weight) rows.

    idf = ln((1 + N) / (1 + df)) + 1 (smooth idf); the index carries each document's norm.
    """
    return index.entries("doc_id", "norm").select(
        "doc_id", "term", (F.col("tf") * TS.smooth_idf(index.n, F.col("df")) / F.col("norm")).alias("weight"))


def hybrid_text_search(index: TS.TextIndex, queries: DataFrame, qid_col: str, q_text: str, k: int = 10) -> DataFrame:
    """D07 over text: the TF-IDF cosine list and the BM25 list of one index, fused by reciprocal rank."""
    return hybrid_search(TS.cosine_search(index, queries, qid_col, q_text, k),
                         TS.bm25_search(index, queries, qid_col, q_text, k), k)


def hybrid_search(semantic: DataFrame, keyword: DataFrame, k: int = 10) -> DataFrame:
    """Reciprocal-rank fusion 1/(60 + r) over the two ranked lists (full outer on query, doc)."""
    a = semantic.select("query_id", "doc_id", F.col("rank").alias("r_sem"))
    b = keyword.select("query_id", "doc_id", F.col("rank").alias("r_kw"))
    j = a.join(b, ["query_id", "doc_id"], "full")
    rrf = F.coalesce(1.0 / (F.lit(RRF_K) + F.col("r_sem")), F.lit(0.0)) + \
        F.coalesce(1.0 / (F.lit(RRF_K) + F.col("r_kw")), F.lit(0.0))
    s = j.select("query_id", "doc_id", "r_sem", "r_kw", F.round(rrf, 9).alias("rrf_score"))
    return top_k(s, ["query_id"], [F.col("rrf_score").desc(), F.col("doc_id")], k)


def project_results(results: DataFrame, docs: DataFrame, id_col: str, columns: list) -> DataFrame:
    """Rank on (id, score) only, then join back for the requested columns."""
    return results.join(docs.select(F.col(id_col).alias("doc_id"), *columns), "doc_id", "left")


def no_result_queries(queries: DataFrame, qid_col: str, q_text: str, docs: DataFrame, text_col: str) -> DataFrame:
    """Queries without any hit, i.e. of whose terms none is in the corpus; nothing is scored."""
    vocabulary = docs.select(F.explode(tokens(F.col(text_col))).alias("term")).distinct()
    hits = TS.query_terms(queries, qid_col, q_text).join(vocabulary, "term", "left_semi").select("query_id").distinct()
    return (queries.select(F.col(qid_col).alias("query_id")).distinct().join(hits, "query_id", "left_anti")
            .select("query_id", F.lit(0).cast("bigint").alias("n_results")))


# ---------------------------------------------------------------- vector index ---------------
def l2_normalize(v: Column) -> Column:
    """The unit vector; NULL for a zero or NULL vector, which has no direction."""
    vd = F.transform(v, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(vd, F.lit(0.0), lambda acc, x: acc + x * x))
    # The norm is bound to a variable: written inside the inner function it would be computed for every element.
    return F.transform(F.array(norm), lambda n: F.when(n > 0, F.transform(vd, lambda x: F.try_divide(x, n))))[0]


def content_hash(v: Column, *meta: Column) -> Column:
    ints = F.array_join(F.transform(v, lambda x: F.round(x * 1000000.0).cast("bigint").cast("string")), ",")
    return F.sha2(F.concat_ws("|", *[m.cast("string") for m in meta], ints), 256)


def unit_vectors(vectors: DataFrame, id_col: str, vec_col: str, meta_cols: list) -> DataFrame:
    """id, meta, vector, content_hash: unit vectors; zero and NULL vectors have no direction and are left out."""
    return vectors.select(F.col(id_col).alias("id"), *meta_cols, l2_normalize(F.col(vec_col)).alias("vector")) \
        .where(F.col("vector").isNotNull()) \
        .withColumn("content_hash", content_hash(F.col("vector"), *[F.col(m) for m in meta_cols]))


@dataclass
class VectorIndex:
    """``rows`` (id, meta, vector, content_hash, bucket), stored by bucket = the cell of the nearest centroid."""
    rows: DataFrame
    centroids: np.ndarray


#: Cells of an index, cells that a search probes, rows that the cells are trained on, and rounds of training.
CELLS, PROBES, TRAIN_ROWS, TRAIN_ROUNDS = 64, 38, 65536, 2


def train_cells(vectors: DataFrame, cells: int = CELLS) -> np.ndarray:
    """Centroids of ``cells`` cells, by Lloyd rounds on a sample of at most ``TRAIN_ROWS`` rows: those whose ids have
    the smallest md5. The first ones are the start. Centroids are unit vectors at six decimals."""
    keyed = vectors.where("id IS NOT NULL").select("vector", F.md5(F.col("id").cast("string").cast("binary")).alias("m"))
    # Every task of a sorted limit sends as many rows as the limit, so only rows up to the prefix that holds it are sorted.
    prefix, seen, last = F.substring("m", 1, 3), 0, "fff"
    for start, n in sorted(keyed.groupBy(prefix).count().collect()):  # at most 4096 rows
        seen += n
        if seen >= TRAIN_ROWS:
            last = start
            break
    sample = keyed.where(prefix <= last).orderBy("m").limit(TRAIN_ROWS).collect()
    if not sample:
        return np.zeros((0, 0))
    x = np.array([r.vector for r in sample])
    centroids = np.round(x[:cells], 6)
    for _ in range(TRAIN_ROUNDS):
        own = _nearest(x, centroids, 1)[:, 0]
        for c in range(len(centroids)):
            mean = x[own == c].mean(axis=0) if (own == c).any() else centroids[c]
            norm = np.sqrt((mean * mean).sum())
            centroids[c] = np.round(mean / norm, 6) if norm > 0 else centroids[c]
    return centroids


def _nearest(x: np.ndarray, centroids: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest cells of each row, by (dot product at nine decimals, smaller number)."""
    return np.argsort(-np.round(x @ centroids.T, 9), axis=1, kind="stable")[:, :n]


def nearest_cells(vector: Column, centroids: np.ndarray, n: int) -> Column:
    """array<int> of the ``n`` nearest cells; the centroids are ``CELLS`` rows at most."""
    @F.pandas_udf("array<int>")
    def cells(v: pd.Series) -> pd.Series:
        return pd.Series(list(_nearest(np.stack(v.to_numpy()), centroids, n).astype(np.int32))) if len(v) else pd.Series([], dtype=object)
    return cells(vector)


def build_vector_index(vectors: DataFrame, id_col: str, vec_col: str, meta_cols: list, cells: int = CELLS, path: str | None = None) -> VectorIndex:
    """Train the cells, give every row its cell and write the rows as Parquet partitioned by it (a hot cell is
    spread over several files)."""
    spark = vectors.sparkSession
    ship_code(spark)
    path = path or scratch_path(spark, "vector_index")
    unit = unit_vectors(vectors, id_col, vec_col, meta_cols)
    centroids = train_cells(unit, cells)
    if not len(centroids):
        return VectorIndex(written(unit.withColumn("bucket", F.lit(0)), "vector_index"), centroids)
    rows = unit.withColumn("bucket", nearest_cells(F.col("vector"), centroids, 1)[0])
    salt = F.pmod(F.xxhash64("id"), F.lit(spark.sparkContext.defaultParallelism))
    rows.repartition("bucket", F.when(salt == 0, 1).otherwise(0)).write.mode("overwrite").partitionBy("bucket").parquet(path)
    return VectorIndex(spark.read.schema(rows.schema).parquet(path), centroids)


def upsert_vectors(base: DataFrame, updates: DataFrame) -> DataFrame:
    """Union base and updates; the latest version per id wins; deletes drop the id.

    Latest-per-key is ``max(struct(version, ...))`` - a partial aggregate - so an
    id with many versions never needs a sorted window.
    """
    cols = [c for c in base.columns if c not in ("id", "version")]
    u = base.select("id", "version", F.lit("upsert").alias("op"), *cols).unionByName(
        updates.select("id", "version", "op", *cols))
    latest = u.groupBy("id").agg(F.max(F.struct("version", "op", *cols)).alias("l"))
    return latest.where(F.col("l.op") != "delete").select("id", *[F.col(f"l.{c}").alias(c) for c in cols + ["version"]])


def sync_index(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Incremental refresh plan by (id, content_hash): insert / update / delete."""
    p = previous.select("id", F.col("content_hash").alias("h_prev"))
    c = current.select("id", F.col("content_hash").alias("h_cur"))
    j = p.join(c, "id", "full")
    change = (F.when(F.col("h_prev").isNull(), "insert").when(F.col("h_cur").isNull(), "delete")
               .when(~F.col("h_prev").eqNullSafe(F.col("h_cur")), "update"))
    return j.select("id", change.alias("change_type")).where(F.col("change_type").isNotNull())


#: Rows of a block of the exact search: a task holds one block of the index and one of the queries. A row is shuffled
#: once a block of the other side. Scores that a task holds at once, and queries that it takes together.
KNN_BLOCK, KNN_SCORES, KNN_QUERIES = 1 << 16, 1 << 20, 256

_CANDIDATES = pa.schema([("query_id", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    return pc.list_flatten(column).to_numpy().reshape(len(column), -1)


def _exact(q: np.ndarray, x: np.ndarray, row: np.ndarray, col: np.ndarray) -> np.ndarray:
    """Rounded scores of some pairs."""
    score = np.empty(len(row))
    step = max(1, KNN_SCORES // x.shape[1])
    for a in range(0, len(row), step):
        score[a:a + step] = np.einsum("ij,ij->i", q[row[a:a + step]], x[col[a:a + step]])
    return np.round(score, 9)


def _block_topk(k: int, exclude_self: bool):
    """Top-k of one index block for one query block, by (rounded score, smaller id). All pairs are scored in single
    precision; those within its error of a query's k-th score so far are scored again exactly."""
    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        if not len(index) or not len(queries):
            return _CANDIDATES.empty_table()
        x, q = _vectors(index["vector"]), _vectors(queries["vector"])
        ids, q_ids = index["id"].to_numpy(), queries["query_id"].to_numpy()
        x32, q32 = x.astype(np.float32), q.astype(np.float32)
        # The error of a sum of d products in single precision, and of its rounding at nine decimals.
        long = max(1.0, *(np.sqrt((v * v).sum(axis=1).max()) for v in (x, q)))
        error = np.float32((x.shape[1] + 8) * 2.0 ** -23 * long * long + 1e-8)
        wide = max(1, min(len(ids), KNN_SCORES // KNN_QUERIES))
        parts = []
        for lo in range(0, len(q_ids), KNN_QUERIES):
            mine, who = q[lo:lo + KNN_QUERIES], q_ids[lo:lo + KNN_QUERIES]
            row, id_, score = np.zeros(0, np.int64), np.zeros(0, ids.dtype), np.zeros(0)
            least = np.full(len(who), -np.inf, np.float32)  # a k-th score or below
            for at in range(0, len(ids), wide):
                s = q32[lo:lo + KNN_QUERIES] @ x32[at:at + wide].T
                new = np.flatnonzero(np.isneginf(least))
                if len(new) and s.shape[1] >= k:
                    first = s[new]
                    if exclude_self:
                        first[who[new, None] == ids[None, at:at + wide]] = -np.inf
                    least[new] = np.partition(first, s.shape[1] - k, axis=1)[:, s.shape[1] - k] - error
                found = np.flatnonzero(s >= (least - error)[:, None])
                r, c = found // s.shape[1], found % s.shape[1] + at
                if exclude_self:
                    other = who[r] != ids[c]
                    r, c = r[other], c[other]
                if not len(r):
                    continue
                row, id_, score = np.concatenate([row, r]), np.concatenate([id_, ids[c]]), np.concatenate([score, _exact(mine, x, r, c)])
                order = np.lexsort((id_, -score, row))
                row, id_, score = row[order], id_[order], score[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                kept = place < k
                row, id_, score, place = row[kept], id_[kept], score[kept], place[kept]
                full = place == k - 1
                least[row[full]] = np.maximum(least[row[full]], (score[full] - 1e-8).astype(np.float32))
            parts.append(pa.table([who[row], id_, score], schema=_CANDIDATES))
        return pa.concat_tables(parts)
    return run


def knn_exact(index: DataFrame, queries: DataFrame, k: int = 10, exclude_self: bool = False,
              match_col: str | None = None) -> DataFrame:
    """D04 (and D08 with ``match_col``): exact top-k by dot product of unit vectors (= cosine).

    ``index``: id BIGINT, vector ARRAY<DOUBLE>[, match]; ``queries``: query_id BIGINT, vector[, match].
    Index and queries are dealt into blocks and every pair of blocks meets in one task; nothing
    passes the driver. With ``match_col`` the blocks are cut within its values, so pairs of
    other values are never scored (a NULL matches a NULL). The work is index x queries by nature.
    """
    spark = index.sparkSession
    ship_code(spark)
    n_q = max(1, math.ceil(queries.count() / KNN_BLOCK))
    n_i = max(math.ceil(index.count() / KNN_BLOCK), math.ceil(spark.sparkContext.defaultParallelism / n_q), 1)
    match = [F.col(match_col).alias("match")] if match_col else []
    key = ["_i", "_q"] + (["match"] if match_col else [])
    ix = index.select("id", "vector", *match, F.pmod(F.xxhash64("id"), F.lit(n_i)).alias("_i"),
                      F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("_q"))
    qx = queries.select("query_id", "vector", *match, F.pmod(F.xxhash64("query_id"), F.lit(n_q)).cast("int").alias("_q"),
                        F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_i - 1).cast("bigint"))).alias("_i"))
    cand = ix.groupBy(*key).cogroup(qx.groupBy(*key)).applyInArrow(
        _block_topk(k, exclude_self), "query_id long, id long, score double")
    return top_k(cand, ["query_id"], [F.col("score").desc(), F.col("id")], k)


def ann_search(index: VectorIndex, queries: DataFrame, k: int = 10, probes: int = PROBES, exclude_self: bool = False) -> DataFrame:
    """Exact top-k among the rows of the ``probes`` cells nearest to the query. Rows and queries meet by cell; a
    cell with more rows or queries than a block is dealt into blocks, so a hot cell is spread. ``probes`` trades pairs
    for recall: clustered vectors need few, directions at random most."""
    ship_code(queries.sparkSession)
    if not len(index.centroids):
        return queries.select("query_id", F.lit(None).cast("bigint").alias("id"), F.lit(0.0).alias("score"), F.lit(1).alias("rank")).where("false")
    ix = index.rows.select("id", "vector", F.col("bucket").alias("cell"))
    # A vector is written once, not once a probe.
    qx = written(queries.select("query_id", "vector", nearest_cells(F.col("vector"), index.centroids, probes).alias("cells")), "probes")
    qx = qx.select("query_id", "vector", F.explode("cells").alias("cell"))
    # At most CELLS rows: blocks of rows and of queries in each cell.
    blocks = F.ceil(F.count(F.lit(1)) / KNN_BLOCK).cast("int")
    sizes = ix.groupBy("cell").agg(blocks.alias("n_i")).join(qx.groupBy("cell").agg(blocks.alias("n_q")), "cell")
    deal = lambda col, n: F.pmod(F.xxhash64(col), F.col(n)).cast("int")
    copies = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = ix.join(sizes, "cell").select("id", "vector", "cell", deal("id", "n_i").alias("_i"), copies("n_q").alias("_q"))
    right = qx.join(sizes, "cell").select("query_id", "vector", "cell", deal("query_id", "n_q").alias("_q"), copies("n_i").alias("_i"))
    key = ["cell", "_i", "_q"]
    cand = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_block_topk(k, exclude_self), "query_id long, id long, score double")
    return top_k(cand, ["query_id"], [F.col("score").desc(), F.col("id")], k)


def recall_at_k(approx: DataFrame, exact: DataFrame, k: int) -> DataFrame:
    """Mean over queries of |approx top-k ∩ exact top-k| / k."""
    a = approx.groupBy("query_id").agg(F.collect_set("id").alias("a"))   # <= k ids per query
    e = exact.groupBy("query_id").agg(F.collect_set("id").alias("e"))
    j = e.join(a, "query_id", "left")
    r = j.select((F.size(F.array_intersect("e", F.coalesce("a", F.array().cast("array<bigint>")))) / float(k)).alias("r"))
    return r.agg(F.lit(k).alias("k"), F.count(F.lit(1)).alias("queries"), F.avg("r").alias("recall_at_k"))


def search_domain(results: list[DataFrame], k: int) -> DataFrame:
    """Merge per-index results (query_id, retriever, id, score) into one global top-k."""
    u = results[0]
    for r in results[1:]:
        u = u.unionByName(r)
    return top_k(u.drop("rank"), ["query_id"], [F.col("score").desc(), F.col("retriever"), F.col("id")], k)
